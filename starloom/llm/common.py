"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path

#: Words of the contracts that split on ASCII white space.
ASCII_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back, so
    that later uses neither recompute it nor lose it with an executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give back what a Python worker has freed: Arrow's pool and the C heap
    keep it otherwise, for as long as the worker waits for its next task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't use (column names ignore case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text):
    """Lower-case A-Z only, as the contracts say; NULL stays NULL."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph: rows (node, component)
    with component = the smallest node reachable, for every node that has an
    edge.

    Alternating large-star / small-star rounds over a staged edge table; each
    round is a grouped minimum (combined map-side) and a join back on the
    node.  Rounds grow with the logarithm of the graph's size, and no group is
    gathered in one place.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
        .filter("u <> v").distinct()
    e = staged(e, "cc")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: every larger end u of an edge keeps its smallest partner
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v")))
        e = staged(small.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "cc")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


#: Bits of a key filter: 4 MB, whatever the number of keys.
FILTER_BITS = 1 << 25


def key_filter(keys: DataFrame, col: str):
    """A test ``Column -> Column`` (boolean) that holds for every value of the
    long column ``col`` and for few others, to thin rows ahead of a shuffle.

    It is a bitmap of fixed size, so what is collected and broadcast is
    bounded.  With many more keys than bits it lets everything pass, which
    costs the shuffle that it would have saved and changes no result.
    """
    slot = F.pmod(F.xxhash64(col), F.lit(FILTER_BITS))
    words = keys.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("b")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words["w"].to_numpy()] = words["b"].to_numpy()
    shared = keys.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def maybe(s: pd.Series) -> pd.Series:
        s = s.to_numpy(np.int64)
        return pd.Series(shared.value[s >> 6] >> (s & 63) & 1 == 1)

    return lambda c: maybe(F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)))
