"""Surrogate keys (W1-W3) and unknown members.

``assign_keys`` gives the same numbers as ``row_number() OVER (ORDER BY ...)``
without funnelling every row through one task, which is what a window with
no PARTITION BY does:

1. range-partition on the full ordering and sort inside each partition,
   so partition i holds only keys below those of partition i+1 (equal
   ordering tuples always land in one partition);
2. write that layout, with each row's partition id and position as
   columns, as a Parquet table under the shared checkpoint folder, so the
   positions are fixed even if an executor is lost and tasks rerun (one
   write; an eager ``checkpoint()`` would compute the input twice);
3. count rows per partition (one row per partition: a proven size bound),
   prefix-sum the counts and broadcast them back;
4. key = start + rows in earlier partitions + position inside the partition.

The count is an aggregation over the staged table and the join with the
offsets is a broadcast, so the data itself is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import CODEC, scratch_path

_PID, _MID, _OFF, _N = "_sl_pid", "_sl_mid", "_sl_off", "_sl_n"


def _order(c) -> Column:
    return F.col(c).asc_nulls_first() if isinstance(c, str) else c


def assign_keys(df: DataFrame, order_cols, key: str, start: int = 1) -> DataFrame:
    """Dense keys start, start+1, ... in the order of ``order_cols``
    (ascending, NULLs first).  Rows that tie on every ordering column get
    consecutive keys in an arbitrary but fixed order."""
    if key.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"key column {key!r} collides with an input column")
    order = [_order(c) for c in order_cols]
    return _numbered(df.repartitionByRange(*order).sortWithinPartitions(*order), key, start)


def number_rows(df: DataFrame, key: str, start: int = 1) -> DataFrame:
    """Dense keys start, start+1, ... in no particular order: as
    ``assign_keys`` without its shuffle and sort.  ``df`` is computed once."""
    if key.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"key column {key!r} collides with an input column")
    return _numbered(df, key, start)


def _numbered(df: DataFrame, key: str, start: int) -> DataFrame:
    """Steps 2 to 4: keys in the order in which the rows lie."""
    spark = df.sparkSession
    path = scratch_path(spark, "keys")
    (df.withColumn(_PID, F.spark_partition_id())
     .withColumn(_MID, F.monotonically_increasing_id())
     .write.option("compression", CODEC).parquet(path))
    staged = spark.read.parquet(path)
    counts = staged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        _PID, F.coalesce(F.sum(_N).over(before), F.lit(0)).cast("long").alias(_OFF))
    position = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (
        staged.join(F.broadcast(offsets), _PID)
        .withColumn(key, (F.lit(start).cast("long") + F.col(_OFF) + position))
        .drop(_PID, _MID, _OFF)
    )


def with_unknown_member(dim: DataFrame, row: dict, key: str) -> DataFrame:
    """J8 + W6: add the unknown row (key -1 by convention) unless a row with
    that key already exists.  The existence probe is capped at one row, so
    the anti-join's build side has a proven size of one."""
    unknown = literal_row(dim.sparkSession, dim.schema, row)
    present = dim.filter(F.col(key) == F.lit(row[key])).select(key).limit(1)
    return unknown.join(F.broadcast(present), key, "left_anti").unionByName(dim)


def literal_row(spark, schema: T.StructType, values: dict) -> DataFrame:
    """One row of literals with ``schema``'s names and types, built on the
    JVM side (``createDataFrame`` from a Python list would start a Python
    worker in every slice it is parallelised into)."""
    return spark.range(0, 1, 1, 1).select(*[
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


#: Bytes of values that are broadcast at most, whatever the number of rows.
BROADCAST_MAX_BYTES = 128 << 20


def fits(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes
    of values: one aggregate, of which each task sends one row."""
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        width = width + (F.coalesce(F.octet_length(c), F.lit(0)) if isinstance(f.dataType, (T.StringType, T.BinaryType))
                         else F.lit(8)).cast("long")
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast-hint ``df`` only after checking its rows and bytes;
    otherwise leave the choice (shuffle join, AQE) to the planner."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
