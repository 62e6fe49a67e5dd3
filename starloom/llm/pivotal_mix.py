"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target in words; a document of it is taken target /
source size times on average.  The whole part of that is taken for certain.
The fractional parts are rounded by the pivotal method: two documents meet,
one hands probability mass to the other at random (keeping both expectations)
until one of them is at 0 or 1, and the one still in between meets the next.

Documents meet in blocks of about ``BLOCK`` of one source and of nearly the
same size, so mass moves between documents of like size and a source's taken
words stay near its target.  What a block leaves over (one document at most)
goes up a reduction tree of blocks of blocks, ``BLOCK`` at a time; only the
last one of a source is drawn alone.  No group holds more than a block, so a
source with a third of all rows is no hotter than any other, and neither is an
id: documents of one id, source and size can't be told apart and are numbered
first, so that each goes to a block of its own choice.

DataFrame functions only.  Draws are hashes of ids and a seed, so reruns and
recomputed tasks agree.

NULL texts have size 0, NULL sources are a source of their own and come last;
documents without words are taken 0 times; repeated rows are rounded one by
one; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import ASCII_WORD, staged

BLOCK = 64
#: Documents within 2 ** (1 / SIZE_STEPS) of each other in size share a class.
SIZE_STEPS = 16
#: A probability this near to 0 or 1 is one.
EPS = 1e-9
#: Documents of one id, source and size that a task numbers at once.
RUN = 1024
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(ASCII_WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source: src (text), no (its rank by code point, NULL
    last), source_size and target.

    Targets share the total by weight, at most ``max_repeat`` times a
    source's size; the excess is reshared among the rest.  In the order of
    cap / weight the capped sources are the first k, so prefix sums give the
    share per weight for every k, and the first k whose next source is below
    its cap is the answer.  The windows run over one row per source.
    """
    per = sized.groupBy("src").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("src").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("no", F.row_number().over(by_name)) \
        .withColumn("w", F.element_at(cycle, (F.pmod(F.col("no") - 1, F.lit(len(weights))) + 1).cast("int"))) \
        .withColumn("cap", F.col("source_size").cast("double") * max_repeat)
    order = Window.orderBy(F.col("cap") / F.col("w"), "no")
    before, after, everything = order.rowsBetween(Window.unboundedPreceding, -1), \
        order.rowsBetween(Window.currentRow, Window.unboundedFollowing), Window.partitionBy()
    share = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        / F.sum("w").over(after)
    per = per.withColumn("share", share)
    # a source is free if the share of it and all after it stays below its cap
    first = F.min(F.when(F.col("share") * F.col("w") < F.col("cap"), F.struct(F.col("cap") / F.col("w"), "no", "share")))
    per = per.withColumn("free", first.over(everything))
    return per.select("src", "no", "source_size", F.least(
        F.col("cap"), F.coalesce(F.col("free.share") * F.col("w"), F.col("cap"))).alias("target"))


def numbered(counted: DataFrame) -> DataFrame:
    """A row (id, src, size, copy) for each document of (id, src, size, n);
    rows that many documents share are dealt to tasks in runs of ``RUN``."""
    cols = ["id", "src", "size"]
    runs = counted.filter(F.col("n") > RUN) \
        .select(*cols, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long"))).alias("at")) \
        .repartition("at", *cols)
    many = runs.select(*cols, F.explode(F.sequence("at", F.least("n", F.col("at") + RUN) - 1)).alias("copy"))
    few = counted.filter(F.col("n") <= RUN).select(*cols, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    return few.unionByName(many)


def _draw(seed: int, *cols) -> Column:
    """Uniform in [0, 1), the same for the same ids."""
    return F.shiftrightunsigned(F.xxhash64(*cols, F.lit(seed)), 11).cast("double") / F.lit(2.0 ** 53)


def _fold(items: Column, id_type: str, seed: int) -> Column:
    """Pivotal rounding along an array of (size, id, p): a struct of the
    documents decided (size, id, up) and the one left (p is 0 or 1 for none)."""
    done_type = f"array<struct<size:bigint,id:{id_type},up:boolean>>"
    left_type = f"struct<size:bigint,id:{id_type},p:double>"

    def decided(x, up):
        return F.struct(x["size"].alias("size"), x["id"].alias("id"), up.alias("up"))

    def step(a, x):
        left = a["left"]
        s = left["p"] + x["p"]
        u = _draw(seed, left["id"], x["id"])
        # below 1 in sum one of them goes to 0, from 1 on one of them goes to 1
        stays = F.when(s < 1, u < left["p"] / s).otherwise(u >= (1 - x["p"]) / (2 - s))
        carry = F.when(s < 1, s).otherwise(s - 1)
        keep = F.struct(F.when(stays, left["size"]).otherwise(x["size"]).alias("size"),
                        F.when(stays, left["id"]).otherwise(x["id"]).alias("id"), carry.alias("p"))
        gone = F.when(stays, decided(x, s >= 1)).otherwise(decided(left, s >= 1))
        met = F.struct(F.concat(a["done"], F.array(gone)).cast(done_type).alias("done"), keep.cast(left_type).alias("left"))
        # one that has come to 0 or 1 by itself meets no other
        fixed = (left["p"] <= EPS) | (left["p"] >= 1 - EPS)
        passed = F.struct(F.concat(a["done"], F.array(decided(left, left["p"] > 0.5))).cast(done_type).alias("done"),
                          x.cast(left_type).alias("left"))
        return F.when(fixed, passed).otherwise(met)

    start = F.struct(F.array().cast(done_type).alias("done"), items[0].cast(left_type).alias("left"))
    return F.aggregate(F.slice(items, 2, F.size(items)), start, step)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 7) -> DataFrame:
    """One row per document: the id, source, size, source_size, target and
    copies (how often it is taken, a whole number up to ``max_repeat``)."""
    id_type = dict(docs.dtypes)[id_col]
    counted = staged(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("src"),
                                 word_count(F.col(text_col).cast("string")).alias("size"))
                     .groupBy("id", "src", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    src = staged(targets(counted.select("src", (F.col("size") * F.col("n")).alias("size")), weights, max_repeat), "mix-sources")
    sized = numbered(counted)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate + EPS).cast("int")
    rates = src.select("src", "no", whole.alias("whole"), F.greatest(rate - whole, F.lit(0.0)).alias("p"))
    rated = sized.join(rates, sized["src"].eqNullSafe(rates["src"])) \
        .select("id", "copy", "no", "size", "p", F.when(F.col("size") > 0,
                F.floor(F.log2(F.col("size").cast("double")) * SIZE_STEPS).cast("int")).alias("class"))
    rounded = (F.col("p") > EPS) & (F.col("size") > 0)
    # blocks of a source are numbered from its largest documents to its smallest
    classes = rated.filter(rounded).groupBy("no", "class").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("n"))
    down = Window.partitionBy("no").orderBy(F.desc("class")).rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select("no", "class", "n", F.coalesce(F.sum("n").over(down), F.lit(0)).alias("first"))
    part = F.pmod(F.xxhash64("id", "copy", "size", F.lit(seed)), F.col("n"))
    level = rated.filter(rounded).join(classes, ["no", "class"]) \
        .select("no", (F.col("first") + part).alias("block"), F.struct("size", "id", "p").alias("x"))
    top = classes.agg(F.max(F.col("first") + F.col("n"))).first()[0] or 0
    ends = [rated.filter(~rounded).select("no", "size", "id", F.lit(False).alias("up"))]
    while top:
        # the staged level holds what is decided and what is left over
        folded = staged(level.groupBy("no", "block").agg(F.sort_array(F.collect_list("x"), False).alias("xs"))
                        .select("no", "block", _fold(F.col("xs"), id_type, seed).alias("f")), "mix-level")
        ends.append(folded.select("no", F.explode("f.done").alias("d")).select("no", "d.*"))
        level = folded.select("no", F.shiftright("block", BLOCK.bit_length() - 1).alias("block"), F.col("f.left").alias("x"))
        if top == 1:
            last = level.select("no", "x.*")
            up = F.when(F.col("p") <= EPS, False).when(F.col("p") >= 1 - EPS, True) \
                .otherwise(_draw(seed + 1, F.col("id"), F.col("no")) < F.col("p"))
            ends.append(last.select("no", "size", "id", up.alias("up")))
            break
        top = -(-top // BLOCK)
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    per = src.join(rates.select("no", "whole"), "no")
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("up").cast("int")).otherwise(F.lit(0))
    return out.join(per, "no").select(F.col("id").alias(id_col), F.col("src").alias("source"), "size", "source_size",
                                      "target", copies.cast("int").alias("copies"))


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return mix_sources(docs).select("doc_id", "size", "source_size", "target",
                                    (F.col("size") * F.col("copies")).cast("long").alias("taken"))
