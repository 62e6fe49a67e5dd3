"""Operator 11: hard negatives by a vertical scan with shrinking bounds.

Vectors are packed into *row blocks* that hold them by dimension (one array
for each dimension, with its minimum and maximum).  An anchor meets a block
as a whole and reads its dimensions in the order of the anchor's own
magnitudes, largest first.  After each few dimensions a candidate's score
lies between its sum so far plus the least and plus the most that the
remaining dimensions can add (minimum and maximum of each dimension in the
block).  Candidates that these bounds rule out leave the bitmap; those that
are left at the end have exact scores.

Two such scans, each over every (anchor block, row block) pair:

1. *positives*: rows of the anchor's label; ruled out once the most that a
   row can reach is below the k-th largest of the least that rows reach;
2. *windows*: rows of other labels; each positive's score opens a window, and
   a row is ruled out once its bounds miss all windows, or within a window
   once enough rows surely lie above it.

Each block gives its own best rows, and a grouped top-k over blocks ends the
scan.  Blocks are bounded in bytes and filled by a hash of the row, so no
label or group of copies makes a large one; anchor blocks (a stated query
set) are repeated for each row block, rows never.

Defined results: rows with a NULL label, a NULL vector or a NULL or
non-finite component take no part; a vector shorter than another counts as
padded with zeros; the sum wraps nowhere (floats up to 2^24, doubles up to
2^53, longs beyond; an error if a long can't hold a score).  Rows that share
an id are rows of their own, each an anchor of its own; a NULL id is no
anchor and comes last among ties.  Windows are closed, so equal scores in
them are all candidates, ordered by id.  No anchors, no rows of a label but
the anchor itself, an empty window or an empty table give no rows.  Further
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starloom.llm.common import staged

#: Bytes and rows of a row block, rows of an anchor block.
BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 4096
ANCHOR_ROWS = 128
#: Dimensions read between two looks at the bounds: first, then twice as many each time.
FIRST_DIMS = 8

POSITIVES = 5
NEGATIVES = 3
#: A negative scores between these percentages of its positive.
LOW, HIGH = 50, 95


# -- the scan ----------------------------------------------------------------

class Block:
    """Vectors by dimension, with what each dimension ranges over."""

    def __init__(self, ids: list, rows: np.ndarray, labels: np.ndarray, values: bytes, dims: int):
        self.ids, self.rows, self.labels = ids, rows, labels
        self.columns = np.frombuffer(values, np.int64).reshape(dims, len(ids))
        self.low, self.high = (self.columns.min(1), self.columns.max(1)) if len(ids) else (np.zeros(dims, np.int64),) * 2
        self.typed: dict = {}

    def as_type(self, kind) -> np.ndarray:
        if kind not in self.typed:
            self.typed[kind] = self.columns.astype(kind)
        return self.typed[kind]


def exact_type(query: np.ndarray, block: Block):
    """The fastest type in which no partial sum of this product is rounded."""
    most = sum(abs(int(q)) * max(abs(int(a)), abs(int(b))) for q, a, b in zip(query, block.low, block.high, strict=True))
    if most >= 1 << 63:
        raise OverflowError("a score does not fit into a long")
    return np.float32 if most <= 1 << 24 else np.float64 if most <= 1 << 53 else np.int64


def vertical_scan(query: np.ndarray, block: Block, bitmap: np.ndarray, keep: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the rows of ``bitmap`` that ``keep`` never
    ruled out; ``keep(least, most)`` gets bounds of the scores."""
    kind = exact_type(query, block)
    order = np.argsort(-np.abs(query), kind="stable")
    q, columns = query[order], block.as_type(kind)
    ends = q * block.low[order], q * block.high[order]
    least, most = (np.append(np.cumsum(f(*ends)[::-1])[::-1], 0) for f in (np.minimum, np.maximum))
    q = q.astype(kind)
    alive = np.flatnonzero(bitmap)
    sums, at, step = np.zeros(len(alive), kind), 0, FIRST_DIMS
    while at < len(q) and len(alive):
        dims = order[at:at + step]
        if 2 * len(alive) > columns.shape[1]:
            sums = sums + (q[at:at + step] @ columns[dims])[alive]
        else:
            sums = sums + q[at:at + step] @ columns[np.ix_(dims, alive)]
        at, step = at + len(dims), step * 2
        known = sums.astype(np.int64)
        left = keep(known + least[at], known + most[at])
        alive, sums = alive[left], sums[left]
    return alive, sums.astype(np.int64)


def best_positives(query: np.ndarray, label: int, row: int, block: Block, k: int) -> list[tuple[int, int]]:
    """(place, score) of the block's k best rows of this label but ``row``."""
    def keep(least, most):
        return most >= np.partition(least, -k)[-k] if len(least) > k else np.ones(len(least), bool)

    places, scores = vertical_scan(query, block, (block.labels == label) & (block.rows != row), keep)
    best = np.lexsort((places, -scores))[:k]  # places are in the order of ids
    return list(zip(places[best].tolist(), scores[best].tolist(), strict=True))


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest whole score s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def best_in_windows(query: np.ndarray, label: int, windows: list[tuple[int, int]], block: Block, k: int) -> list[list[tuple[int, int]]]:
    """For each window, (place, score) of the block's k best rows of other labels in it."""
    def keep(least, most):
        left = np.zeros(len(least), bool)
        for a, b in windows:
            sure = least[(least >= a) & (most <= b)]
            bar = max(a, np.partition(sure, -k)[-k]) if len(sure) > k else a
            left |= (most >= bar) & (least <= b)
        return left

    if all(a > b for a, b in windows):
        return [[] for _ in windows]
    places, scores = vertical_scan(query, block, block.labels != label, keep)
    order = np.lexsort((places, -scores))
    places, scores = places[order], scores[order]
    out = []
    for a, b in windows:
        at = np.flatnonzero((scores >= a) & (scores <= b))[:k]
        out.append(list(zip(places[at].tolist(), scores[at].tolist(), strict=True)))
    return out


# -- jobs --------------------------------------------------------------------

def quantised(embeddings: DataFrame, *, scale: int = 256) -> DataFrame:
    """(row, id, label, v): floor(scale * component) of the rows that take part."""
    x = F.col("embedding")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return embeddings.filter(F.col("label").isNotNull() & x.isNotNull()).filter(sound).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(scale * v.cast("double"))).alias("v"))


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _pack(dims: int, schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """Rows of a block, in the order of ids, as one row."""
    def pack(t: pa.Table) -> pa.Table:
        ids, rows = t.column("id"), t.column("row").to_numpy()
        key = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        order = np.lexsort((rows, key, ids.is_null().to_numpy()))
        t = t.take(pa.array(order))
        values = np.zeros((len(order), dims), np.int64)
        v = t.column("v").combine_chunks()
        lengths = v.value_lengths().to_numpy()
        values[np.arange(dims) < lengths[:, None]] = v.flatten().to_numpy()
        out = {"block": [t.column("block")[0].as_py()], "ids": [t.column("id").to_pylist()], "rows": [t.column("row").to_pylist()],
               "labels": [t.column("label").to_pylist()], "vals": [values.T.tobytes()]}
        if "positives" in t.column_names:
            out["positives"] = [t.column("positives").to_pylist()]
        return pa.Table.from_pydict(out, schema)
    return pack


_PACKED = "block int, ids array<long>, rows array<long>, labels array<long>, vals binary"
_POSITIVES = "array<struct<p: int, id: long, score: long>>"


def _blocks(df: DataFrame, dims: int, size: int) -> tuple[DataFrame, int]:
    n = max(1, -(-df.count() // size))
    block = F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias("block")
    packed = _PACKED + (f", positives array<{_POSITIVES}>" if "positives" in df.columns else "")
    return staged(df.select(block, *df.columns).groupBy("block").applyInArrow(_pack(dims, _arrow(packed)), packed), "bond-blocks"), n


def _meet(anchors: DataFrame, blocks: DataFrame, n_blocks: int, scan: Callable, schema: str) -> DataFrame:
    """Apply ``scan(query, anchor, block)`` to each anchor and row block.

    A task gets pairs of packed blocks; Arrow batches of them are bounded by
    bytes, and a row block is unpacked once for the anchor blocks that follow
    each other."""
    a = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns if c != "block"],
                       F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                pair = {c: batch.column(c)[r] for c in batch.schema.names}
                if last != pair["block"].as_py():
                    ids, values = pair["ids"].as_py(), pair["vals"].as_py()
                    last = pair["block"].as_py()
                    block = Block(ids, pair["rows"].values.to_numpy(), pair["labels"].values.to_numpy(), values, len(values) // 8 // len(ids))
                rows, labels = pair["a_rows"].as_py(), pair["a_labels"].as_py()
                ids = pair["a_ids"].as_py()
                queries = np.frombuffer(pair["a_vals"].as_py(), np.int64).reshape(-1, len(rows)).T
                positives = pair["a_positives"].as_py() if "a_positives" in pair else [None] * len(rows)
                found = [x for i, q in enumerate(queries) for x in scan(q, (rows[i], ids[i], labels[i], positives[i]), block)]
                if found:
                    yield pa.RecordBatch.from_pylist([dict(zip(out.names, x, strict=True)) for x in found], out)

    out = _arrow(schema)
    # never a broadcast: an estimate of the anchors' size would not know how often they are repeated
    return a.join(blocks.hint("shuffle_hash"), "block").mapInArrow(run, schema)


def hard_negatives(vectors: DataFrame, *, anchor_every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """Hard negatives of ``vectors`` (row, id, label, v), v of longs: for each
    anchor (id divisible by ``anchor_every``) and each of its positives, the
    best rows of other labels that score from ``low`` to ``high`` percent of
    the positive."""
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    base = staged(vectors, "bond-vectors")
    dims = base.agg(F.max(F.size("v"))).first()[0]
    if not dims:  # no rows, or only empty vectors: all scores are 0
        dims = 1
    blocks, n = _blocks(base, dims, max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dims))))
    asked = base.filter((F.col("id") % anchor_every) == 0)
    anchors, _ = _blocks(asked, dims, ANCHOR_ROWS)

    def by_label(query, anchor, block):
        row, _, label, _ = anchor
        return [(row, block.ids[p], int(block.rows[p]), s) for p, s in best_positives(query, label, row, block, positives)]

    near = _meet(anchors, blocks, n, by_label, "a_row long, id long, row long, score long")
    order = Window.partitionBy("a_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    best = near.withColumn("p", F.row_number().over(order)).filter(F.col("p") <= positives)
    found = staged(best.groupBy("a_row").agg(F.sort_array(F.collect_list(F.struct("p", "id", "score"))).alias("positives")), "bond-positives")
    anchors, _ = _blocks(asked.join(found.withColumnRenamed("a_row", "row"), "row"), dims, ANCHOR_ROWS)

    def by_window(query, anchor, block):
        row, a_id, label, wanted = anchor
        spans = [window(p["score"], low, high) for p in wanted]
        return [(row, a_id, p["p"], p["id"], p["score"], block.ids[i], int(block.rows[i]), s)
                for p, best in zip(wanted, best_in_windows(query, label, spans, block, negatives), strict=True) for i, s in best]

    far = _meet(anchors, blocks, n, by_window, "a_row long, a_id long, p int, p_id long, p_score long, id long, row long, score long")
    order = Window.partitionBy("a_row", "p").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    ranked = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select(F.col("a_id").alias("anchor_id"), F.col("p_id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
                         F.col("p_score").alias("positive_score"), F.col("score").alias("negative_score")) \
        .selectExpr(*[f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in out.split(", ")])


def digest(embeddings: DataFrame) -> DataFrame:
    """Contract rows of ``op11_hard_negatives``."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives(quantised(embeddings.select("vec_id", moved.alias("label"), "embedding")))


#: DuckDB: exact in doubles while scores stay below 2^53.
ORACLE = """
WITH v AS (
  SELECT vec_id AS id,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.id AS anchor, a.label AS own, b.id, b.label, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 50 = 0
),
positives AS (
  SELECT anchor, id, score FROM scores WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5
),
negatives AS (
  SELECT p.anchor, p.id AS positive, p.score AS positive_score, s.id, s.score,
         row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM positives p JOIN scores s ON s.anchor = p.anchor AND s.label <> s.own
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor AS anchor_id, positive AS positive_id, rank::INTEGER AS rank, id AS negative_id,
       positive_score, score AS negative_score
FROM negatives WHERE rank <= 3
"""
