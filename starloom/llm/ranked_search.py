"""Operator 12: ranked lexical search by MaxScore with bounds of term pairs.

Index, built before any item is scored:

- documents are counted into terms where they lie; only terms that some item
  may hold (a bitmap of fixed size over hashes of the items' terms) leave the
  task, and a join with the items' terms ends the choice at any size of them;
- postings are dealt by a hash of the document to *shards* of bounded size;
  a shard holds, for each term, its documents and their impacts
  ``(10^9 * tf) div (1000 * tf + 12 * m)``;
- for each pair of neighbouring terms of an item (terms in falling order of
  weight) and each shard, an *intersection list*: the documents that hold
  both terms, and the largest sum that the two reach together.

Query: items are repeated for each shard, in blocks.  An item's pairs are
taken in falling order of their bounds, where the bound of a pair is what one
term alone or both together can reach in the shard, not the sum of both
terms' maxima.  Once the pairs that are left can't lift an unseen document to
the k-th best sum so far, only the documents seen are completed; each
one's own bound has the joint maximum where the intersection list holds the
document, else the larger maximum of one term, and falls out below the k-th
best.  Each shard gives its k best; a grouped top-k over shards ends it.
Bounds only skip work: scores are exact and ties go by document id.

Defined results: NULL and empty texts have no terms, give no rows and are not
counted; repeated rows and shared ids are documents (items) of their own;
NULL document ids come last among ties; scores of 0 are left out; empty
tables give no rows.  Further columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starloom.llm.common import staged

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 20
#: Postings and documents of a shard, items of a block.
SHARD_POSTINGS = 300_000
SHARD_DOCS = 8192
ITEM_BLOCK = 64
#: Bits of the bitmap of the items' terms: 4 MB, whatever their number.
BITS = 1 << 25

_UPPER = {i: i + 32 for i in range(65, 91)}


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


# -- counting ----------------------------------------------------------------

def _counts(texts: DataFrame, bitmap=None) -> DataFrame:
    """(row, id, n, terms, tfs) of rows (row, id, text): n counts all terms,
    ``terms`` holds the distinct ones that the bitmap lets through."""
    ddl = f"row long, id {texts.schema['id'].dataType.simpleString()}, n long, terms array<string>, tfs array<long>"
    schema = _arrow(ddl)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, bits = re.compile(TERM).findall, bitmap.value if bitmap else None
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in batch.column("text"):
                found = Counter(find(text.as_py() or ""))
                n.append(sum(found.values()))
                folded: Counter = Counter()
                for term, k in found.items():
                    folded[term.lower() if term.isascii() else term.translate(_UPPER)] += k
                if bits is not None:
                    slots = [(t, zlib.crc32(t.encode()) % BITS) for t in folded]
                    folded = {t: folded[t] for t, s in slots if bits[s >> 3] >> (s & 7) & 1}
                terms.append(list(folded))
                tfs.append(list(folded.values()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(n, pa.int64()),
                                              pa.array(terms, schema.field("terms").type), pa.array(tfs, schema.field("tfs").type)], schema=schema)

    return texts.mapInArrow(count, ddl)


def _bitmap(vocabulary: DataFrame):
    """Broadcast bitmap over hashes of the terms; what is collected is bounded by its size."""
    slot = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(BITS))
    words = vocabulary.select(slot.alias("s")).groupBy(F.shiftright("s", 3).alias("w")) \
        .agg(F.bit_or(F.expr("shiftleft(1, cast(s % 8 as int))")).alias("b")).toArrow()
    bits = np.zeros(BITS // 8, np.uint8)
    bits[words["w"].to_numpy()] = words["b"].to_numpy()
    return vocabulary.sparkSession.sparkContext.broadcast(bits.tobytes())


# -- index -------------------------------------------------------------------

class Shard:
    """Postings of some documents; documents are places in the order of ties."""

    def __init__(self, rows: list, ids: list, terms: list, ends: list, docs: bytes, impacts: bytes):
        self.rows, self.ids, self.size = rows, ids, len(rows)
        self.place = {t: i for i, t in enumerate(terms)}
        self.ends = [0, *ends]
        self.docs, self.impacts = np.frombuffer(docs, np.int32), np.frombuffer(impacts, np.int32)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray] | None:
        i = self.place.get(term)
        if i is None:
            return None
        span = slice(self.ends[i], self.ends[i + 1])
        return self.docs[span], self.impacts[span].astype(np.int64)


_SHARD = "shard int, rows array<long>, ids array<long>, terms array<long>, ends array<long>, docs binary, impacts binary"


def _pack_shard(schema: pa.Schema):
    def pack(t: pa.Table) -> pa.Table:
        row, term = t.column("row").to_numpy(), t.column("term_id").to_numpy()
        ids = t.column("id")
        key = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        rows, first = np.unique(row, return_index=True)
        order = np.lexsort((rows, key[first], ids.is_null().to_numpy()[first]))
        place = np.empty(len(rows), np.int32)
        place[order] = np.arange(len(rows), dtype=np.int32)
        docs = place[np.searchsorted(rows, row)]
        by = np.lexsort((docs, term))
        terms, counts = np.unique(term, return_counts=True)
        return pa.Table.from_pydict({
            "shard": [t.column("shard")[0].as_py()], "rows": [rows[order]], "ids": [ids.take(pa.array(first[order])).to_pylist()],
            "terms": [terms], "ends": [np.cumsum(counts)], "docs": [docs[by].tobytes()],
            "impacts": [t.column("impact").to_numpy().astype(np.int32)[by].tobytes()]}, schema)
    return pack


def _index(counts: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, int, int]:
    """Shards, their number and the number of documents with terms."""
    n, length, postings = counts.filter("n > 0").agg(
        F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    shards = max(1, -(-postings // SHARD_POSTINGS), -(-n // SHARD_DOCS))
    m = F.expr(f"75L + (25L * n * {n}L) div {max(length, 1)}L")
    flat = counts.select("row", "id", m.alias("m"), F.explode(F.arrays_zip("terms", "tfs")).alias("x")) \
        .select("row", "id", "m", F.col("x.terms").alias("term"), F.col("x.tfs").alias("tf")).join(vocabulary, "term")
    dealt = flat.select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), "row", "id", "term_id",
                        F.expr("(1000000000L * tf) div (1000L * tf + 12L * m)").alias("impact"))
    packed = dealt.groupBy("shard").applyInArrow(_pack_shard(_arrow(_SHARD)), _SHARD)
    return staged(packed, "search-index"), shards, n


_ITEMS = "block int, items array<long>, terms array<array<long>>, weights array<array<long>>, counts array<array<long>>"
_PAIRS = "shard int, block int, a array<long>, b array<long>, joint array<long>, ends array<long>, docs binary"


def _items(counts: DataFrame, vocabulary: DataFrame, index: DataFrame, n: int) -> DataFrame:
    """Blocks of items: terms in falling order of weight, weight and number of each."""
    df = index.select(F.posexplode("terms").alias("i", "term_id"), "ends") \
        .select("term_id", F.expr("ends[i] - if(i = 0, 0L, ends[i - 1])").alias("df")).groupBy("term_id").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n + 2.0) / (2 * F.col("df") + 1).cast("double")))
    flat = counts.select("row", F.explode(F.arrays_zip("terms", "tfs")).alias("x")) \
        .select("row", F.col("x.terms").alias("term"), F.col("x.tfs").alias("c")) \
        .join(vocabulary, "term").join(df.select("term_id", weight.alias("w")), "term_id").filter("w > 0")
    each = flat.groupBy("row").agg(F.sort_array(F.collect_list(F.struct((-F.col("w")).alias("w"), "term_id", "c"))).alias("t"))
    blocks = max(1, -(-counts.count() // ITEM_BLOCK))
    return each.groupBy(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block")) \
        .agg(F.collect_list(F.struct("row", "t")).alias("x")) \
        .select("block", F.col("x.row").alias("items"), F.transform("x", lambda i: i["t"]["term_id"]).alias("terms"),
                F.transform("x", lambda i: F.transform(i["t"]["w"], lambda w: -w)).alias("weights"),
                F.transform("x", lambda i: i["t"]["c"]).alias("counts"))


def pair_lists(shard: Shard, items: Iterator[tuple[list, list]]) -> list[tuple]:
    """(a, b, joint, docs) of the distinct neighbouring pairs of these items
    (terms, weights) that some document of the shard holds."""
    out, seen, impact = [], set(), np.zeros(shard.size, np.int64)
    for terms, weights in items:
        for (a, b), (wa, wb) in zip(zip(terms[::2], terms[1::2], strict=False), zip(weights[::2], weights[1::2], strict=False), strict=True):
            if (a, b) in seen:
                continue
            seen.add((a, b))
            one, two = shard.postings(a), shard.postings(b)
            if one is None or two is None:
                continue
            impact[one[0]] = one[1]
            both = impact[two[0]]
            at = np.flatnonzero(both)
            impact[one[0]] = 0
            if len(at):
                out.append((a, b, int((wa * both[at] + wb * two[1][at]).max()), two[0][at]))
    return out


# -- query -------------------------------------------------------------------

def best_of_shard(shard: Shard, pairs: dict, terms: list, weights: list, counts: list, k: int) -> list[tuple[int, int]]:
    """(place, score) of the k best documents of the shard, best first."""
    units = []
    for i in range(0, len(terms), 2):
        lists = []
        for t, w, c in zip(terms[i:i + 2], weights[i:i + 2], counts[i:i + 2], strict=True):
            found = shard.postings(t)
            if found is not None:
                lists.append((found[0], found[1] * (w * c)))
        if not lists:
            continue
        tops = [int(x[1].max()) for x in lists]
        joint, both = pairs.get((terms[i], terms[i + 1]), (0, None)) if len(lists) == 2 else (0, None)
        joint = min(sum(tops), joint * max(counts[i:i + 2]))
        units.append((max(*tops, joint), max(tops), joint, both, lists))
    units.sort(key=lambda u: -u[0])
    rest = np.append(np.cumsum([u[0] for u in units][::-1])[::-1], 0)
    sums, bar, at = np.zeros(shard.size, np.int64), 0, 0
    while at < len(units):
        for docs, scores in units[at][4]:
            sums[docs] += scores
        at += 1
        if shard.size > k and rest[at] < sums.max():
            bar = int(np.partition(sums, -k)[-k])
            if rest[at] < bar:
                break
    places = np.flatnonzero(sums) if not bar else np.flatnonzero((sums > 0) & (sums + rest[at] >= bar))
    scores = sums[places]
    # what each document that is left can still get
    more, held = np.zeros(len(places), np.int64), []
    for _, single, joint, both, _ in units[at:]:
        own = np.full(len(places), single, np.int64)
        if joint > single:
            mark = np.zeros(shard.size, bool)
            mark[both] = True
            own[mark[places]] = joint
        held.append(own)
        more += own
    alive = np.arange(len(places))
    for (_, _, _, _, lists), own in zip(units[at:], held, strict=True):
        if len(alive) > k:
            bar = max(bar, int(np.partition(scores[alive], -k)[-k]))
            alive = alive[scores[alive] + more[alive] >= bar]
        for docs, got in lists:
            full = np.zeros(shard.size, np.int64)
            full[docs] = got
            scores[alive] += full[places[alive]]
        more -= own
    places, scores = places[alive], scores[alive]
    if len(places) > k:
        left = scores >= np.partition(scores, -k)[-k]
        places, scores = places[left], scores[left]
    order = np.lexsort((places, -scores))[:k]
    return list(zip(places[order].tolist(), scores[order].tolist(), strict=True))


def _shard_of(r: dict) -> Shard:
    return Shard(r["rows"], r["ids"], r["terms"], r["ends"], r["docs"], r["impacts"])


def _meet(items: DataFrame, index: DataFrame, shards: int, pairs: DataFrame | None, work, ddl: str) -> DataFrame:
    """Apply ``work(shard, row)`` to each shard and block of items; a task
    gets pairs of packed rows, in batches that are bounded by bytes."""
    schema = _arrow(ddl)
    asked = items.select("block", "items", F.col("terms").alias("i_terms"), "weights", "counts",
                         F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    # never a broadcast: an estimate of the items' size would not know how often they are repeated
    met = asked.join(index.hint("shuffle_hash"), "shard")
    if pairs is not None:
        met = met.join(pairs.select("shard", "block", "a", "b", "joint", F.col("ends").alias("p_ends"), F.col("docs").alias("p_docs"))
                       .hint("shuffle_hash"), ["shard", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, shard = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if last != r["shard"]:
                    last, shard = r["shard"], _shard_of(r)
                found = work(shard, r)
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema)

    return met.mapInArrow(run, ddl)


def search(documents: DataFrame, items: DataFrame, *, k: int = TOP) -> DataFrame:
    """The k best documents (id, text) for each item (id, text): item row,
    item, rank, doc and score."""
    def keyed(df):
        return df.select(F.monotonically_increasing_id().alias("row"), "id", "text")

    asked = staged(_counts(keyed(items)), "search-items")
    terms = asked.select(F.explode("terms").alias("term")).distinct()
    vocabulary = staged(terms.select("term", F.monotonically_increasing_id().alias("term_id")), "search-terms")
    counts = staged(_counts(keyed(documents.select(F.col("id").cast("long").alias("id"), "text")), _bitmap(vocabulary)), "search-counts")
    index, shards, n = _index(counts, vocabulary)
    blocks = staged(_items(asked, vocabulary, index, n), "search-blocks")

    def build(shard: Shard, r: dict) -> list[dict]:
        found = pair_lists(shard, zip(r["i_terms"], r["weights"], strict=True))
        kind = np.uint16 if shard.size <= 1 << 16 else np.int32
        docs = [x[3].astype(kind) for x in found]
        return [{"shard": r["shard"], "block": r["block"], "a": [x[0] for x in found], "b": [x[1] for x in found],
                 "joint": [x[2] for x in found], "ends": np.cumsum([0, *map(len, docs)])[1:].tolist(), "docs": b"".join(x.tobytes() for x in docs)}]

    pairs = staged(_meet(blocks, index, shards, None, build, _PAIRS), "search-pairs")

    def ask(shard: Shard, r: dict) -> list[dict]:
        docs = np.frombuffer(r["p_docs"], np.uint16 if shard.size <= 1 << 16 else np.int32)
        ends = [0, *r["p_ends"]]
        lists = {(a, b): (j, docs[ends[i]:ends[i + 1]]) for i, (a, b, j) in enumerate(zip(r["a"], r["b"], r["joint"], strict=True))}
        return [{"item": item, "row": shard.rows[p], "doc": shard.ids[p], "score": s}
                for item, t, w, c in zip(r["items"], r["i_terms"], r["weights"], r["counts"], strict=True)
                for p, s in best_of_shard(shard, lists, t, w, c, k)]

    found = _meet(blocks, index, shards, pairs, ask, "item long, row long, doc long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = asked.select(F.col("row").alias("item"), F.col("id").alias("item_id"))
    return ranked.join(names, "item").select("item", "item_id", "rank", "doc", "score")


def digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contract rows of ``op12_ranked_search``."""
    out = search(documents.select(F.col("doc_id").alias("id"), "text"), benchmark.select(F.col("item_id").alias("id"), "text"))
    return out.select("item_id", "rank", F.col("doc").alias("doc_id"), "score")


#: DuckDB
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL
),
i AS (
  SELECT row_number() OVER () AS r, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM benchmark WHERE text IS NOT NULL
),
totals AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
asked AS (SELECT r, item_id, term, count(*) AS c FROM (SELECT r, item_id, unnest(t) AS term FROM i) GROUP BY ALL),
postings AS (
  SELECT r, doc_id, len, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(t) AS len, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
),
weights AS (
  SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals
),
scores AS (
  SELECT a.r, a.item_id, p.r AS doc, p.doc_id,
         sum(a.c * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.len * t.n) // t.l))))::BIGINT AS score
  FROM asked a JOIN postings p USING (term) JOIN weights w USING (term), totals t
  GROUP BY ALL
)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY r ORDER BY score DESC, doc_id, doc)
QUALIFY rank <= 20
"""
