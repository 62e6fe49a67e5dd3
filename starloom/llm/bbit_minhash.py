"""Near-duplicates by b-bit MinHash.

A document's set holds its distinct shingles of ``words`` words (A-Z in lower
case, words split on ASCII white space; a text with fewer words is one
shingle).  ``MINIMA`` minima are taken per set; of each only the lowest
``BITS`` bits are kept, packed into eight longs.  Whole minima are used once,
for band keys: documents that agree on all ``ROWS`` minima of a band are
candidates.  Candidates are thinned by the similarity that the packed bits
give (equal groups of bits counted with bit operations, corrected for groups
that are equal by chance, with ``SIGMAS`` standard errors to spare) and then
confirmed on the full sets.

Result: components of the confirmed links.  Equal sets are merged first, so
exact copies cost a row each.  Within a bucket of a band no list of all pairs
is made.  First each member is tested against the bucket's smallest one.  Then
the buckets whose members are still in different components are dealt to
blocks, where packed signatures are compared in place; members of some likely
pair meet again with their full sets, and the pairs between components are
tested there.  What leaves a block are its members, then the links that join
components.  So every candidate pair either is tested or joins two documents
already connected; none is dropped.

NULL, empty and blank texts have an empty set and link with nothing.  Rows
that share an id are one document in the graph: their sets are linked with
each other, and each row is returned with that component.  Rows with a NULL id
have no component and are kept.  Candidate search misses a link of exactly the
least similarity with a probability below 1e-4 per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import components, fresh, key_filter, release, staged

MINIMA, BITS, ROWS = 128, 4, 5
BANDS = MINIMA // ROWS
WORDS_PACKED = MINIMA * BITS // 64
SIGMAS = 4
#: Members of a bucket that are compared at once.
BLOCK = 512
#: Words whose hash a Python worker remembers (about 0.2 KB each).
REMEMBERED = 100_000
SIGNATURE = [f"s{i}" for i in range(WORDS_PACKED)]

# A-Z to a-z; bytes.split() then splits on the white space of the contract.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_rng = np.random.default_rng(20240607)
_MULT = _rng.integers(0, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, MINIMA, np.uint64)


class _WordHash(dict):
    """Hash per word, computed once; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASH = _WordHash()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    tokens = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASH.__getitem__, tokens), np.uint64, len(tokens))
    k = min(words, len(h))
    out = _mix(h[:len(h) - k + 1] + np.uint64(k))
    for i in range(1, k):
        out = _mix(out + h[i:len(h) - k + 1 + i])
    return np.unique(out)


def minima(s: np.ndarray) -> np.ndarray:
    out = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 256):
        np.minimum(out, (s[at:at + 256, None] * _MULT + _ADD).min(axis=0), out=out)
    return out


def packed(m: np.ndarray) -> np.ndarray:
    """Low bits of the minima, ``64 / BITS`` of them in a long."""
    low = _mix(m) & np.uint64((1 << BITS) - 1)
    shift = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(low.reshape(WORDS_PACKED, -1) << shift, axis=1)


def band_keys(m: np.ndarray) -> np.ndarray:
    rows = m[:BANDS * ROWS].reshape(BANDS, ROWS)
    key = _mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for i in range(ROWS):
        key = _mix(key + rows[:, i])
    return key


def _sketch(rows: Iterator[pd.DataFrame], words: int) -> Iterator[pd.DataFrame]:
    for pdf in rows:
        out = []
        for i, text in zip(pdf["id"], pdf["text"]):
            s = shingles(text, words)
            if len(s):
                m = minima(s)
                out.append((i, len(s), *_same(s), band_keys(m).view(np.int64), *packed(m).view(np.int64)))
            else:
                out.append((i, 0, 0, 0, np.empty(0, np.int64), *[0] * WORDS_PACKED))
        if out:
            yield pd.DataFrame(out, columns=["id", "n", "h1", "h2", "bands", *SIGNATURE])
    release()


def _same(s: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share, as two longs."""
    h = xxhash.xxh128_digest(s.tobytes())
    return int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)


def _sets(rows: Iterator[pd.DataFrame], words: int) -> Iterator[pd.DataFrame]:
    for pdf in rows:
        sets = [shingles(t, words) for t in pdf["text"]]
        same = np.array([_same(s) for s in sets], np.int64).reshape(-1, 2)
        yield pd.DataFrame({"h1": same[:, 0], "h2": same[:, 1], "set": [s.view(np.int64) for s in sets]})
    release()


def estimate(a: list[Column], b: list[Column]) -> Column:
    """Similarity from packed signatures: share of equal bit groups, less
    those equal by chance."""
    differ = None
    for x, y in zip(a, b):
        d = x.bitwiseXOR(y)
        any_bit = d
        for k in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(d, k))
        n = F.bit_count(any_bit.bitwiseAND(F.lit(int("1" * (64 // BITS), 1 << BITS))))
        differ = n if differ is None else differ + n
    chance = 1 / (1 << BITS)
    return ((1 - differ / F.lit(MINIMA)) - chance) / (1 - chance)


def least_estimate(similarity: float) -> float:
    chance = 1 / (1 << BITS)
    p = similarity + (1 - similarity) * chance
    return similarity - SIGMAS * math.sqrt(p * (1 - p) / MINIMA) / (1 - chance)


def _likely(pdf: pd.DataFrame, least: float, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of one block, between components, that the signatures
    find likely: places and estimates.  A pair that shares several buckets
    belongs to the one of the first band."""
    sig = pdf[SIGNATURE].to_numpy(np.int64).view(np.uint64)
    bands = np.array(list(pdf["bands"]), np.int64)
    block, comp, band = pdf["block"].to_numpy(), pdf["component"].to_numpy(), pdf["band"].to_numpy()
    size, side = pdf["n"].to_numpy(), pdf["side"].to_numpy()
    mask, chance = np.uint64(int("1" * (64 // BITS), 1 << BITS)), 1 / (1 << BITS)
    first, found = np.arange(len(pdf)), []
    for step in range(1, len(pdf)):  # each row with the one `step` further on, as far as blocks reach
        first = first[first < len(pdf) - step]
        first = first[block[first] == block[first + step]]
        if not len(first):
            break
        i, j = first, first + step
        ok = (comp[i] != comp[j]) & ((side[i] != side[j]) | (side[i] == 2)) \
            & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
        i, j = i[ok], j[ok]
        differ = np.zeros(len(i), np.int64)
        for w in range(WORDS_PACKED):
            d = sig[i, w] ^ sig[j, w]
            d |= d >> np.uint64(1)
            d |= d >> np.uint64(2)
            differ += np.bitwise_count(d & mask)
        est = ((1 - differ / MINIMA) - chance) / (1 - chance)
        near = est >= least
        i, j, est = i[near], j[near], est[near]
        if len(i):
            shared = bands[i] == bands[j]
            own = shared.argmax(axis=1) == band[i]
            found.append((i[own], j[own], est[own]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*found))


def _members(pdf: pd.DataFrame, least: float, percent: int) -> pd.DataFrame:
    """Rows that are in some likely pair."""
    i, j, _ = _likely(pdf, least, percent)
    return pdf[["block", "node"]].iloc[np.unique(np.r_[i, j])]


def _links(pdf: pd.DataFrame, least: float, percent: int) -> pd.DataFrame:
    """Likely pairs tested on the full sets, likeliest first; pairs that links
    found here already connect need no test."""
    i, j, est = _likely(pdf, least, percent)
    node, comp, sets = pdf["node"].to_numpy(), pdf["component"].to_numpy(), list(pdf["set"])
    up: dict = {}

    def find(x):
        while (y := up.get(x, x)) != x:
            x = y
        return x

    out = []
    for k in np.argsort(-est, kind="stable"):
        a, b = find(comp[i[k]]), find(comp[j[k]])
        if a != b:
            x, y = sets[i[k]], sets[j[k]]
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= percent * (len(x) + len(y) - common):
                up[max(a, b)] = min(a, b)
                out.append((node[i[k]], node[j[k]]))
    return pd.DataFrame(out, columns=["a", "b"]).astype({"a": node.dtype, "b": node.dtype})


def _blocks(rows: Iterator[pd.DataFrame], of, least: float, percent: int) -> Iterator[pd.DataFrame]:
    """Whole blocks to ``of``.  Rows come sorted by block; one cut by a batch's
    end waits."""
    rest = None
    for pdf in rows:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        whole = (pdf["block"] != pdf["block"].iloc[-1]).to_numpy()
        rest = pdf[~whole]
        if whole.any():
            yield of(pdf[whole], least, percent)
    if rest is not None and len(rest):
        yield of(rest, least, percent)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are alike enough: 100 * common >= percent * all."""
    a = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    both = F.size("sa") + F.size("sb")
    return pairs.join(a, "a").join(b, "b").select("a", "b", common.alias("c"), both.alias("s")) \
        .filter(100 * F.col("c") >= percent * (F.col("s") - F.col("c"))).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: the id, n_shingles, component_id and
    kept.  Links: 100 * intersection >= ``percent`` * union."""
    least = least_estimate(percent / 100)
    id_type = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    longs = ", ".join(f"{c} long" for c in SIGNATURE)
    sketch = staged(rows.mapInPandas(
        lambda it: _sketch(it, words), f"id {id_type}, n long, h1 long, h2 long, bands array<long>, {longs}"), "sketch")
    filled = sketch.filter("n > 0 and id is not null")
    # equal sets: one node, numbered as it is written
    nodes = staged(filled.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.any_value(F.struct("n", "bands", *SIGNATURE)).alias("x"))
                   .select(F.monotonically_increasing_id().alias("node"), "first", "h1", "h2", "x.*"), "nodes")
    member = staged(filled.select("id", "h1", "h2").distinct().join(nodes.select("h1", "h2", "node"), ["h1", "h2"]), "members")
    # rows that share an id are one document: their nodes are linked
    shared = member.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("top")).filter("a < top")
    alike = member.join(shared, "id").filter("node <> a").select("a", F.col("node").alias("b"))
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    hubs = staged(banded.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top"),
                                            F.count(F.lit(1)).alias("members"))
                  .filter("hub < top").drop("top"), "hubs")
    maybe = key_filter(hubs, "key")
    buckets = staged(banded.filter(maybe(F.col("key"))).join(hubs, "key"), "buckets")
    asked = staged(buckets.select("node").distinct().join(nodes.select("node", "first", "h1", "h2"), "node"), "asked")
    wanted = key_filter(asked, "first")
    # full sets of documents in some bucket, one text for each
    reps = rows.filter(F.col("id").isNotNull() & F.col("text").isNotNull()).filter(wanted(F.col("id")))
    sets = staged(reps.mapInPandas(lambda it: _sets(it, words), "h1 long, h2 long, set array<long>")
                  .join(asked.select("node", "h1", "h2"), ["h1", "h2"]).select("node", "set").dropDuplicates(["node"]), "sets")
    sig = nodes.select("node", "n", *SIGNATURE)

    def likely(pairs: DataFrame) -> DataFrame:
        a = sig.select(F.col("node").alias("a"), F.col("n").alias("na"), *[F.col(c).alias(f"a{c}") for c in SIGNATURE])
        b = sig.select(F.col("node").alias("b"), F.col("n").alias("nb"), *[F.col(c).alias(f"b{c}") for c in SIGNATURE])
        est = estimate([F.col(f"a{c}") for c in SIGNATURE], [F.col(f"b{c}") for c in SIGNATURE])
        return pairs.join(a, "a").join(b, "b").filter(est >= least) \
            .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b")

    tested = staged(likely(buckets.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
                           .distinct()), "tested")
    links = staged(_confirm(tested, sets, percent).unionByName(alike), "links")
    # buckets whose members are in several components yet; one of many members is dealt to parts, and every pair
    # of parts is a block (in a part's own block all are compared)
    label = staged(components(links), "labels")
    at = buckets.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = at.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("band").alias("band"),
                                  F.count(F.lit(1)).alias("members"), *[F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"x{i}") for i in (0, 1)]) \
        .filter("lo < hi")
    # near copies meet in many buckets of the same members; a pair belongs to the first band it shares, so that one stands for all
    mixed = mixed.groupBy("members", "x0", "x1").agg(F.min(F.struct("band", "key")).alias("first")).select("first.key")
    parts = F.ceil(F.col("members") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = staged(at.join(mixed, "key").withColumn("parts", parts).withColumn("own", own)
                   .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                   .select("node", "component", "band",
                           F.xxhash64("key", F.least("own", "with"), F.greatest("own", "with")).alias("block"),
                           F.when(F.col("own") == F.col("with"), 2).when(F.col("own") < F.col("with"), 0).otherwise(1).alias("side")),
                   "blocks")

    def in_blocks(rows: DataFrame, of, schema: str) -> DataFrame:
        return rows.repartition("block").sortWithinPartitions("block") \
            .mapInPandas(lambda it: _blocks(it, of, least, percent), schema)

    compared = nodes.drop("first", "h1", "h2")
    likely_ones = staged(in_blocks(dealt.join(compared, "node"), _members, "block long, node long"), "likely")
    more = in_blocks(dealt.join(likely_ones, ["block", "node"]).join(compared, "node").join(sets, "node"), _links, "a long, b long")
    label = components(links.unionByName(staged(more, "links")))
    # a component is named by its smallest id
    named = staged(label.join(nodes.select("node", "first"), "node"), "labels")
    names = named.groupBy("component").agg(F.min("first").alias("name"))
    of = nodes.select("node", "first").join(named.join(names, "component").select("node", "name"), "node", "left")
    of_id = member.join(of, "node").select("id", F.coalesce("name", "first").alias("name")).distinct()
    out = sketch.select("id", F.col("n").alias("n_shingles")).join(of_id, "id", "left")
    component = F.coalesce("name", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` without the documents whose component has a smaller id."""
    gone = staged(near_duplicates(docs, words, percent, id_col, text_col).filter("not kept").select(id_col).distinct(), "gone")
    maybe, flag = key_filter(gone, id_col), fresh(docs, "_gone")
    flagged = docs.withColumn(flag, F.coalesce(maybe(F.col(id_col)), F.lit(False)))
    return flagged.filter(~F.col(flag)).unionByName(
        flagged.filter(F.col(flag)).join(gone, id_col, "left_anti").select(flagged.columns)).drop(flag)


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns: three words, similarity 0.85."""
    return near_duplicates(docs, words=3, percent=85)
