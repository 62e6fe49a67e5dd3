"""Repeated substrings by bucket-pointer refinement over sampled suffixes.

A byte goes if a string of ``length`` bytes that covers it starts anywhere
else too, in the same document or another.  Strings are compared on the
input and never cross documents; NULL is empty.

A suffix array sorts all suffixes; here only those matter that can begin a
string of ``length`` bytes shared with another place, so the first buckets
are made of suffixes at content-chosen offsets: an offset whose ``GRAM`` bytes
have the smallest hash in some window of ``length`` bytes.  Equal windows choose
equal offsets, so every repeated window holds an offset whose bucket has
two members at least, and buckets of one are dropped.

1. Buckets are refined by the bucket identifier of the whole surroundings (the
   bytes that any window around the offset can reach).  Two members with the
   same one repeat each other's windows altogether, and that is settled.
2. What is left (rims of repeated regions) is refined recursively: a bucket
   for windows that begin ``a`` to ``b`` bytes before the offset splits into
   one for each half of that range, whose identifier combines the bucket's own
   with that of the bytes at later and earlier offsets which all windows of
   the half share; it is done until the buckets are small, and members alone
   in a bucket go.  Members that agree in all bytes that windows of the half
   reach settle each other as in step 1, and one stands for them; a bucket for
   one window start holds equal windows only, so it is settled as a whole and
   met by no task, however large it is.  Large buckets so split over tasks;
   small ones are finished window by window where they lie.

Buckets are identified by 64-bit hashes.  Row identity is the id together
with a hash of the text, so repeated ids and rows are told apart or judged
alike.  Documents shorter than ``length`` bytes have no windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import key_filter, release, staged

LENGTH = 200
GRAM = 100
#: Offsets handled at once; longer texts are taken in overlapping parts.
PART = 1 << 18
#: Members of a bucket that one task finishes; larger ones are split first.
BUCKET = 4096
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        n = PART + 4096
        up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS["p"] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _POWERS["p"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _sliding(op: np.ufunc, x: np.ndarray, w: int) -> np.ndarray:
    """op over every w values in a row, in time independent of w."""
    n = len(x)
    padded = np.full(-(-n // w) * w, x[-1], x.dtype)
    padded[:n] = x
    rows = padded.reshape(-1, w)
    ahead = op.accumulate(rows, axis=1).ravel()
    behind = op.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[:n - w + 1], ahead[w - 1:n])


def chosen(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chosen offsets, the hash of the gram there, and that of all bytes which
    windows around it reach (cut at the document's ends) and its place in them."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    up, down = _powers()
    w, rim = length - gram + 1, length - gram
    out = []
    for at in range(0, len(data) - length + 1, PART - 2 * length):
        # offsets of this part are [at, at + PART - 2 * length); it sees a window to each side
        lo, hi = max(0, at - length), min(len(data), at + PART - length)
        a = np.frombuffer(data, np.uint8, hi - lo, lo).astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(a * up[:len(a)], out=sums[1:])
        h = mix((sums[gram:] - sums[:-gram]) * down[:len(a) - gram + 1])
        least = _sliding(np.minimum, h, w)
        edge = np.zeros(w - 1, np.uint64)
        pos = np.flatnonzero(_sliding(np.maximum, np.concatenate([edge, least, edge]), w) == h)
        last = len(data) if hi == len(data) else at + PART - 2 * length
        pos = pos[(pos + lo >= at) & (pos + lo < last)]
        s, e = np.maximum(pos - rim, 0), np.minimum(pos + gram + rim, len(a))
        out.append((pos + lo, h[pos], mix(((sums[e] - sums[s]) * down[s]) ^ mix(((e - s) << 32 | (pos - s)).astype(np.uint64)))))
        if hi == len(data):
            break
    return tuple(np.concatenate(x) for x in zip(*out))


def _offsets(rows: Iterator[pd.DataFrame], length: int, gram: int, full: bool) -> Iterator[pd.DataFrame]:
    for pdf in rows:
        found: list = [[], [], [], []]
        held = 0
        for key, text in zip(pdf["key"], pdf["text"]):
            pos, h, ctx = chosen(text.encode("utf-8", "surrogatepass") if text else b"", length, gram)
            if not full:
                found[0].append(h)
            else:
                for to, x in zip(found, (h, ctx, np.full(len(pos), key, np.int64), pos.astype(np.int32))):
                    to.append(x)
            held += len(pos)
            if held > 200_000:
                yield _frame(found, full)
                found, held = [[], [], [], []], 0
        if held:
            yield _frame(found, full)
    release()


def _frame(found: list, full: bool) -> pd.DataFrame:
    cols = [np.concatenate(x) for x in (found if full else found[:1])]
    return pd.DataFrame({n: c.view(np.int64) if c.dtype == np.uint64 else c
                         for n, c in zip(("hq", "hc", "key", "pos"), cols)})


def _surroundings(rows: Iterator[pd.DataFrame], length: int, gram: int) -> Iterator[pd.DataFrame]:
    """The bytes on both sides of each asked offset."""
    rim = length - gram
    for pdf in rows:
        out, held = [], 0
        for key, text, wanted in zip(pdf["key"], pdf["text"], pdf["wanted"]):
            data = text.encode("utf-8", "surrogatepass")
            for x in wanted:
                p = x["pos"]
                out.append((x["hq"], x["n"], key, p, data[max(0, p - rim):p], data[p + gram:p + gram + rim]))
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=["bucket", "n", "key", "pos", "left", "right"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["bucket", "n", "key", "pos", "left", "right"])
    release()


def _side(parts: list[bytes], rim: int, backward: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 0..rim bytes next to the gram, per row, and how many
    bytes each row has there."""
    n = np.fromiter(map(len, parts), np.int64, len(parts))
    flat = b"".join(x[::-1].ljust(rim, b"\0") if backward else x.ljust(rim, b"\0") for x in parts)
    a = np.frombuffer(flat, np.uint8).reshape(len(parts), rim).astype(np.uint64) + np.uint64(1)
    sums = np.zeros((len(parts), rim + 1), np.uint64)
    np.cumsum(a * _powers()[0][:rim], axis=1, out=sums[:, 1:])
    return mix(sums), n


def _finish(pdf: pd.DataFrame, rim: int) -> pd.DataFrame:
    """Windows of whole buckets: spans of rows whose windows have a like."""
    left, nl = _side(list(pdf["left"]), rim, True)
    right, nr = _side(list(pdf["right"]), rim, False)
    bucket = mix(pdf["bucket"].to_numpy(np.int64).view(np.uint64))
    lo, hi = pdf["lo"].to_numpy(), pdf["hi"].to_numpy()
    alone = mix(np.arange(len(pdf), dtype=np.uint64) ^ np.uint64(0x5DEECE66D1234567))
    same = np.zeros((len(pdf), rim + 2), bool)
    for o in range(rim + 1):  # the window that begins o bytes before the gram
        ok = (o >= lo) & (o <= hi) & (nl >= o) & (nr >= rim - o)
        if not ok.any():
            continue
        h = np.where(ok, mix(bucket ^ (left[:, o] * np.uint64(3))) + right[:, rim - o], alone)
        order = np.argsort(h, kind="stable")
        twin = h[order][1:] == h[order][:-1]
        same[order[1:], o] |= twin
        same[order[:-1], o] |= twin
    same &= (pdf["n"].to_numpy() == 1)[:, None]  # the rest is settled
    edge = np.diff(same.astype(np.int8), axis=1, prepend=0)
    row, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    pos = pdf["pos"].to_numpy(np.int64)[row]
    return pd.DataFrame({"key": pdf["key"].to_numpy()[row], "start": (pos - last).astype(np.int32),
                         "end": (pos - first + rim + (pdf["gram"].to_numpy()[row] if len(row) else 0)).astype(np.int32)})


def _finish_sorted(rows: Iterator[pd.DataFrame], rim: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by bucket; a bucket cut by a batch's end waits for the
    next batch."""
    rest = None
    for pdf in rows:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        whole = pdf["bucket"] != pdf["bucket"].iloc[-1]
        rest = pdf[~whole]
        if whole.any():
            yield _finish(pdf[whole], rim)
    if rest is not None and len(rest):
        yield _finish(rest, rim)
    release()


def _split(ctx: DataFrame, rim: int, length: int, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """Refine buckets of more than ``limit`` members: (what is left in small
    buckets, spans that were settled on the way).

    Members of a half whose bytes agree, as far as windows of the half reach,
    repeat each other's windows there: that settles their spans, and one of
    them stands for all from then on.  Members alone go, and so do buckets in
    which all agree.  Buckets that are small enough stay where they were
    written.  Which members stay is told by bitmaps of fixed size, so their
    bytes are never shuffled here; a member or bucket that passes by chance
    only adds spans that are true, and changes nothing."""
    small, settled = [], []
    while True:
        sizes = ctx.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.max(F.col("hi") - F.col("lo")).alias("range"))
        big = staged(sizes.filter((F.col("members") > limit) & (F.col("range") > 0)).select("bucket"), "big")
        if big.isEmpty():
            break
        is_big = key_filter(big, "bucket")(F.col("bucket")) & (F.col("lo") < F.col("hi"))
        small.append(ctx.filter(~is_big))
        mid = F.shiftright(F.col("lo") + F.col("hi"), 1)
        halves = ctx.filter(is_big).withColumn("half", F.explode(F.array(
            F.struct(F.col("lo"), mid.alias("hi")), F.struct((mid + 1).alias("lo"), F.col("hi"))))) \
            .withColumn("lo", F.col("half.lo")).withColumn("hi", F.col("half.hi")).drop("half")
        # windows of a half all have the last `lo` bytes before the gram and the first rim - hi after it
        halves = halves.filter((F.length("left") >= F.col("lo")) & (F.length("right") >= rim - F.col("hi"))) \
            .withColumn("bucket", F.expr(f"xxhash64(bucket, lo, hi, substring(left, length(left) - lo + 1, lo), "
                                         f"substring(right, 1, {rim} - hi))"))
        # its windows reach no more than the last hi bytes before the gram and the first rim - lo after it
        halves = halves.withColumn("left", F.expr("substring(left, greatest(length(left) - hi, 0) + 1, hi)")) \
            .withColumn("right", F.expr(f"substring(right, 1, {rim} - lo)"))
        # windows of a member begin from `far` down to `near` bytes before the gram
        far, near = F.least("hi", F.length("left")), F.greatest(F.col("lo"), F.lit(rim) - F.length("right"))
        narrow = staged(halves.select("bucket", F.xxhash64("left", "right", F.length("left")).alias("kind"), "n", "key", "pos",
                                      (F.col("pos") - far).alias("start"), (F.col("pos") - near + length).alias("end")), "halves")
        kinds = narrow.groupBy("bucket", "kind").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("key", "pos")).alias("one"))
        kinds = staged(kinds, "kinds")
        settled.append(narrow.filter(f"n = 1 and end - start >= {length}")
                       .join(kinds.filter("m > 1").select("bucket", "kind"), ["bucket", "kind"]).select("key", "start", "end"))
        several = kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("bucket")
        stay = kinds.join(several, "bucket").select(F.xxhash64("bucket", "one.key", "one.pos").alias("row"))
        stays = key_filter(stay, "row")
        ctx = staged(halves.filter(stays(F.xxhash64("bucket", "key", "pos"))), "rims")
    for part in small:
        ctx = ctx.unionByName(part)
    return ctx, settled


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """``docs`` (columns key, text) -> (key, spans): byte spans to remove,
    unmerged, for every key that has any."""
    rim = length - gram
    long_enough = docs.filter(F.octet_length("text") >= length)
    grams = long_enough.mapInPandas(lambda it: _offsets(it, length, gram, False), "hq long")
    shared = key_filter(grams.groupBy("hq").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "hq")
    schema = "hq long, hc long, key long, pos int"
    offsets = long_enough.mapInPandas(lambda it: _offsets(it, length, gram, True), schema)
    offsets = staged(offsets.filter(shared(F.col("hq"))), "offsets")
    # one row per bucket and surroundings, with one place where it is found
    kinds = staged(offsets.groupBy("hq", "hc").agg(F.count(F.lit(1)).alias("n"), F.first("key").alias("key"),
                                                   F.first("pos").alias("pos")), "surroundings")
    settled = offsets.join(kinds.filter("n > 1").select("hq", "hc"), ["hq", "hc"]).select(
        "key", F.greatest(F.col("pos") - rim, F.lit(0)).alias("start"), (F.col("pos") + length).alias("end"))
    open_ = kinds.groupBy("hq").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")) \
        .filter("k > 1 and least = 1").select("hq")
    wanted = kinds.join(open_, "hq").groupBy("key").agg(F.collect_list(F.struct("hq", "n", "pos")).alias("wanted"))
    wanted = staged(wanted, "wanted")
    asked = key_filter(wanted, "key")
    text = long_enough.filter(asked(F.col("key"))).dropDuplicates(["key"]).join(wanted, "key")
    ctx = text.select("key", "text", "wanted").mapInPandas(
        lambda it: _surroundings(it, length, gram),
        "bucket long, n long, key long, pos int, left binary, right binary") \
        .withColumn("lo", F.lit(0)).withColumn("hi", F.lit(rim)).withColumn("gram", F.lit(gram))
    ctx, rest = _split(staged(ctx, "rims"), rim, length, bucket)
    # what is left of a bucket of one window start differs from what settled it
    rims = ctx.filter("lo < hi").repartition("bucket").sortWithinPartitions("bucket").mapInPandas(
        lambda it: _finish_sorted(it, rim), "key long, start int, end int")
    spans = settled.unionByName(rims)
    for more in rest:
        spans = spans.unionByName(more)
    # rows that share id and text share their spans: each is kept once
    return spans.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def _merge(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["start"], x["end"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


CUT_TYPE = T.StructType([
    T.StructField("kept", T.BinaryType()),
    T.StructField("removed", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])


@F.pandas_udf(CUT_TYPE)
def _cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = []
    for t, x in zip(text, spans):
        # rows that the key filter let pass by chance have no spans
        data, cuts = t.encode("utf-8", "surrogatepass"), _merge(x if x is not None else ())
        cuts = [(s, min(e, len(data))) for s, e in cuts]
        ends = [0, *(e for _, e in cuts)]
        kept = b"".join(data[a:b] for a, b in zip(ends, [*(s for s, _ in cuts), len(data)]))
        rows.append((kept, [{"start": s, "end": e} for s, e in cuts]))
    return pd.DataFrame(rows, columns=["kept", "removed"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``kept`` (the remaining bytes) and
    ``removed`` (maximal removed byte spans)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")) \
        .withColumn("key", F.xxhash64(F.col("id").cast("string"), "text"))
    spans = staged(repeated_spans(rows.select("key", "text"), length, gram, bucket), "spans")
    hit = key_filter(spans, "key")
    # only documents that may have spans are shuffled to meet them
    flagged = rows.withColumn("hit", hit(F.col("key")))
    met = flagged.filter("hit").join(spans, "key", "left").withColumn(
        "cut", F.when(F.col("spans").isNotNull(), _cut("text", "spans")))
    whole = F.to_binary("text", F.lit("utf-8"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return met.select("id", F.coalesce("cut.kept", whole).alias("kept"), F.coalesce("cut.removed", none).alias("removed")) \
        .unionByName(flagged.filter("not hit").select("id", whole.alias("kept"), none.alias("removed"))) \
        .withColumnRenamed("id", id_col)


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return remove_repeats(docs).select(
        "doc_id", (F.octet_length("kept") + n).cast("long").alias("n_bytes"), n.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
