"""Benchmark decontamination by a generalised suffix automaton.

The normalised words of all test items go into one generalised suffix
automaton.  Each training document streams its words through it: the state
and the length of the longest match that ends at a word follow from those of
the word before.  A match of ``window`` words or more marks its last
``window`` words as hit; an item with fewer words is a window of its own.

Words: A-Z in lower case, then runs of digits, letters a-z and everything
outside ASCII.  NULL and empty texts have no words and no hits; NULL or
wordless items have no windows; an item that is listed twice counts once.
A NULL item id counts as the id ''.  Repeated document rows are judged one
by one; other columns pass unchanged.

The automaton is broadcast, so its size is bounded: items are cut into
pieces (which overlap, so that no window is lost) and dealt to shards of
about ``SHARD_WORDS`` words, each with an automaton and a pass of its own; the
driver fetches a shard when its pass begins and frees it when the pass ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import ascii_lower, fresh, release, staged

#: Words in one broadcast automaton (a state takes about 0.5 KB).
SHARD_WORDS = 200_000
WINDOW = 10
_WORD_CASED = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

MATCH_TYPE = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])

# Bytes of UTF-8: A-Z to a-z, every other ASCII character that isn't part of a word to a blank.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton over words, with what the scan asks of a
    state: the items that contain its window, and the short items that end
    with it."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window, self.vocab = window, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        ends: dict[int, set[str]] = {}
        short: dict[int, set[tuple[int, str]]] = {}
        for item, words in items:
            ids, state = [self.vocab.setdefault(w, len(self.vocab)) for w in words], 0
            for c in ids:
                state = self._extend(state, c)
                if len(ids) >= window:
                    ends.setdefault(state, set()).add(item)
            if 0 < len(ids) < window:
                short.setdefault(state, set()).add((len(ids), item))
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        for s in reversed(order):  # items of longer states belong to their suffixes too
            up = self.link[s]
            if s in ends and up > 0 and self.length[up] >= window:
                ends.setdefault(up, set()).update(ends[s])
        self.items: dict[int, frozenset[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        top: dict[int, int] = {}
        for s in order:
            up = self.link[s]
            if self.length[s] >= window:
                top[s] = top[up] if up in top else s  # where the last `window` words are a state's own
                self.items[s] = frozenset(ends.get(top[s], ()))
            if s in short or up in self.short:
                self.short[s] = [*short.get(s, ()), *self.short.get(up, ())]

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if (q := nxt[last].get(c)) is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = new
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word spans (merged, in order) and the items that hit."""
        window, link, length, short = self.window, self.link, self.length, self.short
        step = [d.get for d in self.next] if not hasattr(self, "_step") else self._step
        self._step = step
        spans: list[tuple[int, int]] = []
        hit: set[str] = set()
        state = n = 0
        for i, c in enumerate(map(self.vocab.get, words)):
            if c is None:
                state = n = 0
                continue
            to = step[state](c)
            while to is None:  # the root knows every word of the vocabulary
                state = link[state]
                n = length[state]
                to = step[state](c)
            state = to
            n += 1
            if n >= window:
                spans.append((i + 1 - window, i + 1))
                hit |= self.items[state]
            if state in short:
                for k, item in short[state]:
                    if k <= n:
                        spans.append((i + 1 - k, i + 1))
                        hit.add(item)
        return merged(spans), hit


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


_BUILT: dict = {}


def _automaton(shared: Broadcast, window: int) -> SuffixAutomaton:
    """One per worker and broadcast."""
    key = (shared.value[0], window)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = SuffixAutomaton([(i, words_of(t)) for i, t in shared.value[1]], window)
    return _BUILT[key]


def _matcher(shared: Broadcast, window: int):
    @F.pandas_udf(MATCH_TYPE)
    def match(text: pd.Series) -> pd.DataFrame:
        auto, rows, t, words = _automaton(shared, window), [], None, None
        for t in text:
            words = words_of(t)
            spans, items = auto.scan(words)
            rows.append((len(words), [{"start": s, "end": e} for s, e in spans], sorted(items)))
        del text, t, words
        release()
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])
    # a filter on the match would otherwise run it a second time, with workers of its own
    return match.asNondeterministic()


def shards(benchmark: DataFrame, window: int, limit: int = SHARD_WORDS,
           id_col: str = "item_id", text_col: str = "text") -> tuple[int, Iterator[list[tuple[str, str]]]]:
    """Number of shards, and the shards one by one: items as lists of (id,
    words joined by blanks), each of about ``limit`` words at most, fetched
    from a staged table as they are asked for."""
    words = F.filter(F.split(ascii_lower(F.col(text_col)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    # pieces start every `stride` words and are `window - 1` words longer, so each window is inside one
    stride = max(window, limit // 4)
    w = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), words.alias("w")) \
        .filter(F.size("w") > 0)
    pieces = w.select("id", "w", F.explode(F.sequence(
        F.lit(0), F.greatest(F.lit(0), F.size("w") - window), F.lit(stride))).alias("at")) \
        .select("id", F.array_join(F.expr(f"slice(w, at + 1, {stride + window - 1})"), " ").alias("t"),
                F.expr(f"least({stride + window - 1}, size(w) - at)").alias("n")).distinct()
    pieces = staged(pieces, "items")
    n = max(1, -(-int(pieces.agg(F.sum("n")).first()[0] or 0) // limit))
    dealt = F.pmod(F.xxhash64("id", "t"), F.lit(n))
    return n, ([(r[0], r[1]) for r in pieces.filter(dealt == k).select("id", "t").collect()] for k in range(n))


def _hit_words(spans: Column) -> Column:
    """Words inside any of the spans; spans may overlap."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array_sort(spans), start, lambda a, s: F.struct(
        F.greatest(a["end"], s["end"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).alias("n")), lambda a: a["n"])


def match_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                    shard_words: int = SHARD_WORDS, out_col: str = "match") -> DataFrame:
    """``docs`` with a struct: n_words, n_hit, spans (words, end exclusive)
    and items (ids as sorted strings).  ``out_col`` replaces a column of that
    name."""
    n, lists = shards(benchmark, window, shard_words)
    sc, out = docs.sparkSession.sparkContext, docs
    cols = []
    for k, items in enumerate(lists):
        cols.append(fresh(out, f"_match{k}"))
        # the second member tells broadcasts of reused workers apart
        shared = sc.broadcast((f"{id(docs)}-{k}-{hash(tuple(items))}", items))
        out = out.withColumn(cols[-1], _matcher(shared, window)(F.col("text").cast("string")))
        if k + 1 < n:
            out = staged(out, "match")  # one shard in memory at a time
            shared.destroy()
    spans = F.concat(*[F.col(f"`{c}`.spans") for c in cols])
    items = F.array_sort(F.array_distinct(F.concat(*[F.col(f"`{c}`.items") for c in cols])))
    return out.withColumn(out_col, F.struct(
        F.col(f"`{cols[0]}`.n_words").alias("n_words"), _hit_words(spans).alias("n_hit"),
        F.array_sort(spans).alias("spans"), items.alias("items"))).drop(*[c for c in cols if c != out_col])


def cut_words(text: str | None, spans) -> str | None:
    """``text`` without the words of the spans and what stands between them."""
    if text is None or not len(spans):
        return text
    at = [m.span() for m in _WORD_CASED.finditer(text)]
    out, done = [], 0
    for s, e in merged([(x["start"], x["end"]) for x in spans]):
        out.append(text[done:at[s][0]])
        done = at[e - 1][1]
    return "".join(out) + text[done:]


@F.pandas_udf(T.StringType())
def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([cut_words(t, s) for t, s in zip(text, spans)], dtype=object)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_coverage: float = 0.2) -> DataFrame:
    """``docs`` without the hit spans; documents of which more than
    ``max_coverage`` of the words are hit go altogether.  Clean documents stay
    as they are."""
    m = fresh(docs, "_found")
    found = match_benchmark(docs, benchmark, window, out_col=m)
    kept = found.filter(F.col(f"{m}.n_hit") <= F.lit(max_coverage) * F.col(f"{m}.n_words"))
    if max_coverage <= 0:  # who has a span has gone: nothing is left to cut
        return kept.drop(m)
    # only texts that lose words are sent to Python
    hit = F.size(f"{m}.spans") > 0
    cut = F.when(hit, _cut(F.when(hit, F.col("text")), F.col(f"{m}.spans"))).otherwise(F.col("text"))
    return kept.withColumn("text", cut).drop(m)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The query's columns."""
    m = match_benchmark(docs.select("doc_id", "text"), benchmark).select("doc_id", "match.*")
    return m.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))
