"""Toxicity by noisy-channel deobfuscation.

1. A character model (four letters, interpolated with shorter ones) is counted
   over the whole texts of all documents: each task adds up its own grams,
   a grouped sum joins them.  The alphabet is a to z (accents folded), a word
   boundary and one symbol for the rest, so a model has 28 ** 4 grams at most
   however large the corpus is.
2. Suspicious forms are decoded: words with digits or signs that stand for
   letters (at their ends and without any letter too), separators inside words,
   letters held down, and runs of single letters set apart by white space.  The lattice of a form has an arc for every
   reading of a character (itself, the letters it stands for, nothing or a word
   boundary for a separator, one or two letters for a run), with a cost for the
   noise; Viterbi finds the reading that is likeliest under the model.  A plain
   word has one path and is its own reading.
3. Weights of words, and of beginnings and ends that many words share, come from labelled rows,
   as smoothed log odds less a standard error, counted over documents; near
   copies among these rows count once.  A document's evidence is that of its
   strongest words after decoding, and a logistic curve fitted on labelled rows
   that had no part in the weights turns it into a score.

Labels are learned only from rows whose crc32(id as text) mod 3 is not 1, about
``TRAIN_ROWS`` of them at most (chosen by a hash of the id).  Everything else
covers all rows and whole texts.

NULL and empty texts have no evidence and get the curve's lowest score.  Rows
labelled more than once count as toxic if one label says so; NULL labels are
left out.  Without labels of both kinds every score is the rate of toxic ones
(0 without any).  Other columns pass unchanged.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
import string
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.bbit_minhash import shingles
from starloom.llm.common import fresh, release, staged

#: Labelled rows that weights and curve are fitted on, and words and word
#: parts that get a weight, at most.
TRAIN_ROWS = 20_000
MAX_WEIGHTS = 50_000
#: Documents that a word must be found in before it gets a weight.
MIN_DOCS = 5
THRESHOLD = 0.7

# Letters that a character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c"}
#: Costs of noise, in nats.
COST_LEET, COST_DROP, COST_BREAK, COST_RUN, COST_PAIR = 1.0, 0.7, 1.5, 0.5, 1.5

ORDER, BOUNDARY, OTHER, SYMBOLS = 4, 0, 27, 28
PARTS = range(4, 7)
#: A part that is found in so many times the documents of one word with it says no more than that word.
WIDER = 1.25
_EDGE = "".join(c for c in string.punctuation if c not in "$@") + "«»„“”‚‘’¿¡…"
#: Edges that stand for no letter.
_OUTER = "".join(c for c in _EDGE if c not in LEET)
_RUN = re.compile(r"(.)\1\1")
_SPACED = re.compile(r"\s(\S(?:\s+\S){2,})(?=\s)")
_HELD = re.compile(r"(.)\1*", re.S)
_TWICE = re.compile(r"(.)\1", re.S)


def _fold(c: str) -> int:
    """Symbol of a lower-case character."""
    base = unicodedata.normalize("NFKD", c)[:1]
    if "a" <= base <= "z":
        return ord(base) - 96
    return OTHER if c.isalnum() else BOUNDARY


_TABLE: list = []


def _symbols(text: str) -> np.ndarray:
    """Symbols of a text, boundaries in a row taken together."""
    if not _TABLE:
        _TABLE.append(np.array([_fold(chr(c).lower()) for c in range(0x600)], np.int32))
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    s = np.where(cp < 0x600, _TABLE[0][np.minimum(cp, 0x5FF)], OTHER)
    return s[np.r_[True, (s[1:] != BOUNDARY) | (s[:-1] != BOUNDARY)]] if len(s) else s


def _count_grams(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(SYMBOLS ** ORDER, np.int64)
    for pdf in rows:
        for text in pdf["text"]:
            if not text:
                continue
            for at in range(0, len(text), 1 << 20):  # parts only bound the memory; they share their rims
                s = _symbols(" " + text[max(0, at - ORDER):at + (1 << 20)] + " ")
                if len(s) < ORDER:
                    continue
                idx = s[:-3] * SYMBOLS ** 3 + s[1:-2] * SYMBOLS ** 2 + s[2:-1] * SYMBOLS + s[3:]
                total += np.bincount(idx, minlength=len(total)) if len(idx) > 20_000 else 0
                if len(idx) <= 20_000:
                    np.add.at(total, idx, 1)
    seen = np.flatnonzero(total)
    yield pd.DataFrame({"gram": seen.astype(np.int32), "n": total[seen]})
    release()


def language_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """log P(symbol | three before) as an array of 28 ** 4, from all texts."""
    grams = docs.select(F.col(text_col).cast("string").alias("text")) \
        .mapInPandas(_count_grams, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SYMBOLS ** ORDER)
    counts[grams["gram"].to_numpy(np.int64)] = grams["n"].to_numpy(np.float64)
    counts = counts.reshape((SYMBOLS,) * ORDER)
    prob = np.full(SYMBOLS, 1 / SYMBOLS)
    for k in range(1, ORDER + 1):  # each order leans on the one below
        c = counts.sum(axis=tuple(range(ORDER - k)))
        prob = (c + 5.0 * prob) / (c.sum(axis=-1, keepdims=True) + 5.0)
    return np.log(prob).astype(np.float32).ravel()


class Decoder:
    """Viterbi search for the likeliest reading of a noisy form."""

    def __init__(self, logp: np.ndarray):
        self.logp = logp

    def arcs(self, form: str) -> list[list[tuple[str, float]]]:
        units = []
        bare = not any(c.isalpha() for c in form)  # signs alone would always be likeliest as nothing
        for m in _HELD.finditer(form):
            c, n = m[1], len(m[0])
            if c in LEET:
                reads = [(x, COST_LEET * n) for x in LEET[c]]
                if n > 1:
                    reads += [(x * 2, COST_LEET * n + COST_RUN) for x in LEET[c]]
                units.append([(c * n, 0.0), *reads] if c.isdigit() else reads if bare
                             else [*reads, (" ", COST_BREAK), ("", COST_DROP)])
            elif not c.isalnum():
                units.append([("", COST_DROP), (" ", COST_BREAK)])
            elif n == 1:
                units.append([(c, 0.0)])
            elif n == 2:
                units.append([(c * 2, 0.0), (c, COST_PAIR)])
            else:
                units.append([(c, COST_RUN), (c * 2, 2 * COST_RUN)])
        return units

    def decode(self, form: str) -> str:
        logp, mod = self.logp, SYMBOLS ** 3
        # context (last three symbols) -> cost and reading so far
        best: dict[int, tuple[float, tuple | None, str]] = {0: (0.0, None, "")}
        for unit in [*self.arcs(form), [(" ", 0.0)]]:
            ahead: dict[int, tuple[float, tuple | None, str]] = {}
            for state, node in best.items():
                for read, cost in unit:
                    total, s = node[0] + cost, state
                    for ch in read:
                        x = _fold(ch)
                        if x == BOUNDARY and s % SYMBOLS == BOUNDARY:
                            continue
                        total -= float(logp[s * SYMBOLS + x])
                        s = (s * SYMBOLS + x) % mod
                    if s not in ahead or total < ahead[s][0]:
                        ahead[s] = (total, node, read)
            best = ahead
        node, out = min(best.values(), key=lambda x: x[0]), []
        while node is not None:
            out.append(node[2])
            node = node[1]
        return " ".join("".join(reversed(out)).split())


#: Forms that a reader remembers, and counts that a task holds before it passes them on.
REMEMBERED = 60_000
#: Readings of a form up to which each is looked at before a search.
READINGS = 32
FLUSH = 30_000


class Reader(dict):
    """Words of restored text per form, or a value of them, computed once per
    form; emptied when it has grown large."""

    def __init__(self, logp: np.ndarray, value=None):
        super().__init__()
        self.decoder, self.value = Decoder(logp), value

    def _decoded(self, form: str) -> list[str]:
        """Words of the likeliest reading; none, without a search, if no
        reading holds a word of any value."""
        if self.value:
            reads = [[r for r, _ in unit] for unit in self.decoder.arcs(form)]
            if math.prod(map(len, reads)) <= READINGS \
                    and not self.value(list({w for r in itertools.product(*reads) for w in "".join(r).split()})):
                return []
        return self.decoder.decode(form).split()

    def __missing__(self, form: str):
        if len(self) > REMEMBERED:
            self.clear()
        word = form.strip(_EDGE)
        if word.isalpha() and not _RUN.search(word):
            words = [word]
        elif any(c.isalpha() for c in word):
            words = self._decoded(word)
        else:
            words = []
        whole = form.strip(_OUTER)  # edges may be letters or punctuation
        if (whole != word or not words) and any(c in LEET for c in whole):
            words = list(dict.fromkeys([*words, *self._decoded(whole)]))
        out = self[form] = self.value(words) if self.value else words
        return out


def forms(text: str | None) -> set[str]:
    """Distinct forms of a whole text: its words, and runs of single letters."""
    if not text:
        return set()
    text = text.lower()
    return {*text.split(), *_SPACED.findall(f" {text} ")}


def parts(word: str) -> list[str]:
    """A word (letters in a row taken as one, as decoding may leave either),
    its beginnings and its ends."""
    out = ["=" + (_HELD.sub(r"\1", word) if _TWICE.search(word) else word)]
    sizes = [k for k in PARTS if k <= len(word)]
    out += [word[:k] for k in sizes]
    return out + ["~" + word[-k:] for k in sizes]


class Evidence:
    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def __call__(self, words: list[str]) -> float:
        best, get = 0.0, self.weights.get
        for word in words if self.weights else ():
            for p in parts(word):
                w = get(p)
                if w is not None and w > best:
                    best = w
        return best


def evidence(text: str | None, reader: Reader) -> tuple[float, float]:
    """Strongest weight of a text, and the sum of its five strongest."""
    found = [v for v in map(reader.__getitem__, forms(text)) if v]
    top = heapq.nlargest(5, found)
    return min(top[0], 8.0) if top else 0.0, min(sum(top), 25.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _training(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """Labelled rows with text, near copies once: text, toxic, fold."""
    marks = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()) \
        .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = marks.count()
    share = F.lit(1_000_000 if n <= rows else int(1_000_000 * rows / n))
    marks = marks.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) < share)
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(marks), "doc_id").filter("text is not null") \
        .select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"),
                (F.crc32(F.col("doc_id").cast("string")) % 3 == 0).alias("fold"))
    keyed = staged(found.mapInPandas(_copy_keys, "doc_id string, text string, toxic int, fold boolean, k0 long, k1 long, k2 long"),
                   "labelled")
    for k in ("k0", "k1", "k2"):
        first = keyed.groupBy(k).agg(F.min("doc_id").alias("doc_id"))
        keyed = keyed.join(first, [k, "doc_id"], "left_semi")
    return staged(keyed.dropDuplicates(["doc_id"]).select("text", "toxic", "fold"), "training")


def _copy_keys(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Three minima over word shingles; near copies agree on one or more."""
    salts = [np.uint64(1), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
    for pdf in rows:
        keys = [[int((s * m).min().view(np.int64)) if len(s) else 0 for m in salts]
                for s in (shingles(t, 3) for t in pdf["text"])]
        pdf = pdf.assign(doc_id=pdf["doc_id"].astype(str))
        yield pdf.assign(**{f"k{i}": np.array([k[i] for k in keys], np.int64) for i in range(3)})
    release()


def _part_counts(rows: Iterator[pd.DataFrame], logp, known: set | None) -> Iterator[pd.DataFrame]:
    """Documents of each fold that a part is found in, summed over a task's
    rows."""
    reader, total = Reader(logp.value), Counter()

    def frame() -> pd.DataFrame:
        return pd.DataFrame([(p, f, n) for (p, f), n in total.items()], columns=["part", "fold", "n"])

    for pdf in rows:
        for text, fold in zip(pdf["text"], pdf["fold"]):
            seen = {p for f in forms(text) for w in reader[f] for p in parts(w)}
            total.update((p, fold) for p in (seen if known is None else seen & known))
            if len(total) > FLUSH:
                yield frame()
                total = Counter()
    if total:
        yield frame()
    del total
    release()


def _weights(ones: pd.DataFrame, zeros: pd.DataFrame, n1: int, n0: int, least: int) -> dict[str, float]:
    """Smoothed log odds less a standard error, as far as they speak for
    toxicity."""
    both = ones.groupby("part")["n"].sum().to_frame("a") \
        .join(zeros.groupby("part")["n"].sum().to_frame("b")).fillna({"b": 0.0})
    both = both[both["a"] >= least]
    # parts that only stand for one word would speak against others that merely look like it
    word: dict[str, int] = {}
    for part, n in both["a"].items():
        if part[0] == "=":
            for p in parts(part[1:])[1:]:
                word[p] = max(word.get(p, 0), n)
    wide = np.array([p[0] == "=" or n > WIDER * word.get(p, 0) for p, n in both["a"].items()], bool)
    both = both[wide] + 0.5
    w = np.log(both["a"] / (n1 + 1)) - np.log(both["b"] / (n0 + 1)) - np.sqrt(1 / both["a"] + 1 / both["b"])
    return w[w > 1].nlargest(MAX_WEIGHTS).astype(float).to_dict()


def _evidence_rows(rows: Iterator[pd.DataFrame], logp, weights) -> Iterator[pd.DataFrame]:
    """Evidence of each row by the weights of the other fold."""
    readers = {f: Reader(logp.value, Evidence(weights.value[not f])) for f in (True, False)}
    for pdf in rows:
        x = [evidence(t, readers[f]) for t, f in zip(pdf["text"], pdf["fold"])]
        yield pd.DataFrame({"top": [a for a, _ in x], "all": [b for _, b in x], "toxic": pdf["toxic"]})
    release()


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton's method."""
    a = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(a.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + penalty + 1e-9 * np.eye(len(b)),
                               a.T @ (y - p) - penalty @ b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return b


class Model:
    """Character model, part weights and curve, as broadcasts of bounded size."""

    def __init__(self, docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS):
        sc = docs.sparkSession.sparkContext
        self.logp = logp = sc.broadcast(language_model(docs))
        rows = _training(docs, labels, train_rows)
        n = {(bool(r["fold"]), bool(r["toxic"])): r["n"] for r in rows.groupBy("fold", (F.col("toxic") > 0).alias("toxic"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
        folds = {f: (n.get((f, True), 0), n.get((f, False), 0)) for f in (True, False)}
        n1, n0 = (sum(x) for x in zip(*folds.values()))
        rate, out = n1 / max(1, n1 + n0), "part string, fold boolean, n long"
        self.weights = sc.broadcast({})
        self.curve = np.array([np.log(max(rate, 1e-9) / max(1 - rate, 1e-9)), 0.0, 0.0])
        if not all(a and b for a, b in folds.values()):
            return
        ones = rows.filter("toxic > 0").select("text", "fold").mapInPandas(lambda it: _part_counts(it, logp, None), out) \
            .groupBy("part", "fold").agg(F.sum("n").alias("n"))
        often = ones.groupBy("part").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_DOCS) \
            .orderBy(F.desc("n"), "part").limit(4 * MAX_WEIGHTS).select("part")
        ones = ones.join(F.broadcast(often), "part").toPandas()
        known = sc.broadcast(set(ones["part"]))
        zeros = rows.filter("toxic <= 0").select("text", "fold") \
            .mapInPandas(lambda it: _part_counts(it, logp, known.value), out) \
            .groupBy("part", "fold").agg(F.sum("n").alias("n")).toPandas()
        # the curve sees evidence by weights that its row had no part in
        apart = sc.broadcast({f: _weights(ones[ones["fold"] == f], zeros[zeros["fold"] == f], *folds[f], MIN_DOCS // 2 + 1)
                              for f in folds})
        test = rows.mapInPandas(lambda it: _evidence_rows(it, logp, apart), "top double, all double, toxic int").toPandas()
        self.curve = _curve(test[["top", "all"]].to_numpy(), (test["toxic"].to_numpy() > 0).astype(float))
        self.weights = sc.broadcast(_weights(ones, zeros, n1, n0, MIN_DOCS))

    def score(self, text: Column) -> Column:
        logp, weights, curve = self.logp, self.weights, self.curve

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            reader = Reader(logp.value, Evidence(weights.value))
            for texts in batches:
                x = np.array([(1.0, *evidence(t, reader)) for t in texts]).reshape(-1, 3)
                yield pd.Series(1 / (1 + np.exp(-np.clip(x @ curve, -30, 30))))
            reader.clear()
            release()

        return scored(text.cast("string"))


def score_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, out_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; ``out_col`` replaces a column of
    that name."""
    return docs.withColumn(out_col, Model(docs, labels, train_rows).score(F.col("text")))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more."""
    s = fresh(docs, "_score")
    return score_toxicity(docs, labels, out_col=s).filter(F.col(s) < threshold).drop(s)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns."""
    scored = score_toxicity(docs.select("doc_id", "text"), labels)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
