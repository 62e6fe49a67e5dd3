"""Operators 11 to 13 against brute force."""

import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import hard_negatives, ranked_search, token_files
from starloom.llm.common import table
from starloom.llm.queries import ORACLE, QUERIES

from .conftest import SF

# -- 11 ----------------------------------------------------------------------


def _plain_negatives(rows):
    """rows: (vec_id, embedding, label) with ids that are numbers or None."""
    v = []
    for i, x, label in rows:
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        label = int(math.fmod(label + 1, 10)) if i is not None and i % 7 == 0 else label
        v.append((i, label, [math.floor(256 * c) for c in x]))
    dot = lambda a, b: sum(p * q for p, q in zip(a, b, strict=False))  # noqa: E731  a shorter one ends the sum
    last = lambda i: (i is None, i or 0)
    out = []
    for n, (i, label, x) in enumerate(v):
        if i is None or i % 50:
            continue
        others = sorted([(-dot(x, y), last(j), j, own) for m, (j, own, y) in enumerate(v) if m != n], key=lambda r: r[:2])
        for score, _, j, _ in [r for r in others if r[3] == label][:5]:
            found = [r for r in others if r[3] != label and -50 * score <= -100 * r[0] <= -95 * score][:3]
            out += [(i, j, rank, r[2], -score, -r[0]) for rank, r in enumerate(found, 1)]
    return sorted(out, key=str)


def _vectors(spark, rows):
    df = spark.createDataFrame([(r[0], r[1], r[2], "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, row string, block int")
    return sorted([tuple(r) for r in hard_negatives.digest(df).collect()], key=str)


def _cluster(r, n, dims, groups, spread):
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(groups)]
    rows = []
    for i in range(n):
        c = centres[r.randrange(groups)]
        rows.append((i, [float(np.float32(x + r.gauss(0, spread))) for x in c], r.randrange(4)))
    return rows


@pytest.mark.parametrize("seed,dims,spread", [(1, 24, 0.3), (2, 3, 1.0), (3, 40, 0.05)])
def test_hard_negatives_equal_brute_force(spark, seed, dims, spread):
    rows = _cluster(random.Random(seed), 260, dims, 6, spread)
    assert _vectors(spark, rows) == _plain_negatives(rows)


def test_hard_negatives_odd_rows(spark):
    r = random.Random(9)
    rows = _cluster(r, 120, 8, 3, 0.2)
    rows += [(0, rows[0][1], 1), (50, rows[3][1], 2), (50, rows[3][1], 2), (None, rows[4][1], 1), (200, None, 1), (201, [float("nan")] * 8, 1),
             (202, [1.0, None] * 4, 1), (203, [float("inf")] * 8, 1), (204, rows[0][1], None), (250, rows[0][1][:3], 1), (300, [], 0)]
    rows += [(400 + i, rows[1][1], i % 2) for i in range(40)]  # copies: ties by id
    got = _vectors(spark, rows)
    assert got == _plain_negatives(rows) and any(x[0] == 250 for x in got)
    assert _vectors(spark, []) == [] and _vectors(spark, [(1, [1.0], 1)]) == [] and _vectors(spark, [(0, [], 1), (50, [], 1)]) == []


def test_vertical_scan_rules_out_and_stays_exact():
    r = np.random.default_rng(4)
    x = np.floor(256 * r.normal(size=(500, 32))).astype(np.int64)
    x[:20] = x[0] + r.integers(-4, 4, size=(20, 32))
    block = hard_negatives.Block(list(range(500)), np.arange(500), np.zeros(500, np.int64), x.T.tobytes(), 32)
    looked = []

    def keep(least, most):
        assert (least <= most).all()
        looked.append(len(least))
        return most >= np.partition(least, -5)[-5]

    places, scores = hard_negatives.vertical_scan(x[0], block, np.ones(500, bool), keep)
    assert looked[-1] < 500 and set(np.argsort(-(x @ x[0]), kind="stable")[:5]) <= set(places)
    assert (scores == (x @ x[0])[places]).all()
    assert hard_negatives.exact_type(x[0], block) in (np.float32, np.float64)
    big = hard_negatives.Block([0], np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(2, 1 << 40).tobytes(), 2)
    assert hard_negatives.exact_type(np.array([1 << 20, 1]), big) is np.int64
    with pytest.raises(OverflowError):
        hard_negatives.exact_type(np.array([1 << 40, 1]), big)


# -- 12 ----------------------------------------------------------------------

_TERM = re.compile(ranked_search.TERM)


def _terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in _TERM.findall(text or "")]


def _plain_search(docs, items, k=20):
    d = [(i, _terms(t)) for i, t in docs]
    d = [(i, t) for i, t in d if t]
    n, length = len(d), sum(len(t) for _, t in d)
    df = {}
    for _, t in d:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, t in d:
            m = 75 + 25 * len(t) * n // length
            s = 0
            for x in _terms(text):
                if tf := t.count(x):
                    s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10 ** 9 * tf // (1000 * tf + 12 * m))
            if s > 0:
                scored.append((-s, (i is None, i or 0), i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=str)


def _search(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, terms string, row int")
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id string, text string, id int")
    return sorted([tuple(r) for r in ranked_search.digest(d, b).collect()], key=str)


def _prose(words, r, lo, hi):
    return " ".join(r.choice(words) for _ in range(r.randint(lo, hi)))


@pytest.mark.parametrize("seed", [1, 2])
def test_ranked_search_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 90)
    r = random.Random(seed)
    vocab = [f"w{int(40 * r.random() ** 3)}" for _ in range(300)] + ["É", "é", "Ab", "aB", "2"]
    docs = [(i, _prose(vocab, r, 0, 60)) for i in range(400)]
    docs += [(500 + i, docs[3][1]) for i in range(30)]  # copies: ties by id
    items = [(f"i{i}", _prose(vocab, r, 1, 25)) for i in range(30)] + [("c", docs[3][1]), ("r", "w1 w1 w1 w2")]
    assert _search(spark, docs, items) == _plain_search(docs, items)


def test_ranked_search_odd_rows(spark):
    r = random.Random(3)
    docs = [(1, None), (2, ""), (3, "?! --"), (None, "alpha beta"), (4, "alpha beta"), (4, "alpha beta"), (5, "ALPHA," + "gamma " * 20_000),
            (6, "Straße ÉCOLE école"), (7, "\x00beta\x7fgamma")] + [(i, _prose(["x", "y", "z"], r, 3, 9)) for i in range(10, 60)]
    items = [("a", "Alpha beta"), ("a", "alpha"), (None, "gamma"), ("n", None), ("e", ""), ("u", "école straße"), ("none", "absent"), ("x", "x y z x")]
    assert _search(spark, docs, items) == _plain_search(docs, items)
    assert _search(spark, [], items) == [] and _search(spark, docs, []) == [] and _search(spark, [(1, None)], items) == []


def test_pair_bounds_hold_the_joint_maximum():
    # two terms that never meet, and two that meet in one document
    post = {1: ([0, 1], [9, 1]), 2: ([2, 3], [8, 2]), 3: ([4, 5], [5, 1]), 4: ([5, 6], [1, 7])}
    docs = np.concatenate([np.array(p[0], np.int32) for p in post.values()])
    impacts = np.concatenate([np.array(p[1], np.int32) for p in post.values()])
    shard = ranked_search.Shard(list(range(8)), list(range(8)), list(post), [2, 4, 6, 8], docs.tobytes(), impacts.tobytes())
    lists = ranked_search.pair_lists(shard, [([1, 2, 3, 4, 9], [10, 10, 10, 10, 1])])
    assert [(a, b, j, d.tolist()) for a, b, j, d in lists] == [(3, 4, 20, [5])]
    best = ranked_search.best_of_shard(shard, {(3, 4): (20, np.array([5]))}, [1, 2, 3, 4], [10] * 4, [1] * 4, 3)
    assert best == [(0, 90), (2, 80), (6, 70)]


# -- 13 ----------------------------------------------------------------------

def _plain_files(docs):
    path, start, out = token_files.tokenizer_path(), 0, []
    for i, text in docs:
        ids = [*token_files.encode_whole(path, text), token_files.END_ID]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_encoder_equals_the_library_on_whole_texts():
    path, r = token_files.tokenizer_path(), random.Random(5)
    encoder = token_files.Encoder(path, "H")
    pieces = ["a", "B", "é", "É", "̈", "ß", "Σ", "ς", "'", "s", "t", "re", "ll", ".", ",", "!", "?", ")", "]", "(", "\x0b", "\x1c", "\x85",
              "\xa0", " ", "_", "1", "²", "½", "Ⅷ", "漢", "字", "🙂", "̸", "<", "=", "<|endoftext|>", "İ", "K", "  ", "\n", "\t", "\r",
              "ŉ", "ﬁ", "€", "…", "‍", "\x00", "-", "·", "the", "running", "word" * 20]
    for _ in range(4000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 14)))
        assert np.frombuffer(encoder.ids(text), "<u2").tolist() == token_files.encode_whole(path, text), repr(text)


def test_token_files_equal_plain_encoding(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    odd = [(-5, None), (-4, ""), (-3, "x" * 5000), (-2, "one two " * 30_000), (-1, " \n\t ")]
    df = spark.createDataFrame([(i, t, 1, "y") for i, t in docs + odd], "doc_id long, text string, h int, part string").repartition(5)
    got = [tuple(r) for r in token_files.digest(df).orderBy("doc_id").collect()]
    assert got == _plain_files(sorted(docs + odd, key=lambda x: x[0]))


def test_token_files_repeated_rows_null_ids_and_no_rows(spark):
    docs = [(7, "same text")] * 300 + [(None, "no id")] * 3 + [(7, "another one")] * 2 + [(1, "first")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = sorted([tuple(r) for r in token_files.digest(df).collect()], key=lambda r: r[1])
    assert [r[0] for r in got] == [None] * 3 + [1] + [7] * 302
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
    assert got == sorted([tuple(r) for r in token_files.digest(df).collect()], key=lambda r: r[1])
    assert token_files.digest(df.filter("doc_id = 0")).collect() == []


def test_sequences_lie_at_computed_places_without_copies(spark, tmp_path):
    path = token_files.tokenizer_path()
    docs = [(i, "word " * (i * 7 % 90)) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    manifest = token_files.write_sequences(df, str(tmp_path / "files"), length=64, batch_rows=4).orderBy("part").collect()
    flat = [x for _, t in docs for x in [*token_files.encode_whole(path, t), token_files.END_ID]]
    at = 0
    for m in manifest:
        f = token_files.SequenceFile(m.sequences)
        n = -(-m.n_tokens // 64)
        before = pa.total_allocated_bytes()
        parts = {i: f.sequence(i) for i in random.Random(1).sample(range(n), n)}
        assert pa.total_allocated_bytes() == before  # views of the mapped file
        ids = [x for i in range(n) for x in parts[i]["ids"].to_pylist()]
        mask = [x for i in range(n) for x in parts[i]["mask"].to_pylist()]
        ends = [x for i in range(n) for x in parts[i]["ends"].to_pylist()]
        assert ids[:m.n_tokens] == flat[at:at + m.n_tokens] and mask == [i < m.n_tokens for i in range(n * 64)]
        assert sum(ends) == m.n_docs and np.concatenate(list(f.slices(3, m.n_tokens - 3))).tolist() == ids[3:m.n_tokens]
        with pytest.raises(IndexError):
            f.sequence(n)
        with pa.memory_map(m.sequences) as whole:  # an ordinary Arrow stream
            assert sum(b.num_rows for b in pa.ipc.open_stream(whole)) == n
        at += m.n_tokens
    assert at == len(flat)


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_ranked_search"])
def test_registered_queries_match_sql(spark, name):
    with duckdb.connect() as c:
        for t in ("documents", "embeddings", "benchmark"):
            c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
        res = c.execute(ORACLE[name])
        names, want = [x[0] for x in res.description], res.fetchall()
    got = QUERIES[name](spark, SF)
    assert got.columns == names and sorted(map(tuple, got.collect())) == sorted(want) and want
