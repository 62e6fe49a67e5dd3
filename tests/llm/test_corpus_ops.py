"""Near-duplicates, vectors, repeats, mixing, pages, toxicity, pipeline."""

import os
import random
import re
import tempfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import bbit_minhash, nn_descent, page_templates, pivotal_mix, repeats, toxicity
from starloom.llm.common import components, key_filter
from starloom.llm.queries import QUERIES
from tests.llm import plain
from tests.llm.conftest import SF

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, None, "s", 0) for i, t in texts], schema)


# -- helpers ---------------------------------------------------------------------

def test_components_against_union_find(spark):
    r = random.Random(4)
    edges = [(r.randrange(120), r.randrange(120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 260)] + [(7, 7)]
    g = plain.Groups({x for e in edges for x in e})
    for a, b in edges:
        g.join(a, b)
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: g.find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_key_filter_lets_every_key_pass(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    passed = {r.id for r in spark.range(3000).filter(key_filter(keys, "k")(F.col("id"))).collect()}
    assert passed >= set(range(0, 3000, 3)) and len(passed) < 1100


# -- b-bit MinHash -----------------------------------------------------------------

def _near_copies(words):
    base, docs, r = words(150, 8), {}, random.Random(9)
    for i in range(60):  # copies of one text, each a little different, some too different
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 4, 9])):
            w[r.randrange(len(w))] = f"edit{r.randrange(1000)}"
        docs[i] = " ".join(w)
    docs |= {100 + i: " ".join(words(80, 20 + i)) for i in range(10)}
    docs |= {200: None, 201: "", 202: " \t\n", 203: "two words", 204: "TWO words", 205: "one", 206: "one", 207: "a b c", 208: "a b c d"}
    docs[209] = docs[100] * 1  # an exact copy
    docs[210] = " ".join(words(30_000, 99))
    docs[211] = docs[210] + " tail"
    return docs


@pytest.mark.parametrize("n,percent,block", [(3, 85, 1024), (5, 80, 8)])
def test_near_duplicates_against_all_pairs(spark, words, n, percent, block):
    docs = _near_copies(words)
    got = bbit_minhash.near_duplicates(_docs(spark, docs.items()), n, percent, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain.near_duplicates(docs, n, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_odd_rows(spark):
    df = _docs(spark, [(5, "a b c d e"), (5, "a b c d e"), (2, "a b c d e"), (None, "a b c d e"), (None, None)])
    rows = sorted(bbit_minhash.near_duplicates(df, 3, 85).collect(), key=str)
    assert [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows] == [
        (2, 3, 2, True), (5, 3, 2, False), (5, 3, 2, False), (None, 0, None, True), (None, 3, None, True)]
    kept = bbit_minhash.drop_near_duplicates(df.withColumn("_gone", F.lit("x")), 3, 85)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 2), (True, 0), (True, 0)]
    assert kept.columns[-1] == "_gone"
    assert bbit_minhash.digest(df.limit(0)).count() == 0


def test_near_duplicates_of_rows_that_share_an_id(spark, words):
    a, b = " ".join(words(90, 61)), " ".join(words(90, 62))
    near = lambda t: t + " tail"
    cases = {  # rows -> component of each id
        ((1, a), (1, b), (2, near(a)), (3, near(b))): {1: 1, 2: 1, 3: 1},
        ((1, a), (2, b), (3, a), (3, b)): {1: 1, 2: 1, 3: 1},
        ((4, a), (4, a), (4, None), (2, near(a))): {4: 2, 2: 2},
        ((7, None), (7, ""), (8, a)): {7: 7, 8: 8},
    }
    for rows, expect in cases.items():
        out = bbit_minhash.near_duplicates(_docs(spark, rows)).collect()
        assert sorted((r.doc_id, r.component_id) for r in out) == sorted((i, expect[i]) for i, _ in rows)
        assert all(r.kept == (r.doc_id == r.component_id) for r in out)
        kept = bbit_minhash.drop_near_duplicates(_docs(spark, rows)).collect()
        assert sorted(r.doc_id for r in kept) == sorted(i for i, _ in rows if expect[i] == i)


def test_estimate_is_corrected_for_chance():
    r = np.random.default_rng(5)
    a = r.integers(0, 1 << 63, 4000, np.uint64)
    b = np.r_[a[:3000], r.integers(0, 1 << 63, 1000, np.uint64)]
    x, y = (bbit_minhash.packed(bbit_minhash.minima(s)) for s in (a, b))
    same = sum(int(u >> np.uint64(k)) & 15 == int(v >> np.uint64(k)) & 15 for u, v in zip(x, y) for k in range(0, 64, 4))
    est = (same / 128 - 1 / 16) / (15 / 16)
    assert abs(est - 3000 / 5000) < 0.15


# -- vectors -------------------------------------------------------------------------

def _vectors():
    r = np.random.default_rng(11)
    rows = [(i, r.standard_normal(16)) for i in range(150)]
    centre = r.standard_normal(16)
    rows += [(1000 + i, centre + 0.18 * r.standard_normal(16)) for i in range(60)]
    rows += [(2000 + i, rows[3][1] * (i + 1)) for i in range(5)]
    return rows


def _plain_vectors(rows, threshold=0.9):
    x = {i: v / np.linalg.norm(v) for i, v in rows}
    g, n = plain.Groups(x), dict.fromkeys(x, 0)
    for a in x:
        for b in x:
            if a != b and x[a] @ x[b] >= threshold:
                n[a] += 1
                g.join(a, b)
    return {i: (n[i], g.find(i)) for i in x}


@pytest.mark.parametrize("block", [nn_descent.BLOCK, 16])
def test_vectors_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(nn_descent, "BLOCK", block)
    rows = _vectors()
    odd = [(9000, None), (9001, []), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [None] + [1.0] * 15),
           (9005, [float("inf")] + [0.0] * 15), (9006, [1.0, 2.0]), (None, [1.0] * 16), (3, [float(y) for y in rows[3][1]])]
    df = spark.createDataFrame([(i, [float(y) for y in v], 1) for i, v in rows] + [(i, v, 1) for i, v in odd],
                               "vec_id long, embedding array<double>, node int")
    got = nn_descent.near_vectors(df).collect()
    assert len(got) == len(rows) + len(odd)
    expect = _plain_vectors(rows) | {i: (0, i) for i, _ in odd if i != 3}
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == expect
    assert all(r.kept == (r.vec_id == r.component_id or r.vec_id is None) for r in got)


def test_vectors_of_rows_that_share_an_id(spark):
    x, y = [1.0, 0.0, 0.1], [0.0, 1.0, 0.1]
    rows = [(1, x), (2, y), (3, x), (3, y), (4, [0.0, 0.0, -1.0]), (4, None), (None, x)]
    out = nn_descent.digest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in out) == [
        ("1", 1, "1", True), ("2", 1, "1", False), ("3", 1, "1", False), ("3", 1, "1", False), ("4", 0, "4", True), ("4", 0, "4", True),
        ("None", 0, "None", True)]


def test_vectors_audit_weighs_vectors_not_links(spark):
    r = np.random.default_rng(8)
    hot = r.normal(size=8)
    rows = [(i, (hot + r.normal(scale=0.01, size=8)).tolist()) for i in range(300)]
    for k in range(40):  # pairs
        c = r.normal(size=8)
        rows += [(1000 + 2 * k + j, (c + r.normal(scale=0.01, size=8)).tolist()) for j in (0, 1)]
    vectors = spark.createDataFrame(rows, "node long, v array<double>")
    nodes = vectors.withColumnRenamed("node", "id").mapInArrow(nn_descent._clean, "id long, dim int, unit binary").withColumnRenamed("id", "node")
    chain = spark.createDataFrame([(i, i + 1) for i in range(299)] + [(i + 1, i) for i in range(299)]
                                  + [(0, i) for i in range(2, 20)], "a long, b long")
    pairs = spark.createDataFrame([(1000 + 2 * k + j, 1000 + 2 * k + 1 - j) for k in range(40) for j in (0, 1)], "a long, b long")
    assert nn_descent._audit(chain.unionByName(pairs), nodes, 0.9) == 1.0  # a full list: the hot component is counted in blocks
    assert nn_descent._audit(chain, nodes, 0.9) < 0.95  # the pairs are missed, however many links the hot one has


def _two_clusters(n, dims=16, seed=12):
    """Two tight clusters whose centres are just under the threshold apart: all
    lists are full of the own cluster, and few pairs across are links."""
    r = np.random.default_rng(seed)
    out = []
    for k, angle in enumerate((0.0, np.arccos(0.898))):
        c = np.zeros(dims)
        c[0], c[1] = np.cos(angle), np.sin(angle)
        out += [(100 * k + i, (c + r.normal(scale=0.004, size=dims)).tolist()) for i in range(n)]
    far = np.zeros(dims)
    far[5] = 1.0
    out += [(500 + i, (far + r.normal(scale=0.004, size=dims)).tolist()) for i in range(20)]
    return [(i, [*v[:-1], 0.0]) for i, v in out]


@pytest.mark.parametrize("ball,balls", [(nn_descent.BALL, nn_descent.BALLS), (5, 3)])
def test_links_that_full_lists_leave_out(spark, monkeypatch, ball, balls):
    monkeypatch.setattr(nn_descent, "BALL", ball)
    monkeypatch.setattr(nn_descent, "BALLS", balls)
    rows = _two_clusters(40)
    expect = _plain_vectors(rows)
    assert {c for _, c in expect.values()} == {0, 500}  # links across join the two
    got = nn_descent.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == expect


def test_no_vectors(spark):
    assert nn_descent.digest(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# -- repeats ---------------------------------------------------------------------------

def _repeat_texts(words):
    shared = " ".join(words(30, 41))
    a, b = " ".join(words(60, 42)), " ".join(words(50, 43))
    return [a + shared + b, "x" + shared, shared[5:], a, "ab" * 300, "z" * 250, None, "", "é" * 150, b + shared[:60] + "!", b + shared[:60] + "?",
            "The same line of some length here.\n" * 9, "The same line of some length here.\n" * 2 + shared, a, " ".join(words(9000, 44))]


@pytest.mark.parametrize("length,gram,bucket", [(40, 16, 4096), (40, 16, 2), (60, 30, 3)])
def test_repeats_against_plain_version(spark, words, length, gram, bucket):
    texts = _repeat_texts(words)
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]  # a repeated row
    out = repeats.remove_repeats(_docs(spark, rows), length, gram, bucket).collect()
    expect = plain.repeated_bytes([t for _, t in rows], length)
    assert sorted((r.doc_id, bytes(r.kept), len(r.removed), sum(s.end - s.start for s in r.removed)) for r in out) \
        == sorted((i, *e) for (i, _), e in zip(rows, expect))


def test_repeats_equal_grams_in_one_short_text(spark, words):
    rows = [(i, "-=*_.#~+"[i % 8] * 195 + " ".join(words(12, 700 + i))[:30]) for i in range(40)]
    out = {r.doc_id: r for r in repeats.remove_repeats(_docs(spark, rows)).collect()}
    assert plain.repeated_bytes([t for _, t in rows], 200) == [(t.encode(), 0, 0) for _, t in rows]
    assert all(bytes(out[i].kept) == t.encode() and not out[i].removed for i, t in rows)


def test_repeats_of_one_passage_in_other_surroundings_meet_in_no_task(spark, words, monkeypatch):
    shared = " ".join(words(40, 77))[:40]
    texts = [f"{' '.join(words(9, 500 + i))} {shared}{chr(97 + i % 26)}{' '.join(words(9, 900 + i))}" for i in range(120)]
    most = []
    finish = repeats._finish_sorted
    log = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    def counted(rows, rim):
        def seen():
            for pdf in rows:
                with open(f"{log}/{os.getpid()}", "a") as f:
                    f.write(f"{pdf.groupby('bucket').size().max()}\n")
                yield pdf
        return finish(seen(), rim)

    monkeypatch.setattr(repeats, "_finish_sorted", counted)
    out = repeats.remove_repeats(_docs(spark, list(enumerate(texts))), 40, 16, 8).collect()
    expect = plain.repeated_bytes(texts, 40)
    assert sorted((r.doc_id, bytes(r.kept)) for r in out) == sorted((i, e[0]) for i, e in enumerate(expect))
    for name in os.listdir(log):
        most += [int(x) for x in open(f"{log}/{name}").read().split()]
    assert max(most, default=0) <= 8


def test_repeats_long_texts_are_taken_in_parts(monkeypatch):
    data = np.random.default_rng(3).integers(97, 100, 20_000, np.uint8).tobytes()
    whole = repeats.chosen(data)
    monkeypatch.setattr(repeats, "PART", 1500)
    parts = repeats.chosen(data)
    assert all((x == y).all() for x, y in zip(whole[:2], parts[:2])) and len(whole[0]) == len(set(parts[0]))


def test_repeats_of_one_row_are_gathered_once(spark, words):
    text = " ".join(words(60, 12))
    rows = [(1, text)] * 3000 + [(2, "short")]
    docs = _docs(spark, rows).select(F.col("doc_id"), F.col("text"), F.xxhash64(F.col("doc_id").cast("string"), "text").alias("key"))
    spans = repeats.repeated_spans(docs.select("key", "text")).collect()
    assert len(spans) == 1 and len(spans[0].spans) < 100
    out = repeats.digest(_docs(spark, rows)).groupBy("doc_id", "n_removed").count().collect()
    assert sorted(map(tuple, out)) == [(1, len(text.encode()), 3000), (2, 0, 1)]


def test_repeats_empty_table(spark):
    assert repeats.digest(_docs(spark, [(1, "a")]).limit(0)).count() == 0


# -- mixing ----------------------------------------------------------------------------

def _plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        unit = (total - sum(fixed.values())) / sum(w[s] for s in free) if free else 0
        over = [s for s in free if unit * w[s] > most * sizes[s]]
        if not over:
            return fixed | {s: unit * w[s] for s in free}
        fixed |= {s: most * sizes[s] for s in over}


def test_mix(spark):
    r = random.Random(2)
    rows = [(i, " ".join("w" * 3 for _ in range(r.randint(1, 60))), None, r.choice(["a", "B", "é", None, "tiny", "big", "big", "big"]), i)
            for i in range(3000)]
    rows += [(9000, None, None, "a", 0), (9001, "", None, "none", 0), (9002, " \x0b\t", None, None, 0), (9003, "x y", None, "tiny2", 0)]
    rows += [rows[0]]
    df = spark.createDataFrame(rows, DOCS)
    out = pivotal_mix.mix_sources(df).collect()
    assert len(out) == len(rows)
    sizes, taken = {}, {}
    for x in out:
        sizes[x.source] = sizes.get(x.source, 0) + x["size"]
        taken[x.source] = taken.get(x.source, 0) + x["size"] * x.copies
        assert 0 <= x.copies <= 3
    expect = _plain_targets(sizes)
    for x in out:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(expect[x.source])
    for s in sizes:
        assert abs(taken[s] - expect[s]) <= 60 + 0.02 * expect[s]
    again = pivotal_mix.mix_sources(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    plan = pivotal_mix.digest(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)
    assert pivotal_mix.digest(df.limit(0)).count() == 0


def test_mix_of_rows_that_share_an_id(spark, monkeypatch):
    monkeypatch.setattr(pivotal_mix, "RUN", 100)
    rows = [(7 if i % 2 else None, "w " * (20 + i % 3), None, "abc"[i % 3], 0) for i in range(3000)] + [(i, "v " * 30, None, "d", 0) for i in range(500)]
    df = spark.createDataFrame(rows, DOCS)
    out = pivotal_mix.mix_sources(df).collect()
    assert sorted((str(x.doc_id), x.source, x["size"]) for x in out) == sorted((str(i), s, len(t) // 2) for i, t, _, s, _ in rows)
    sizes, taken = {}, {}
    for x in out:
        sizes[x.source] = sizes.get(x.source, 0) + x["size"]
        taken[x.source] = taken.get(x.source, 0) + x["size"] * x.copies
    expect = _plain_targets(sizes)
    assert all(abs(taken[s] - expect[s]) <= 60 + 0.02 * expect[s] for s in sizes)
    again = pivotal_mix.mix_sources(df.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


# -- pages -----------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body><header class=top>Site</header>
<nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div id=wrap><div class="story"><h2>Head {n}</h2><p>One &amp; <b>two</b>three {n}.<p>Un&eacute; para {n}<br>graph {n}
<script>if (a < b) document.write("<p>no</p>")</script><!-- no --></div><p>Share this story</p>
<div class="comments"><p>First!</p></div></div><aside>Side</aside><form><input name=q>Search</form><footer>&copy; me</footer></body></html>"""


def test_pages_without_article_follow_the_template(spark):
    rows = [(i, f"https://h.example/{i}", PAGE.format(n=f"number{i}" * (1 + i % 3)), "x") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    out = {r.page_id: r for r in page_templates.digest(df).collect()}
    for i in range(20):
        n = f"number{i}" * (1 + i % 3)
        assert out[i].text == f"Head {n} One & twothree {n}. Uné para {n} graph {n}"
        assert out[i].n_chars == len(out[i].text)


def test_pages_odd_rows(spark):
    art = "<body><nav>x</nav><article><h1>A</h1><p>b  c\n d<p>&lt;e&gt;<footer>f</footer></article>tail"
    rows = [(1, None, art), (2, "nonsense", None), (3, "http://a/", ""), (4, "http://a/", "<article><p>cut of<"), (4, "http://a/", "plain <i>te</i>xt"),
            (None, "http://a/", "<main>m" + "<div>" * 2000 + "deep"), (5, "http://A:80/", "<p>" + "long words " * 20_000)]
    out = page_templates.digest(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {(r.page_id, r.text) for r in out}
    assert len(out) == 7 and {(1, "A b c d <e>"), (2, ""), (3, ""), (4, "cut of<"), (4, "plain text"), (None, "m deep")} <= texts
    assert page_templates.digest(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_with_marks_around_the_article():
    art, plain = page_templates.Template(None), "<article><h1>A</h1><p>The whole text of it.</p></article>"
    around = ['<div class="overflow-hidden">', '<div class="overflow-x-hidden">', '<div style="overflow:hidden">', '<div class="content with-sidebar">',
              '<div class="share-enabled">', '<form id="aspnetForm">', '<div class="sidebar"><form>', '<div class="content share" data-hidden="x">']
    for tag in around:
        assert page_templates.main_text(f"<body><nav>x</nav>{tag}{plain}<div class='share-buttons'>Share</div></body>", art) == "A The whole text of it."
        assert page_templates.main_text(f"<body>{tag}<main>{plain}</main></body>", art) == "A The whole text of it."
    for body in ('<body class="overflow-hidden">', '<body style="display:none">', "<body hidden>"):
        assert page_templates.main_text(body + plain, art) == "A The whole text of it."
    form = "<form><nav>Menu</nav><h1>A</h1><p>The whole text of it.</p><div class='site-footer'>Foot</div></form>"
    assert page_templates.main_text(form, art) == "A The whole text of it."
    # still out: hidden parts, marks inside the article, comments and notices longer than it, comments that are articles
    long = "many words " * 50
    for part in (f"<div hidden>{long}</div>", f'<p style="color:red; DISPLAY : none !important">{long}</p>', f'<div aria-hidden="true">{long}</div>',
                 f'<div class="share">{long}</div>', f'<form>{long}</form>', f'<div id="main-nav">{long}</div>'):
        assert page_templates.main_text(f"<article><h1>A</h1><p>Short.</p>{part}</article>", art) == "A Short."
    for part in (f'<div id="comments"><article class="comment">{long}</article><article>{long}</article></div>', f'<div class="cookie-notice">{long}</div>',
                 f'<section class="site-comments">{long}</section>'):
        assert page_templates.main_text(f"<body><article><h1>A</h1><p>Short.</p></article>{part}</body>", art) == "A Short."
        assert page_templates.main_text(f"<body><div><h1>A</h1><p>Short.</p></div>{part}</body>", art) == "A Short."


def test_copies_of_a_page_are_no_template(spark):
    story = "<body><div class=top><p>Welcome to us</p></div>{0}<h1>Head {1}</h1><p>Story of {1} with words.</p>{2}</body>"
    names = ["copied"] * 30 + [f"n{'x' * i}" for i in range(12)]
    for host, (a, b) in enumerate((("<article>", "</article>"), ("<div id=w>", "</div>"))):
        rows = [(i if i % 3 else 1, f"https://h{host}.example/", story.format(a, f"{n} {i}" if i % 2 and not host else n, b))
                for i, n in enumerate(names)]
        out = page_templates.digest(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
        want = [re.sub("<[^>]*>", " ", h[h.find(a):]) for _, _, h in rows]
        assert sorted(r.text for r in out) == sorted(" ".join(x.split()) for x in want)


def test_template_classes_of_one_token_are_no_template():
    token = lambda t, n=0: {"token": t, "running": n}
    classes = [{"pages": 20, "tokens": [token("", 900), token("/body", 900), token("#/body/p\nShare this")]},
               {"pages": 13, "tokens": [token("#/body/p\nBreaking news")]}]
    page = "<body><p>Breaking news<p>A story<p>Share this"
    assert page_templates.main_text(page, page_templates.Template(classes)) == "Breaking news A story"
    assert page_templates.main_text(page.replace("<p>", "<article><p>", 1), page_templates.Template(classes)) == "Breaking news A story Share this"


def test_page_query_against_article_regions(spark):
    import html
    rows = duckdb.sql(f"select page_id, html from '{SF}/pages.parquet'").fetchall()
    got = {r.page_id: r.text for r in QUERIES["op5_page_templates"](spark, SF).collect()}
    for i, h in rows:
        a, b = h.find("<article>"), h.find("</article>")
        body = re.sub("<[^>]*$", "", h[a:b if b >= 0 else len(h)])
        parts = [" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:article|h1|p|br)>", body)]
        assert got[i] == " ".join(x for x in parts if x)


# -- toxicity ----------------------------------------------------------------------------

def _toxic_docs(words):
    bad, docs, labels = ["wexomit", "zuquarb", "plomvik"], [], []
    for i in range(900):
        w = words(60, 1000 + i % 300)
        random.Random(i).shuffle(w)
        if i % 5 == 0:
            w[i % 50] = bad[i % 3]
        docs.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(i % 5 == 0)))
    clean = " ".join(words(40, 5000))
    extra = {9000: f"{clean} w3x0m1t", 9001: f"{clean} z u q u a r b", 9002: f"{clean} plooooomvik", 9003: clean, 9004: None, 9005: "",
             9006: f"{clean} 12 3.5 2024-01-02", 9007: (clean + " ") * 400}
    docs += [(i, t, None, None, 0) for i, t in extra.items()]
    labels += [(3, 1, None), (None, 1, 1), (77777, 0, 1), (5, 0, 1)]
    return docs, labels


def test_toxicity(spark, words):
    docs, labels = _toxic_docs(words)
    df = spark.createDataFrame(docs, DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.digest(df, marks).collect()}
    assert len(out) == len(docs) and all(0 <= r.score <= 1 for r in out.values())
    for i in (9000, 9001, 9002):  # leetspeak, spacing, repetition
        assert out[i].predicted == 1
    for i in (9003, 9004, 9005, 9006, 9007):
        assert out[i].predicted == 0
    held = [i for i in range(900) if out[i].held_out]
    assert 200 < len(held) < 400 and sum(out[i].predicted == (i % 5 == 0) for i in held) >= 0.98 * len(held)
    kept = toxicity.reject_toxic(df, marks)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if not r.predicted}


def test_toxicity_of_disguised_edges_and_bare_signs(spark, words):
    bad, docs, labels = ["idiot", "loser", "salat"], [], []
    for i in range(900):
        w = words(60, 1000 + i % 300)
        random.Random(i).shuffle(w)
        if i % 5 == 0:
            w[i % 50] = bad[i % 3]
        docs.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(i % 5 == 0)))
    clean = " ".join(words(40, 5000))
    noisy = ["!diot", "|oser", "idio+", "(!diot)", "$@|@+", "i  d  i \t o  t", "'idiot!'"]
    docs += [(9000 + k, f"{clean} {x} {clean}", None, None, 0) for k, x in enumerate(noisy)]
    plain_ = ["12 3.5 2024-01-02 455", "!!! $100 +49 (1) | 7", words(1, 9)[0] + "!", "a  b  c"]
    docs += [(9500 + k, f"{clean} {x} {clean}", None, None, 0) for k, x in enumerate(plain_)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r.predicted for r in toxicity.digest(spark.createDataFrame(docs, DOCS), marks).collect()}
    assert [x for k, x in enumerate(noisy) if not out[9000 + k]] == []
    assert [x for k, x in enumerate(plain_) if out[9500 + k]] == []


def test_toxicity_with_few_labels(spark, words):
    docs = [(i, " ".join(words(30, 3000 + i)), "en", "s", 0) for i in range(60)]
    marks = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    out = toxicity.digest(spark.createDataFrame(docs, DOCS), marks).collect()
    assert len(out) == 60 and all(0 <= r.score < 0.7 for r in out)


def test_toxicity_without_labels_or_rows(spark):
    df = _docs(spark, [(1, "some words"), (2, None)])
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.score < 1e-6, r.predicted) for r in toxicity.digest(df, marks).collect()] == [(True, 0)] * 2
    assert toxicity.digest(df.limit(0), marks).count() == 0


# -- pipeline ----------------------------------------------------------------------------

def test_pipeline_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = duckdb.sql(f"select cast(item_id as varchar), text from '{SF}/benchmark.parquet'").fetchall()
    before, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = spark.createDataFrame(stage(spark, before, SF).collect(), None) if name == "mix" else stage(spark, before, SF)
        if name != "mix":
            assert after.columns == columns
            after = spark.createDataFrame(after.collect(), docs.schema)
        a, b = ({r.doc_id: r for r in x.collect()} for x in (before, after))
        if name == "line_dedup":
            assert set(a) == set(b)
            assert all(set(b[i].text.split("\n")) <= set(a[i].text.split("\n")) | {""} for i in a)
        if name == "near_dedup":
            groups = plain.near_duplicates({i: r.text for i, r in a.items()}, 5, 80)
            assert set(b) == {i for i, (_, c) in groups.items() if i == c}
        if name == "decontaminate":
            hits = plain.contamination({i: r.text for i, r in a.items()}, bench)
            assert set(b) == {i for i, (_, n, _) in hits.items() if not n}
            assert all(a[i].text == b[i].text for i in b)
        if name == "mix":
            assert set(a) == set(b)
        before = after
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_empty_documents(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
