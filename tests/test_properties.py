"""Randomised checks of the cleaning functions against plain-Python models
of the same rules (one DataFrame per property, thousands of values)."""

import random
import re

from starloom.functions import numbers as fn
from starloom.functions import text as ft

ALPHABET = list("abcXYZ019 .,;?()-_#é") + ["\t", "\n", "\x0b", "\x1c", "\x1f", "\x85",
                                            "\xa0", " ", "　", "​"]


def _strings(n, seed, alphabet=ALPHABET, max_len=12):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        k = rnd.randint(0, max_len)
        out.append("".join(rnd.choice(alphabet) for _ in range(k)))
    out += [None, "", " ", "　"]
    return out


def _model_clean(s):
    if s is None:
        return "Not Provided"
    for ch in ",;?()":
        s = s.replace(ch, " ")
    s = s.strip()
    return s if s else "Not Provided"


def test_clean_text_matches_model(spark):
    vals = _strings(3000, 1)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x string")
    got = {r[0]: r[1] for r in df.select("i", ft.clean_text("x")).collect()}
    bad = [(vals[i], got[i]) for i in range(len(vals)) if got[i] != _model_clean(vals[i])]
    assert not bad, bad[:5]


_PLAIN = re.compile(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$")


def _model_double(s):
    if s is None:
        return None
    t = s.strip()
    return float(t) if _PLAIN.match(t) else None


def test_parse_double_matches_model(spark):
    vals = _strings(3000, 2, alphabet=list("0123456789+-.eE xd,") + ["\t", "inf", "nan"],
                    max_len=8)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x string")
    got = {r[0]: r[1] for r in df.select("i", fn.parse_double("x")).collect()}
    bad = [(vals[i], got[i]) for i in range(len(vals)) if got[i] != _model_double(vals[i])]
    assert not bad, bad[:5]


def test_round_half_even_matches_python(spark):
    rnd = random.Random(3)
    vals = [rnd.choice([rnd.randint(-50, 50) / 2, rnd.uniform(-1e6, 1e6)]) for _ in range(3000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = {r[0]: r[1] for r in df.select("i", fn.round_half_even_long(df.x)).collect()}
    assert all(got[i] == round(v) for i, v in enumerate(vals))
