"""Secret scans: keyword automaton, anchored patterns near hits, checksums.

One Aho-Corasick pass over a whole text finds keywords; only at a hit is the
pattern of that keyword's kind tried, anchored at the place that the hit
names.  Patterns are never searched over the text.

Kinds, in the order in which spans that start together are listed:

``assign``  a secret-like name, ``:`` or ``=``, and a value of 12 characters or more;
``access``  ``AKIA`` and upper-case letters or digits, 18 characters or more;
``hex``     a maximal run of lower-case hex digits, 16 characters or more.  Its
            keywords are all hex strings of ``HEX_GRAM`` digits, made by rule:
            every run that is long enough contains one;
``github``, ``npm``  prefixed tokens whose last six base-62 characters are the
            CRC-32 of the 30 before them; a wrong checksum drops the match;
``jwt``     three base64url parts of which the first decodes to JSON with ``alg``.

The first three are matched leftmost and without overlaps within a kind, as a
search with the same pattern would: a match that is too short is dropped but
its characters stay used.  Offsets count code points, ends are exclusive.
NULL and empty texts have no spans; repeated rows are scanned one by one.
"""

from __future__ import annotations

import base64
import binascii
import itertools
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kinds in listing order.
BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "github", "npm", "jwt"]
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16

# Patterns by kind.
PATTERNS = {
    "assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
    "github": r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])",
    "npm": r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])",
    "jwt": r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)",
}
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
HEX_DIGITS = "0123456789abcdef"
HEX_GRAM = 4
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SPANS_TYPE = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType())]))

_STATE: dict = {}


def keywords() -> dict[str, str]:
    """Every keyword of the automaton with its kind.  The automaton reads the
    text as it is, so words matched in either case are listed in all cases."""
    words = {"".join(x): "assign" for w in ASSIGN_WORDS
             for x in itertools.product(*[sorted({c, c.upper()}) for c in w])}
    words["AKIA"] = "access"
    words |= {"".join(x): "hex" for x in itertools.product(HEX_DIGITS, repeat=HEX_GRAM)}
    words |= {f"gh{c}_": "github" for c in "pousr"}
    return words | {"npm_": "npm", "eyJ": "jwt"}


def _compiled():
    if not _STATE:
        import ahocorasick

        auto = ahocorasick.Automaton()
        for word, kind in keywords().items():
            auto.add_word(word, (KINDS.index(kind), len(word)))
        auto.make_automaton()
        flags = {"assign": re.ASCII | re.IGNORECASE}
        _STATE["auto"] = auto
        _STATE["match"] = [re.compile(PATTERNS[k], flags.get(k, re.ASCII)).match for k in KINDS]
    return _STATE["auto"], _STATE["match"]


def crc62(payload: str) -> str:
    """CRC-32 as six base-62 digits."""
    n, out = binascii.crc32(payload.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out


def _json_header(part: str) -> bool:
    try:
        head = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(head, dict) and "alg" in head


def _valid(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return m.end(2) - m.start(2) >= MIN_VALUE
    if kind in ("github", "npm"):
        return crc62(m[1]) == m[2]
    if kind == "jwt":
        return _json_header(m[1])
    return m.end() - m.start() >= (MIN_ACCESS if kind == "access" else MIN_HEX)


def find_spans(text: str | None) -> list[dict]:
    """All spans of one text, ordered by start and then kind."""
    if not text:
        return []
    auto, match = _compiled()
    free = [0] * len(KINDS)  # where the next match of a kind may start
    hex_kind = KINDS.index("hex")
    found = []
    for last, (k, n) in auto.iter(text):
        start = last + 1 - n
        if start < free[k]:
            continue
        if k == hex_kind:  # to the start of the run of digits
            while start > free[k] and text[start - 1] in HEX_DIGITS:
                start -= 1
        m = match[k](text, start)
        if m:
            free[k] = m.end()
            if _valid(KINDS[k], m):
                found.append((start, k, m.end()))
    return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(found)]


@F.pandas_udf(SPANS_TYPE)
def secret_spans(text: pd.Series) -> pd.Series:
    return text.map(find_spans)


def scan_secrets(docs: DataFrame, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """``docs`` with an array of spans (kind, start, end) per row.  Other
    columns pass unchanged; ``out_col`` replaces a column of that name."""
    return docs.withColumn(out_col, secret_spans(F.col(text_col).cast("string")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns: counts of the base kinds and span lists."""
    scanned = scan_secrets(docs.select("doc_id", "text")).select("doc_id", "spans")

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    n = {k: F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS}
    return scanned.select("doc_id", *n.values(), F.sha2(joined(of(*BASE_KINDS)), 256).alias("base_sha256"),
                          joined(F.col("spans")).alias("spans"))
