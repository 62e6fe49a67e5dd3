"""Text cleaning (F1-F4): punctuation to space, Unicode strip, blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's cleaning rules:
# each of , ; ? ( ) becomes one space; empty or missing text becomes "Not Provided".
PUNCTUATION = ",;?()"
NOT_PROVIDED = "Not Provided"

# The characters Python's str.strip() removes (str.isspace()),
# in code-point order: U+0009-U+000D, U+001C-U+001F, U+0020, U+0085, U+00A0,
# U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
# Spark's one-argument trim() removes U+0020 only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def punct_to_space(col) -> Column:
    """replace each of , ; ? ( ) by one space (runs are not collapsed)."""
    return F.translate(_c(col), PUNCTUATION, " " * len(PUNCTUATION))


def strip_unicode(col) -> Column:
    """strip leading and trailing whitespace (linear, no regex)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def blank_to_not_provided(col) -> Column:
    """F3 + F4: empty string or NULL becomes "Not Provided"."""
    return F.coalesce(F.nullif(_c(col), F.lit("")), F.lit(NOT_PROVIDED))


def clean_text(col) -> Column:
    """F1 -> F2 -> F3/F4 in the reference's order (punctuation before strip)."""
    return blank_to_not_provided(strip_unicode(punct_to_space(col)))
