"""Number parsing and rounding (F6-F8), per cell: one bad value never
spoils the good values of its column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.text import strip_unicode

# Plain decimal or scientific notation.  Hex, thousands separators, inf/nan
# and Java's trailing d/f suffixes are rejected (Spark's cast would accept
# some of them).
NUMBER_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_RE = r"^[+-]?[0-9]+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def double_of_stripped(s: Column) -> Column:
    """Already-stripped text -> double, NULL unless a plain number."""
    return F.when(s.rlike(NUMBER_RE), s.try_cast("double"))


def exact_long_of_stripped(s: Column) -> Column:
    """Already-stripped integer text -> bigint with every digit kept."""
    return F.when(s.rlike(INTEGER_RE), s.try_cast("bigint"))


def parse_double(col) -> Column:
    """text -> double, NULL when not a plain number."""
    return double_of_stripped(strip_unicode(_c(col)))


def is_whole(x: Column) -> Column:
    return x == F.floor(x)


def whole_to_long(x: Column) -> Column:
    """F8: a whole-valued double -> bigint; fractional or out of range -> NULL."""
    return F.when(is_whole(x), x.try_cast("bigint"))


def parse_long(col) -> Column:
    """Integer keys: exact bigint parse first (keeps digits above 2^53),
    then a whole-valued decimal such as ``12.0``; anything else is NULL."""
    s = strip_unicode(_c(col))
    return F.coalesce(exact_long_of_stripped(s), whole_to_long(double_of_stripped(s)))


def round_half_even_long(x: Column) -> Column:
    """round half to even, then to a nullable long (0.5 -> 0, 2.5 -> 2)."""
    return F.bround(x, 0).try_cast("bigint")
