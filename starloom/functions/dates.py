"""Date parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.text import punct_to_space, strip_unicode

# Accepted order-date layouts, tried in order; anything else is NULL.
DEFAULT_DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_order_date(col, formats=DEFAULT_DATE_FORMATS) -> Column:
    """text -> TIMESTAMP_NTZ, bad or missing -> NULL.

    The text first gets the same punctuation/strip pass as other text
    columns.
    """
    return parse_order_date_stripped(strip_unicode(punct_to_space(_c(col))), formats)


def parse_order_date_stripped(s: Column, formats=DEFAULT_DATE_FORMATS) -> Column:
    """F5 on text that already had the punctuation/strip pass.

    The formats decide which texts are accepted; the value itself comes from
    a cast to TIMESTAMP_NTZ, which involves no time zone (a zone round trip
    would move wall-clock times that fall into a DST gap of the session zone).
    """
    accepted = F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats]).isNotNull()
    return F.when(accepted, s.try_cast("timestamp_ntz"))


def to_day(col) -> Column:
    """DATE(ts)."""
    return F.to_date(_c(col))


def date_key(col) -> Column:
    """yyyyMMdd as int."""
    return F.date_format(_c(col), "yyyyMMdd").cast("int")


def full_date_description(col) -> Column:
    """e.g. 'Monday, 01 January 2007'."""
    return F.date_format(_c(col), "EEEE, dd MMMM yyyy")


def is_weekday(col) -> Column:
    """1 for Monday-Friday, else 0 (weekday(): Monday = 0)."""
    return (F.weekday(_c(col)) < 5).cast("int")
