"""Bronze -> silver (C1): deduplicate, clean text, type numbers and dates.

Per-cell semantics: a bad number or date becomes NULL for that cell only.
A fractional quantity is never truncated; the row goes to the rejects
(dead letter) with a reason.  Optionally (P9) non-positive quantities or
prices are rejected too.  After the de-duplication shuffle everything is
narrow projections and filters, inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import DEFAULT_DATE_FORMATS, parse_order_date_stripped
from starloom.functions.numbers import (
    double_of_stripped, exact_long_of_stripped, is_whole, round_half_even_long,
    whole_to_long,
)
from starloom.functions.text import blank_to_not_provided, punct_to_space, strip_unicode
from starloom.operators.incremental import distinct_records
from starloom.schemas import (
    BRONZE_BUSINESS_COLUMNS, BRONZE_TEXT_COLUMNS, SILVER, SILVER_RENAMES,
)

REJECT_FRACTIONAL_QUANTITY = "fractional_quantity"
REJECT_NON_POSITIVE_QUANTITY = "non_positive_quantity"
REJECT_NON_POSITIVE_PRICE = "non_positive_price"


def drop_exact_duplicates(bronze: DataFrame, stored: bool = False) -> DataFrame:
    """A1: one row per distinct business tuple (NULLs compare equal).
    The ingestion stamp is left out of the comparison.  Spark combines
    duplicates map-side before the shuffle, so a hot duplicate costs one
    row per task.

    A table that is ``stored`` can be read again: its records' hashes are
    exchanged first, and then only the records that may come twice."""
    if stored:
        return distinct_records(bronze).drop("h")
    return bronze.dropDuplicates(BRONZE_BUSINESS_COLUMNS)


def typed(src: DataFrame, date_formats=DEFAULT_DATE_FORMATS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bronze text -> typed columns (bronze names), plus ``_fractional_qty``,
    the raw text as ``_raw_<name>`` and columns ``keep`` as they are.

    Three stacked projections, so every string function runs once per cell:
    Catalyst keeps them apart because the later steps use each expensive
    result more than once (a single nested expression would repeat them).
    """
    keys = ("PRODUCTKEY", "CUSTOMERKEY")
    nums = ("QUANTITY", "NET_PRICE")
    raw = [F.col(c).alias(f"_raw_{c}") for c in BRONZE_BUSINESS_COLUMNS]
    ingest = (F.col("INGESTION_DATE") if "INGESTION_DATE" in src.columns
              else F.lit(None)).cast("timestamp").alias("INGESTION_DATE")
    # 1: punctuation + strip for text and dates, strip for numbers
    s1 = src.select(
        *[strip_unicode(punct_to_space(c)).alias(c) for c in BRONZE_TEXT_COLUMNS],
        strip_unicode(punct_to_space("ORDERDATE")).alias("ORDERDATE"),
        *[strip_unicode(c).alias(c) for c in keys + nums],
        ingest, *raw, *keep)
    # 2: blanks, number and date parsing
    s2 = s1.select(
        *[blank_to_not_provided(c).alias(c) for c in BRONZE_TEXT_COLUMNS],
        parse_order_date_stripped(F.col("ORDERDATE"), date_formats).alias("ORDERDATE"),
        *[exact_long_of_stripped(F.col(c)).alias(f"_l_{c}") for c in keys],
        *[double_of_stripped(F.col(c)).alias(f"_d_{c}") for c in keys + nums],
        "INGESTION_DATE", *[f"_raw_{c}" for c in BRONZE_BUSINESS_COLUMNS], *keep)
    # 3: whole-number checks and rounding
    q = F.col("_d_QUANTITY")
    cols = {
        "PRODUCTKEY": F.coalesce("_l_PRODUCTKEY", whole_to_long(F.col("_d_PRODUCTKEY"))),
        "CUSTOMERKEY": F.coalesce("_l_CUSTOMERKEY", whole_to_long(F.col("_d_CUSTOMERKEY"))),
        "QUANTITY": whole_to_long(q),
        "NET_PRICE": round_half_even_long(F.col("_d_NET_PRICE")),
    }
    return s2.select(
        *[cols[c].alias(c) if c in cols else F.col(c) for c in BRONZE_BUSINESS_COLUMNS],
        (q.isNotNull() & ~is_whole(q)).alias("_fractional_qty"),
        "INGESTION_DATE", *[f"_raw_{c}" for c in BRONZE_BUSINESS_COLUMNS], *keep)


def _rules(reject_non_positive: bool) -> list[tuple[Column, str]]:
    rules = [(F.col("_fractional_qty"), REJECT_FRACTIONAL_QUANTITY)]
    if reject_non_positive:
        rules += [(F.col("QUANTITY") <= 0, REJECT_NON_POSITIVE_QUANTITY),
                  (F.col("NET_PRICE") <= 0, REJECT_NON_POSITIVE_PRICE)]
    return [(F.coalesce(cond, F.lit(False)), label) for cond, label in rules]


def _first_of(cases: list[tuple[Column, object]]) -> Column:
    expr = None
    for cond, value in cases:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr


def reject_reason(reject_non_positive: bool = False) -> Column:
    """First matching reason, NULL for a good row."""
    return _first_of(_rules(reject_non_positive))


def clean_sales_split(bronze: DataFrame, *, date_formats=DEFAULT_DATE_FORMATS,
                      reject_non_positive: bool = False,
                      dedup: bool = True, together: bool = False) -> tuple[DataFrame, DataFrame]:
    """C1 with the dead-letter split (P9).  Returns (silver, rejects).

    ``rejects`` keeps the raw bronze text of the row plus ``reject_reason``.

    Read on its own, each side rejects ahead of the de-duplication, which then
    moves its rows only.  A plan that reads both sides ``together`` would do
    all that twice: there a row takes the number of its reason through one
    de-duplication that both share (equal records have equal reasons).
    """
    if dedup and together:
        rules = _rules(reject_non_positive)
        number = _first_of([(cond, F.lit(i)) for i, (cond, _) in enumerate(rules)])
        numbered = typed(bronze).select(*[F.col(f"_raw_{c}").alias(c) for c in BRONZE_BUSINESS_COLUMNS], "INGESTION_DATE",
                                        number.alias("_reason"))
        reason = _first_of([(F.col("_reason") == i, label) for i, (_, label) in enumerate(rules)])
        flagged = typed(drop_exact_duplicates(numbered), date_formats, ("_reason",)).withColumn("reject_reason", reason)
    else:
        src = drop_exact_duplicates(bronze) if dedup else bronze
        flagged = typed(src, date_formats).withColumn("reject_reason",
                                                      reject_reason(reject_non_positive))
    silver = (
        flagged.filter(F.col("reject_reason").isNull())
        .withColumnsRenamed(SILVER_RENAMES)
        .withColumn("TRANSFORMED_DATE", F.current_timestamp())
        .select(*SILVER.fieldNames())
    )
    rejects = flagged.filter(F.col("reject_reason").isNotNull()).select(
        *[F.col(f"_raw_{c}").alias(c) for c in BRONZE_BUSINESS_COLUMNS],
        "INGESTION_DATE", "reject_reason")
    return silver, rejects


def clean_sales(bronze: DataFrame, **kw) -> DataFrame:
    """The silver rows only."""
    return clean_sales_split(bronze, **kw)[0]


def clean_distinct(bronze: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct tuples of some ``columns`` of silver.  Cleaning looks at one row
    at a time, so the text of these columns is made distinct first and each
    tuple is cleaned once, not with every line that names it."""
    quantity = double_of_stripped(strip_unicode("QUANTITY"))
    fractional = F.coalesce(quantity.isNotNull() & ~is_whole(quantity), F.lit(False))
    raw = [c for c in BRONZE_BUSINESS_COLUMNS if SILVER_RENAMES.get(c, c) in columns]
    tuples = bronze.filter(~fractional).select(*raw).distinct()
    whole = tuples.select(*[F.col(c) if c in raw else F.lit(None).cast("string").alias(c) for c in BRONZE_BUSINESS_COLUMNS])
    return clean_sales(whole, dedup=False).select(*columns).distinct()


def split_dead_letter(bronze: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """(good, bad) with the non-positive rule switched on."""
    kw.setdefault("reject_non_positive", True)
    return clean_sales_split(bronze, **kw)
