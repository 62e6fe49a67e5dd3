"""Dimensions: date (C2, C12), year (C3), location (C4), customer (C5) and
the initial product load (C6).

Each dimension is one scan of silver, a DISTINCT or GROUP BY (map-side
partial aggregation first), dense surrogate keys from ``assign_keys`` and
the unknown member.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_key, full_date_description, is_weekday
from starloom.operators.keys import (
    assign_keys, broadcast_if_bounded, literal_row, with_unknown_member,
)
from starloom.schemas import DIM_PRODUCT, DIM_YEAR
from starloom.session import scratch_path

# The reference's date range, open end date and fallback begin date.
REFERENCE_DATE_START = "2007-01-01"
REFERENCE_DATE_END = "2015-12-31"
OPEN_END_DATE = "9999-12-31"
FALLBACK_BEGIN_DATE = "1900-01-01"
UNKNOWN = "Unknown"

PRODUCT_ATTRS = ["product_description", "color", "brand", "subcategory", "category"]
PRODUCT_SOURCE = {  # silver column -> dimension column
    "PRODUCTKEY": "product_number",
    "PRODUCT_NAME": "product_description",
    "COLOR": "color",
    "BRAND": "brand",
    "SUBCATEGORY": "subcategory",
    "CATEGORY": "category",
}


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def date_dimension(spark: SparkSession, start=REFERENCE_DATE_START,
                   end=REFERENCE_DATE_END, unknown: bool = False,
                   holidays: DataFrame | None = None) -> DataFrame:
    """One row per day in [start, end] (F9-F14), generated by
    ``spark.range`` so the rows are produced in parallel.  ``unknown=True``
    adds the optional unknown day row (C12).  ``holidays`` (a DataFrame with
    a ``date`` column) sets ``is_holiday = 1`` on those days (P10); without
    it every day is 0, as in the reference."""
    s, e = _as_date(start), _as_date(end)
    n = (e - s).days + 1
    d = F.date_add(F.lit(s), F.col("id").cast("int"))
    days = spark.range(0, max(n, 0)).select(d.alias("date"))
    out = days.select(
        date_key("date").alias("date_key"),
        F.col("date"),
        full_date_description("date").alias("full_date_description"),
        F.dayofmonth("date").alias("day"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.weekofyear("date").alias("week_number"),
        F.lit(0).alias("is_holiday"),  # P10: no holiday calendar
        is_weekday("date").alias("is_weekday"),
    )
    if holidays is not None:
        marks = broadcast_if_bounded(
            holidays.select(F.to_date("date").alias("_h")).distinct(), 1_000_000)
        out = (out.join(marks, F.col("date") == F.col("_h"), "left")
               .withColumn("is_holiday", F.col("_h").isNotNull().cast("int"))
               .drop("_h"))
    if unknown:
        # the reference's (commented-out) unknown day, kept verbatim as fixed values
        row = {"date_key": 20061231, "date": dt.date(2006, 1, 31),
               "full_date_description": UNKNOWN, "day": 31, "month": 12,
               "year": 2006, "quarter": 4, "week_number": 48, "is_holiday": 0,
               "is_weekday": 1}
        out = with_unknown_member(out, row, "date_key")
    return out


def year_dimension(date_dim: DataFrame) -> DataFrame:
    """Shrunken dimension, (-1, 9999) plus every year of the date dim."""
    years = (date_dim.filter(F.col("year").isNotNull() & (F.col("year") != -1))
             .select(F.col("year").alias("YEAR_KEY"), F.col("year").alias("YEAR"))
             .distinct())
    unknown = literal_row(date_dim.sparkSession, DIM_YEAR, {"YEAR_KEY": -1, "YEAR": 9999})
    return unknown.unionByName(years)


def unknown_location_row() -> dict:
    return {"location_key": -1, "continent": UNKNOWN, "country_region": UNKNOWN, "state": UNKNOWN, "city": UNKNOWN}


def unknown_customer_row() -> dict:
    return {"customer_key": -1, "customer_number": None, "customer_code": None, "name": UNKNOWN,
            "education": UNKNOWN, "occupation": UNKNOWN}


def location_dimension(silver: DataFrame) -> DataFrame:
    """C4: distinct (continent, country, city, state), keys by that order."""
    distinct = silver.select("CONTINENT", "COUNTRY_REGION", "CITY", "STATE").distinct()
    keyed = assign_keys(distinct, ["CONTINENT", "COUNTRY_REGION", "CITY", "STATE"],
                        "location_key")
    dim = keyed.select(
        "location_key",
        F.col("CONTINENT").alias("continent"),
        F.col("COUNTRY_REGION").alias("country_region"),
        F.col("STATE").alias("state"),
        F.col("CITY").alias("city"),
    )
    return with_unknown_member(dim, unknown_location_row(), "location_key")


def customer_dimension(silver: DataFrame, type1: bool = False) -> DataFrame:
    """Distinct (key, code, name, education, occupation) tuples, keys by
    (customer key, code) with the other attributes breaking ties.

    ``type1=True`` keeps one tuple per customer code: the one seen on the
    latest order (ties: the greatest tuple)."""
    cols = ["CUSTOMER_KEY", "CUSTOMER_CODE", "NAME", "EDUCATION", "OCCUPATION"]
    if type1:
        latest = silver.groupBy("CUSTOMER_CODE").agg(
            F.max_by(F.struct(*[c for c in cols if c != "CUSTOMER_CODE"]),
                     F.struct("ORDER_DATE", *[c for c in cols if c != "CUSTOMER_CODE"]))
            .alias("t"))
        distinct = latest.select("t.CUSTOMER_KEY", "CUSTOMER_CODE", "t.NAME",
                                 "t.EDUCATION", "t.OCCUPATION")
    else:
        distinct = silver.select(*cols).distinct()
    keyed = assign_keys(distinct, cols, "_customer_key")
    dim = keyed.select(
        F.col("_customer_key").alias("customer_key"),
        F.col("CUSTOMER_KEY").alias("customer_number"),
        F.col("CUSTOMER_CODE").alias("customer_code"),
        F.col("NAME").alias("name"),
        F.col("EDUCATION").alias("education"),
        F.col("OCCUPATION").alias("occupation"),
    )
    return with_unknown_member(dim, unknown_customer_row(), "customer_key")


def product_versions(silver: DataFrame, keep_null: bool = False) -> DataFrame:
    """A3: MAX(price) per (product, attribute set), with its first and last
    order date; NULL product keys are left out (their sales get the unknown
    product) unless ``keep_null``."""
    rows = silver if keep_null else silver.filter(F.col("PRODUCTKEY").isNotNull())
    return (rows.groupBy(*PRODUCT_SOURCE.keys())
            .agg(F.max("NET_PRICE").cast("double").alias("unit_price"),
                 F.max("ORDER_DATE").alias("last_order_date"),
                 F.min("ORDER_DATE").alias("first_order_date"))
            .withColumnsRenamed(PRODUCT_SOURCE))


def first_order_day(silver: DataFrame) -> dt.date:
    """A5: MIN(DATE(order date)), falling back to 1900-01-01 (one scalar)."""
    v = silver.agg(F.min(F.to_date("ORDER_DATE")).alias("d")).first()["d"]
    return v or dt.date.fromisoformat(FALLBACK_BEGIN_DATE)


PRODUCT_ORDER = ["product_number", *PRODUCT_ATTRS, "unit_price"]


def unknown_product_row() -> dict:
    return {"product_key": -1, "product_number": None, "product_description": UNKNOWN,
            "color": None, "brand": None, "subcategory": None, "category": None,
            "unit_price": None, "change_begin_date": None, "change_end_date": None,
            "is_current": 1}


def product_dimension_initial(silver: DataFrame) -> DataFrame:
    """First load of the SCD2 product dimension.  Every (product,
    attribute set) becomes a current version valid from the first order day
    to the open end date; keys follow (product number, attributes, price)."""
    spark, path = silver.sparkSession, scratch_path(silver.sparkSession, "product-versions")
    product_versions(silver, keep_null=True).write.parquet(path)  # one pass over silver
    staged = spark.read.parquet(path)
    begin = staged.agg(F.min(F.to_date("first_order_date")).alias("d")).first()["d"] \
        or dt.date.fromisoformat(FALLBACK_BEGIN_DATE)
    versions = staged.filter(F.col("product_number").isNotNull()).drop("last_order_date", "first_order_date")
    keyed = assign_keys(versions, PRODUCT_ORDER, "product_key")
    dim = keyed.select(
        "product_key", *PRODUCT_ORDER,
        F.lit(begin).alias("change_begin_date"),
        F.lit(dt.date.fromisoformat(OPEN_END_DATE)).alias("change_end_date"),
        F.lit(1).alias("is_current"),
    ).select(*DIM_PRODUCT.fieldNames())
    return with_unknown_member(dim, unknown_product_row(), "product_key")
