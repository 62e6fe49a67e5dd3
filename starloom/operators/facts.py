"""Facts: sales transactions (C8), actual-sales aggregate (C9), forecast
(C10) and forecast vs actual (C11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import assign_keys, broadcast_if_bounded, number_rows
from starloom.operators.quality import exact_sum
from starloom.operators.scd2 import scd2_lookup, versions_for_lookup
from starloom.schemas import FACT_SALES
from starloom.session import scratch_path

# Dimension rows we are willing to broadcast after a probe of rows and bytes.
BROADCAST_MAX_ROWS = 1_000_000

# Columns of silver that the fact is made of.
SALES_COLUMNS = ["PRODUCTKEY", "CUSTOMER_CODE", "CONTINENT", "COUNTRY_REGION", "CITY", "STATE",
                 "ORDER_DATE", "QUANTITY", "NET_PRICE"]

# Order of the transaction keys where they have one; rows that tie are equal.
FACT_ORDER = ["ORDER_DATE", "product_key", "customer_key", "location_key", "quantity", "net_price"]

FORECAST_KEYS = ["country_region", "brand", "year"]


def look_up_sales(sales: DataFrame, product_dim: DataFrame, customer_dim: DataFrame,
                  location_dim: DataFrame, date_dim: DataFrame, date_grain: str = "exact",
                  broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``sales`` (``SALES_COLUMNS`` and any others) with the four
    keys and the measures of the fact, not numbered yet.

    - product: version valid on the order date (J4), else -1;
    - customer: by customer code (J1; a code with several tuples fans out,
      as in the reference);
    - location: 4-column equality (J2);
    - date: exact equality of the day with the order timestamp (J3; an
      order with a time of day misses), or ``date_grain='day'`` for the day.
    Missing keys become -1 (P5); amount = quantity * price (P4, NULL-safe).
    """
    # the small dimensions first: the shuffles by product and customer then carry
    # a key in place of the four names of a place
    s, c = sales, broadcast_if_bounded(
        customer_dim.filter(F.col("customer_code").isNotNull())
        .select(F.col("customer_key").alias("_c_key"), F.col("customer_code").alias("_c_code")),
        broadcast_max_rows)

    l = broadcast_if_bounded(location_dim.select(
        F.col("location_key").alias("_l_key"), F.col("continent").alias("_l_continent"),
        F.col("country_region").alias("_l_country"), F.col("state").alias("_l_state"),
        F.col("city").alias("_l_city")), broadcast_max_rows)
    s = s.join(l, (s["CONTINENT"] == l["_l_continent"]) & (s["COUNTRY_REGION"] == l["_l_country"])
               & (s["CITY"] == l["_l_city"]) & (s["STATE"] == l["_l_state"]), "left")

    d = broadcast_if_bounded(date_dim.select(F.col("date_key").alias("_d_key"),
                                             F.col("date").alias("_d_date")),
                             broadcast_max_rows)
    lhs = F.to_date("ORDER_DATE") if date_grain == "day" else F.col("ORDER_DATE")
    rhs = F.col("_d_date") if date_grain == "day" else F.col("_d_date").cast("timestamp_ntz")
    # bounded versions go to the lines: these are then not moved by product
    v = broadcast_if_bounded(versions_for_lookup(product_dim), broadcast_max_rows)
    s = scd2_lookup(s.join(d, lhs == rhs, "left"), v)
    s = s.join(c, s["CUSTOMER_CODE"] == c["_c_code"], "left")

    return s.select(
        *sales.columns,
        F.col("product_key").cast("long").alias("product_key"),
        F.coalesce(F.col("_c_key"), F.lit(-1)).cast("long").alias("customer_key"),
        F.coalesce(F.col("_l_key"), F.lit(-1)).cast("long").alias("location_key"),
        F.coalesce(F.col("_d_key"), F.lit(-1)).cast("int").alias("date_key"),
        # in double: exact for whole amounts below 2^53, and a wild value
        # cannot overflow a long and fail the job under ANSI mode
        (F.col("QUANTITY").cast("double") * F.col("NET_PRICE").cast("double"))
        .alias("total_amount"),
    )


def sales_fact(silver: DataFrame, product_dim: DataFrame, customer_dim: DataFrame,
               location_dim: DataFrame, date_dim: DataFrame, date_grain: str = "exact",
               broadcast_max_rows: int = BROADCAST_MAX_ROWS, ordered: bool = False) -> DataFrame:
    """One fact row per silver row (see ``look_up_sales``).  Transaction
    keys are dense and in no particular order, as generated keys are: the
    joined rows are written once, where they lie, and numbered, so the same
    data may get other keys on a cluster of another size.  ``ordered`` numbers
    them by order date, keys, quantity and price instead (one range shuffle)."""
    looked_up = look_up_sales(silver.select(*SALES_COLUMNS), product_dim, customer_dim, location_dim, date_dim,
                              date_grain, broadcast_max_rows)
    unkeyed = looked_up.select(
        *(["ORDER_DATE"] if ordered else []), "product_key", "customer_key", "location_key", "date_key", F.col("QUANTITY").alias("quantity"),
        F.col("NET_PRICE").cast("double").alias("net_price"), "total_amount")
    if ordered:
        path = scratch_path(silver.sparkSession, "fact")
        unkeyed.write.parquet(path)  # joined once: range bounds need a pass
        keyed = assign_keys(silver.sparkSession.read.parquet(path), FACT_ORDER, "transaction_key")
    else:
        keyed = number_rows(unkeyed, "transaction_key")
    return keyed.select(*FACT_SALES.fieldNames())


def sales_sums(fact: DataFrame, product_dim: DataFrame, location_dim: DataFrame, date_dim: DataFrame,
               broadcast_max_rows: int = BROADCAST_MAX_ROWS, by: tuple[str, ...] = ()) -> DataFrame:
    """J9 + A4 as exact decimals: SUM(total_amount) by country, brand, year
    and columns ``by`` of the fact, as ``amount``.  Sums of parts of a fact add
    up to those of the whole.

    The fact is first reduced to (product_key, location_key, year) by a
    map-side partial aggregation, so the joins with the product and location
    dimensions see one row per combination instead of one per transaction.
    Surrogate keys are unique in their dimensions, so this gives the sums of
    the join-then-group SQL."""
    d = broadcast_if_bounded(date_dim.select("date_key", "year"), broadcast_max_rows)
    p = broadcast_if_bounded(product_dim.select("product_key", "brand"), broadcast_max_rows)
    l = broadcast_if_bounded(location_dim.select("location_key", "country_region"), broadcast_max_rows)
    pre = (fact.select("product_key", "location_key", "date_key", "total_amount", *by)
           .join(d, "date_key", "left")
           .groupBy("product_key", "location_key", "year", *by)
           .agg(exact_sum("total_amount").alias("_amount")))
    joined = pre.join(p, "product_key", "left").join(l, "location_key", "left")
    return joined.groupBy("country_region", "brand", "year", *by).agg(exact_sum("_amount").alias("amount"))


def actual_sales_agg(fact: DataFrame, product_dim: DataFrame, location_dim: DataFrame,
                     date_dim: DataFrame,
                     broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """C9 (J9 + A4): SUM(total_amount) by country, brand and year over the
    star join; rows with no date (date_key -1) form the NULL-year group.
    Amounts are summed as decimals, so they are the same in any order."""
    return (sales_sums(fact, product_dim, location_dim, date_dim, broadcast_max_rows)
            .select("country_region", "brand", F.col("year").cast("int").alias("year"),
                    F.col("amount").cast("double").alias("total_actual_sales")))


def forecast_vs_actual(agg: DataFrame, forecast: DataFrame) -> DataFrame:
    """C11: full outer join of actuals and forecast on (country, brand, year)
    with NULL-safe keys, so labels present on one side only still show."""
    a = agg.select(*[F.col(k).alias(f"a_{k}") for k in FORECAST_KEYS], "total_actual_sales")
    f = forecast.select(*[F.col(k).alias(f"f_{k}") for k in FORECAST_KEYS], "forecast")
    cond = None
    for k in FORECAST_KEYS:
        e = F.col(f"a_{k}").eqNullSafe(F.col(f"f_{k}"))
        cond = e if cond is None else cond & e
    j = a.join(f, cond, "full_outer")
    return j.select(
        *[F.coalesce(F.col(f"a_{k}"), F.col(f"f_{k}")).alias(k) for k in FORECAST_KEYS],
        "total_actual_sales", "forecast",
        (F.col("total_actual_sales") - F.col("forecast")).alias("variance"),
        F.try_divide(F.col("total_actual_sales"), F.col("forecast")).alias("attainment"),
    )
