"""Shared intermediates for the registered queries, built lazily from the
driver's tables and memoised per (session, table folder).

Parameters of the raw-sales view and of the two-batch SCD2 scenario are
fixed here so the Spark queries and the SQL oracle use the same ones.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import dims, facts, scd2
from starloom.operators.silver import clean_sales
from starloom.session import CODEC, scratch_path
from starloom.sources.bronze import normalize_columns, stamp_ingestion
from starloom.sources.driver_tables import raw_sales_records, split_by_order_date, table

# Fixed scenario parameters.
DUPLICATE_EVERY = 20           # order keys whose lines arrive twice
RETAIL_PRICE_EVERY = 3         # parts that always sell at list price
FIXTURE_DATE_START = "1996-01-01"   # date dimension narrower than the orders,
FIXTURE_DATE_END = "2000-12-31"     # so both ends fall to date_key -1
BATCH_CUT = "1998-07-01"       # second load = orders from this day on
FORECAST_BEFORE_YEAR = 2001    # forecast exists for earlier years only
FORECAST_FACTOR = 1.1          # forecast = factor * actual
LATE_EVERY, LATE_REST = 10, 3  # customers with key % 10 = 3 are known from the second load on
RELOAD_YEAR = 1997             # order year that is reloaded after all loads

_CACHE: dict[tuple, "Context"] = {}


def context(spark: SparkSession, sf_dir: str) -> "Context":
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = Context(spark, sf_dir.rstrip("/"))
    return _CACHE[key]


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        """Written once to the shared folder and read back: later queries of
        the session share it, and a lost executor takes nothing with it."""
        path = scratch_path(self.spark, name)
        df.write.option("compression", CODEC).parquet(path)
        return self.spark.read.parquet(path)

    # -- raw / bronze / silver ---------------------------------------------
    @cached_property
    def raw_source(self) -> DataFrame:
        """Raw records with source-style names, every value as text."""
        return raw_sales_records(self.spark, self.sf_dir, DUPLICATE_EVERY, RETAIL_PRICE_EVERY)

    @cached_property
    def bronze(self) -> DataFrame:
        return stamp_ingestion(normalize_columns(self.raw_source))

    @cached_property
    def silver(self) -> DataFrame:
        return self._staged(clean_sales(self.bronze), "ctx-silver")

    # -- dimensions ---------------------------------------------------------
    @cached_property
    def date_dim(self) -> DataFrame:
        return dims.date_dimension(self.spark, FIXTURE_DATE_START, FIXTURE_DATE_END)

    @cached_property
    def order_day_range(self) -> tuple[dt.date, dt.date]:
        r = self.table("orders").agg(F.min(F.to_date("o_orderdate")).alias("a"),
                                     F.max(F.to_date("o_orderdate")).alias("b")).first()
        return r["a"], r["b"]

    @cached_property
    def calendar(self) -> DataFrame:
        """Date dimension spanning every order day in the data."""
        a, b = self.order_day_range
        return dims.date_dimension(self.spark, a, b)

    @cached_property
    def location_dim(self) -> DataFrame:
        return dims.location_dimension(self.silver)

    @cached_property
    def customer_dim(self) -> DataFrame:
        return dims.customer_dimension(self.silver)

    @cached_property
    def product_dim(self) -> DataFrame:
        return dims.product_dimension_initial(self.silver)

    # -- facts ----------------------------------------------------------------
    @cached_property
    def fact(self) -> DataFrame:
        return facts.sales_fact(self.silver, self.product_dim, self.customer_dim,
                                self.location_dim, self.date_dim)

    @cached_property
    def ordered_fact(self) -> DataFrame:
        """The fact with its transaction keys in order."""
        return facts.sales_fact(self.silver, self.product_dim, self.customer_dim,
                                self.location_dim, self.date_dim, ordered=True)

    @cached_property
    def agg(self) -> DataFrame:
        return facts.actual_sales_agg(self.fact, self.product_dim, self.location_dim,
                                      self.date_dim)

    @cached_property
    def forecast_records(self) -> DataFrame:
        """Forecast records as the forecasting job would publish them."""
        return self.agg.filter(F.col("year") < FORECAST_BEFORE_YEAR).select(
            F.col("country_region").alias("countryRegion"), "brand", "year",
            (F.col("total_actual_sales") * F.lit(FORECAST_FACTOR)).alias("forecast"))

    # -- two-batch SCD2 scenario ---------------------------------------------
    @cached_property
    def silver_batch1(self) -> DataFrame:
        return self.silver.filter(F.coalesce(F.col("ORDER_DATE") < F.lit(BATCH_CUT).cast("timestamp_ntz"),
                                             F.lit(True)))

    @cached_property
    def silver_batch2(self) -> DataFrame:
        return self.silver.filter(F.col("ORDER_DATE") >= F.lit(BATCH_CUT).cast("timestamp_ntz"))

    @cached_property
    def product_dim_batch1(self) -> DataFrame:
        return dims.product_dimension_initial(self.silver_batch1)

    # -- load by load ----------------------------------------------------------
    @cached_property
    def raw_landed(self) -> DataFrame:
        """The raw records as a landed table: loads and feeds read it, each as
        far as its columns go, instead of joining the tables again."""
        return self._staged(self.raw_source, "ctx-raw")

    def _batches(self) -> tuple[DataFrame, DataFrame]:
        return split_by_order_date(self.raw_landed, BATCH_CUT)

    def _incremental(self, name: str):
        from starloom.plans.incremental import IncrementalWarehouse
        return IncrementalWarehouse(self.spark, scratch_path(self.spark, name), FIXTURE_DATE_START, FIXTURE_DATE_END)

    @cached_property
    def loads(self):
        """Orders before the cut, those from the cut on, everything again
        under a third name, and a year reloaded."""
        w = self._incremental("loads")
        first, second = self._batches()
        w.load(first, "first")
        w.load(second, "second", effective_date=BATCH_CUT)
        w.load(self.raw_landed, "resent", effective_date=self.order_day_range[1])
        w.reload_year(RELOAD_YEAR, "reload")
        return w

    @cached_property
    def late_loads(self):
        """Customers and locations come from a feed of their own, in which some
        arrive with the second load only."""
        w = self._incremental("late-loads")
        first, second = self._batches()
        late = F.col("CustomerKey").cast("long") % LATE_EVERY == LATE_REST
        w.load(first, "first", members=first.filter(~late))
        w.load(second, "second", members=self.raw_landed, effective_date=BATCH_CUT)
        return w

    @cached_property
    def product_dim_merged(self) -> DataFrame:
        return scd2.scd2_merge(self.product_dim_batch1, self.silver_batch2,
                               dt.date.fromisoformat(BATCH_CUT))
