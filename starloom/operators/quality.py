"""Reconciliation and integrity checks.

Every check is a DataFrame (usually one row), so checks run on the
cluster and can be written out as a table; nothing is printed or pulled
to the driver except where a caller asks for a boolean.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.keys import broadcast_if_bounded, literal_row


def sales_amount(q: str, p: str) -> Column:
    # in double, as the fact has it: a wild value cannot overflow a long and fail the job
    return F.col(q).cast("double") * F.col(p).cast("double")


def exact_sum(amount) -> Column:
    """Sum of whole amounts as decimal(38, 0): the same in any order, also
    beyond 2^53, where doubles are not.  An amount past 38 digits (a product
    of two longs never is) counts as NULL."""
    return F.try_sum((F.col(amount) if isinstance(amount, str) else amount).try_cast("decimal(38,0)"))


def row_counts(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """V1: silver rows vs fact rows (a difference means fan-out or loss)."""
    s = silver.agg(F.count(F.lit(1)).alias("silver_rows"))
    f = fact.agg(F.count(F.lit(1)).alias("fact_rows"))
    return _side_by_side(s, f)


def amount_totals(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """V2: SUM(QUANTITY * NET_PRICE) in silver vs SUM(total_amount) in the fact."""
    s = silver.agg(exact_sum(sales_amount("QUANTITY", "NET_PRICE")).cast("double").alias("silver_total"))
    f = fact.agg(exact_sum("total_amount").cast("double").alias("fact_total"))
    return _side_by_side(s, f)


def agg_total(agg: DataFrame, fact: DataFrame) -> DataFrame:
    """V3: aggregate-fact total vs transaction-fact total."""
    a = agg.agg(exact_sum("total_actual_sales").cast("double").alias("agg_total"))
    f = fact.agg(exact_sum("total_amount").cast("double").alias("fact_total"))
    return _side_by_side(a, f)


def unknown_date_rows(fact: DataFrame) -> DataFrame:
    """V4 (P8): fact rows whose order date is outside the date dimension."""
    return fact.filter(F.col("date_key") == -1).agg(F.count(F.lit(1)).alias("unknown_date_rows"))


def version_history(dim: DataFrame, product_number=None) -> DataFrame:
    """V6 (A8): versions per product and their prices in key (history)
    order, comma-joined.  The list per product is bounded by the number of
    loads, not by the data size."""
    d = dim.filter(F.col("product_number").isNotNull())
    if product_number is not None:
        d = d.filter(F.col("product_number") == F.lit(product_number))
    hist = F.sort_array(F.collect_list(F.struct("product_key", "unit_price")))
    return d.groupBy("product_number").agg(
        F.count(F.lit(1)).alias("version_count"),
        F.array_join(F.transform(hist, lambda x: x["unit_price"].cast("string")), ",")
        .alias("unit_prices"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """V7: one (table_name, row_count) row per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups that occur more than once.  As in SQL, a row with a
    NULL key part never collides with another row."""
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (df.filter(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))


def assert_unique(df: DataFrame, keys: list[str], what: str = "table") -> None:
    """Raise if ``keys`` is not unique (checks for one offending group)."""
    if not duplicate_keys(df, keys).limit(1).isEmpty():
        raise ValueError(f"{what}: duplicate primary key {keys}")


def null_count(df: DataFrame, column: str) -> DataFrame:
    """A10: rows where a NOT NULL column is NULL."""
    return df.agg(F.count(F.when(F.col(column).isNull(), 1)).alias("null_rows"))


def assert_not_null(df: DataFrame, column: str, what: str = "table") -> None:
    """A10 as a guard: raise if a NOT NULL column holds a NULL."""
    if not df.filter(F.col(column).isNull()).limit(1).isEmpty():
        raise ValueError(f"{what}: NULL in NOT NULL column {column}")


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str) -> DataFrame:
    """Child rows whose foreign key has no parent row (anti-join).
    The parent side is reduced to distinct keys and broadcast when it passes
    the size check, so a hot key on the child side (e.g. -1) never meets a
    shuffle; otherwise AQE splits skewed partitions of the anti-join."""
    keys = broadcast_if_bounded(parent.select(F.col(pk).alias("_pk")).distinct(), 5_000_000)
    # as with a declared foreign key, a NULL reference is not an orphan
    orphans = (child.select(fk).filter(F.col(fk).isNotNull())
               .join(keys, F.col(fk) == F.col("_pk"), "left_anti"))
    return orphans.agg(F.count(F.lit(1)).alias("orphan_rows")).select(
        F.lit(name).alias("foreign_key"), "orphan_rows")


def fact_orphans(fact: DataFrame, product: DataFrame, customer: DataFrame,
                 location: DataFrame, date: DataFrame) -> DataFrame:
    """J11 over the four declared foreign keys of the sales fact: for each, the
    fact's key column is reduced to a count per key map-side, and what finds
    no parent is summed.  (Combinations of the keys are nearly as many as
    the rows; counts of one key are as many as its parents.)"""
    parents = {"product_key": product, "customer_key": customer, "location_key": location, "date_key": date}
    counts = []
    for fk, parent in parents.items():
        rows = fact.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("_n"))
        keys = broadcast_if_bounded(parent.select(F.col(fk).alias("_pk")), 5_000_000)
        counts.append(rows.join(keys, F.col(fk) == F.col("_pk"), "left_anti").agg(
            F.lit(fk).alias("foreign_key"), F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows")))
    return reduce(DataFrame.unionByName, counts)


def year_orphans(agg: DataFrame, forecast: DataFrame, year_dim: DataFrame) -> DataFrame:
    """J11 for the yearly facts: aggregate and forecast years without a row
    in the year dimension."""
    return reduce(DataFrame.unionByName, [
        orphan_rows(agg, "year", year_dim, "YEAR", "gold_actual_sales_agg_fact.year"),
        orphan_rows(forecast, "year", year_dim, "YEAR", "gold_forecast.year"),
    ])


def _side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two single-row, single-column aggregates as one row, without a join:
    each value goes into its own column of a two-row union, and ``max``
    (which skips the other row's NULL) picks it back out."""
    (na,), (nb,) = a.columns, b.columns
    ta, tb = a.schema[na].dataType, b.schema[nb].dataType
    u = a.select(F.col(na).alias("_a"), F.lit(None).cast(tb).alias("_b")).unionByName(
        b.select(F.lit(None).cast(ta).alias("_a"), F.col(nb).alias("_b")))
    return u.agg(F.max("_a").alias(na), F.max("_b").alias(nb))


def reconcile(silver: DataFrame, fact: DataFrame, agg: DataFrame) -> DataFrame:
    """V1-V4 as rows (check, left_value, right_value, ok): one aggregate per
    table, amounts compared as exact decimals."""
    whole = T.DecimalType(38, 0)

    def of(table: str, rows: Column, amount: Column, unknown: Column | None = None) -> list[Column]:
        return [rows.cast(whole).alias(f"{table}_rows"), amount.cast(whole).alias(f"{table}_amount"),
                (F.lit(None) if unknown is None else unknown).cast(whole).alias(f"{table}_unknown")]

    n = F.count(F.lit(1))
    parts = [silver.agg(*of("silver", n, exact_sum(sales_amount("QUANTITY", "NET_PRICE")))),
             fact.agg(*of("fact", n, exact_sum("total_amount"), F.count(F.when(F.col("date_key") == -1, 1)))),
             agg.agg(*of("agg", n, exact_sum("total_actual_sales")))]
    # single rows side by side: each fills its own columns of a union
    one = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    one = one.agg(*[F.max(c).alias(c) for c in one.columns])
    checks = [("silver_vs_fact_rows", F.col("silver_rows"), F.col("fact_rows")),
              ("silver_vs_fact_amount", F.col("silver_amount"), F.col("fact_amount")),
              ("fact_vs_agg_amount", F.col("fact_amount"), F.col("agg_amount")),
              ("unknown_date_rows", F.col("fact_unknown"), F.lit(0).cast(whole))]
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(name).alias("check"), left.cast("double").alias("left_value"),
        right.cast("double").alias("right_value"), left.eqNullSafe(right).alias("ok"))
        for name, left, right in checks])))


class StepMetrics:
    """V8: per-step record count, column count and elapsed seconds, taken
    with ``DataFrame.observe`` while the step's output is written (no extra
    pass over the data)."""

    def __init__(self):
        self.rows: list[tuple] = []

    def observed(self, df: DataFrame, step: str):
        obs = Observation(step)
        return df.observe(obs, F.count(F.lit(1)).alias("records")), obs

    def record(self, step: str, obs: Observation, columns: int, started: float) -> None:
        self.rows.append((step, int(obs.get["records"]), int(columns),
                          float(time.time() - started)))

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The collected metrics as a small DataFrame (literal rows, built
        without a Python worker)."""
        schema = T.StructType([T.StructField("step", T.StringType()),
                               T.StructField("records", T.LongType()),
                               T.StructField("columns", T.IntegerType()),
                               T.StructField("seconds", T.DoubleType())])
        parts = [literal_row(spark, schema, dict(zip(schema.fieldNames(), r))) for r in self.rows]
        if not parts:
            return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                           for f in schema.fields])
        return reduce(DataFrame.unionByName, parts)
