"""The warehouse build in dependency order (date -> year; product,
customer, location, date -> sales fact -> aggregate; forecast apart).

``build_warehouse`` writes every layer as a versioned Parquet table and
reads it back, so each later step starts from files (lineage is cut at
every layer and a lost executor only reruns the current step).  Silver is
written once and then feeds three dimensions, the fact and the checks.
"""

from __future__ import annotations

import argparse
import sys
import time
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import dims, facts, incremental, quality, scd2
from starloom.operators.silver import clean_sales_split
from starloom.schemas import (
    DIM_CUSTOMER, DIM_DATE, DIM_LOCATION, DIM_PRODUCT, DIM_YEAR, FACT_ACTUAL_AGG,
    FACT_FORECAST, FACT_SALES, PRIMARY_KEYS, SILVER,
)
from starloom.session import build_session, scratch_scope
from starloom.sources.bronze import normalize_columns, read_sales_json, split_sales_lines, stamp_ingestion
from starloom.sources.forecast import forecast_rows, read_forecast_json, split_forecast_lines
from starloom.sources.tables import TableStore


@dataclass
class BuildResult:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    metrics: DataFrame | None = None


def _timed(metrics: quality.StepMetrics, store: TableStore, name: str, build,
           schema=None) -> DataFrame:
    """Build (``build`` is a thunk: key assignment checkpoints while the
    plan is built), write and read back one table, timing all of it."""
    started = time.time()
    store.spark.sparkContext.setJobDescription(name)
    df = build() if callable(build) else build
    observed, obs = metrics.observed(df, name)
    out = store.write(observed, name, schema)
    metrics.record(name, obs, len(out.columns), started)
    store.spark.sparkContext.setJobDescription(None)
    return out


def build_warehouse(spark: SparkSession, raw_sales: DataFrame, root: str, *,
                    forecast_records: DataFrame | None = None,
                    date_start=dims.REFERENCE_DATE_START, date_end=dims.REFERENCE_DATE_END,
                    previous_product_dim: DataFrame | None = None, effective_date=None,
                    batch: str | None = None, reset: bool = False, date_grain: str = "exact",
                    customer_type1: bool = False, keep_scratch: bool = False) -> BuildResult:
    """Run the full load: raw records -> bronze -> silver -> gold.

    ``previous_product_dim`` switches the product step from the initial
    load (C6) to the SCD2 merge (C7) on ``effective_date``; only the batch
    that this call lands is merged, so a price that falls is seen.  A call
    that is repeated under the same ``batch`` name lands its records once.
    ``tables["checks"]`` holds the checks of the build (see ``build_checks``).
    ``date_grain="day"`` matches orders with a time of day to their day
    (Q9); ``customer_type1=True`` keeps one customer row per code (Q11).
    Staging tables made on the way are deleted at the end unless
    ``keep_scratch``; every returned table lives in the table store.
    """
    with scratch_scope(spark, keep=keep_scratch):
        return _build(spark, raw_sales, root, forecast_records, date_start, date_end,
                      previous_product_dim, effective_date, batch or uuid.uuid4().hex, reset,
                      date_grain, customer_type1)


def _build(spark, raw_sales, root, forecast_records, date_start, date_end,
           previous_product_dim, effective_date, batch, reset, date_grain,
           customer_type1) -> BuildResult:
    store = TableStore(spark, root)
    if reset:
        store.init_layers()
    m = quality.StepMetrics()
    t = {}

    started = time.time()
    bronze_in, obs = m.observed(stamp_ingestion(normalize_columns(raw_sales)), "bronze_sales")
    done = batch in store.batches("bronze_sales")
    t["bronze_sales"] = store.append(bronze_in, "bronze_sales", batch)
    if not done:
        m.record("bronze_sales", obs, len(t["bronze_sales"].columns), started)

    silver, rejects = clean_sales_split(t["bronze_sales"])
    t["silver_sales"] = _timed(m, store, "silver_sales", silver, SILVER)
    t["dead_letter_sales"] = _timed(m, store, "dead_letter_sales", rejects)
    s = t["silver_sales"]

    t["gold_dim_date"] = _timed(m, store, "gold_dim_date",
                                lambda: dims.date_dimension(spark, date_start, date_end),
                                DIM_DATE)
    t["gold_dim_location"] = _timed(m, store, "gold_dim_location",
                                    lambda: dims.location_dimension(s), DIM_LOCATION)
    t["gold_dim_customer"] = _timed(m, store, "gold_dim_customer",
                                    lambda: dims.customer_dimension(s, type1=customer_type1),
                                    DIM_CUSTOMER)
    t["gold_dim_year"] = _timed(m, store, "gold_dim_year",
                                lambda: dims.year_dimension(t["gold_dim_date"]), DIM_YEAR)
    if previous_product_dim is None:
        product = lambda: dims.product_dimension_initial(s)
    else:
        def product():
            landed = clean_sales_split(store.read_batch("bronze_sales", batch))[0]
            return scd2.scd2_merge(previous_product_dim, landed, effective_date)
    t["gold_dim_product"] = _timed(m, store, "gold_dim_product", product, DIM_PRODUCT)

    t["gold_fact_sales"] = _timed(
        m, store, "gold_fact_sales",
        lambda: facts.sales_fact(s, t["gold_dim_product"], t["gold_dim_customer"],
                                 t["gold_dim_location"], t["gold_dim_date"],
                                 date_grain=date_grain), FACT_SALES)
    t["gold_actual_sales_agg_fact"] = _timed(
        m, store, "gold_actual_sales_agg_fact",
        lambda: facts.actual_sales_agg(t["gold_fact_sales"], t["gold_dim_product"],
                                       t["gold_dim_location"], t["gold_dim_date"]),
        FACT_ACTUAL_AGG)
    if forecast_records is not None:
        def forecast():
            fc = forecast_rows(forecast_records)
            quality.assert_unique(fc, ["country_region", "brand", "year"], "gold_forecast")
            return fc
        t["gold_forecast"] = _timed(m, store, "gold_forecast", forecast, FACT_FORECAST)
    t["checks"] = store.write(build_checks(t), "checks")
    metrics = m.to_df(spark)
    store.write(metrics, "run_metrics")
    return BuildResult(tables=t, metrics=metrics)


def build_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Every check of a build as rows (check, table, value, ok): row counts
    (V7, ok is NULL: they inform), duplicate primary keys (A9), NULL years
    (A10), orphan keys (J11) and the reconciliation (V1-V4, of which unknown
    dates inform too)."""
    cols = ["check", "table", "value", "ok"]
    none = F.lit(None).cast("boolean")

    def violations(check: str, table: str, rows: DataFrame) -> DataFrame:
        n = F.count(F.lit(1))
        return rows.agg(n.cast("double").alias("value"), (n == 0).alias("ok")) \
            .select(F.lit(check).alias("check"), F.lit(table).alias("table"), "value", "ok")

    counted = {k: v for k, v in tables.items() if k != "checks"}
    parts = [quality.table_row_counts(counted).select(
        F.lit("rows").alias("check"), F.col("table_name").alias("table"), F.col("row_count").cast("double").alias("value"),
        none.alias("ok"))]
    parts += [violations("duplicate_primary_key", name, quality.duplicate_keys(tables[name], keys))
              for name, keys in PRIMARY_KEYS.items() if name in tables and name != "gold_fact_sales"]
    # the fact's keys are dense: bitmaps of them are exchanged, not the keys
    repeats = incremental.repeated_keys(tables["gold_fact_sales"], PRIMARY_KEYS["gold_fact_sales"][0])
    parts.append(repeats.select(F.lit("duplicate_primary_key").alias("check"), F.lit("gold_fact_sales").alias("table"),
                                F.col("repeats").cast("double").alias("value"), (F.col("repeats") == 0).alias("ok")))
    parts.append(violations("null_year", "gold_dim_year", tables["gold_dim_year"].filter(F.col("YEAR").isNull())))
    fact = tables["gold_fact_sales"]
    orphans = quality.fact_orphans(fact, tables["gold_dim_product"], tables["gold_dim_customer"],
                                   tables["gold_dim_location"], tables["gold_dim_date"])
    parts.append(orphans.select(F.lit("orphans").alias("check"), F.concat(F.lit("gold_fact_sales."), "foreign_key").alias("table"),
                                F.col("orphan_rows").cast("double").alias("value"), (F.col("orphan_rows") == 0).alias("ok")))
    parts.append(quality.reconcile(tables["silver_sales"], fact, tables["gold_actual_sales_agg_fact"]).select(
        "check", F.lit("gold_fact_sales").alias("table"), F.col("right_value").alias("value"),
        F.when(F.col("check") != "unknown_date_rows", F.col("ok")).alias("ok")))
    return reduce(DataFrame.unionByName, [p.select(cols) for p in parts])


def run_pipeline(spark: SparkSession, sales_path: str, forecast_path: str | None, root: str, *,
                 lines: bool = False, names: list[str] | None = None, **options) -> BuildResult:
    """Files to warehouse: sales JSON and forecast JSON in (arrays by default,
    ``lines=True`` for JSON lines), every layer and the checks out.

    JSON lines with ``names`` go through the dead letter: lines that are no
    record of those fields are kept as ``dead_letter_lines`` and
    ``dead_letter_forecast_lines`` and the rest is loaded.  Otherwise a malformed
    record fails the run, as do duplicate forecast keys.  ``options`` are those
    of ``build_warehouse``."""
    store, dead = TableStore(spark, root), {}
    if lines and names is not None:
        sales, dead["dead_letter_lines"] = split_sales_lines(spark, sales_path, names)
    else:
        sales = read_sales_json(spark, sales_path, lines=lines, names=names)
    forecast = None
    if forecast_path is not None:
        if lines:
            forecast, dead["dead_letter_forecast_lines"] = split_forecast_lines(spark, forecast_path)
        else:
            forecast = read_forecast_json(spark, forecast_path, lines=False)
    result = build_warehouse(spark, sales, root, forecast_records=forecast, **options)
    for name, rows in dead.items():
        result.tables[name] = store.write(rows, name)
    return result


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m``-style entry: SALES_JSON FORECAST_JSON ROOT."""
    parser = argparse.ArgumentParser(description=run_pipeline.__doc__)
    parser.add_argument("sales")
    parser.add_argument("forecast")
    parser.add_argument("root")
    parser.add_argument("--lines", action="store_true", help="JSON lines instead of arrays")
    parser.add_argument("--batch", help="name of the batch; a repeated one is landed once")
    args = parser.parse_args(argv)
    spark = build_session()
    result = run_pipeline(spark, args.sales, args.forecast, args.root, lines=args.lines, batch=args.batch)
    failed = result.tables["checks"].filter("not ok")
    if not failed.isEmpty():
        failed.show(truncate=False)
        sys.exit(1)


if __name__ == "__main__":
    main()
