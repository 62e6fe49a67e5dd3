"""Benchmark: the full warehouse build plus the checks, on local[N].

Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.
``value`` is the wall time of the whole run; ``queries`` holds per-step
seconds (each step ends in a Parquet write or a collected check).

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from starloom.operators import quality, scd2  # noqa: E402
from starloom.operators.facts import forecast_vs_actual  # noqa: E402
from starloom.plans.context import (  # noqa: E402
    BATCH_CUT, DUPLICATE_EVERY, FIXTURE_DATE_END, FIXTURE_DATE_START, FORECAST_BEFORE_YEAR,
    FORECAST_FACTOR, RETAIL_PRICE_EVERY,
)
from starloom.plans.warehouse import build_warehouse  # noqa: E402
from starloom.session import build_session, scratch_path  # noqa: E402
from starloom.sources.driver_tables import raw_sales_records  # noqa: E402
from starloom.sources.tables import TableStore  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):  # stage/task timings for tools/stage_times.py
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.compress": "false",
                      "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    if not os.environ.get("SPARK_CONF_DIR") and not _has_checkpoint_default():
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="bench-ckpt-")
    spark = build_session(f"local[{cpus}]", "starloom-bench", shuffle_partitions=cpus * 2,
                          extra=extra)
    root = scratch_path(spark, "bench-warehouse")
    timings: dict[str, float] = {}
    t_all = time.time()
    sc = spark.sparkContext

    raw = raw_sales_records(spark, sf_dir, DUPLICATE_EVERY, RETAIL_PRICE_EVERY)
    forecast = None  # built from the first run's actuals below
    res = build_warehouse(spark, raw, root, date_start=FIXTURE_DATE_START,
                          date_end=FIXTURE_DATE_END)
    for row in res.metrics.collect():
        timings[row["step"]] = round(row["seconds"], 3)
    t = res.tables

    # forecast published from actuals, loaded through JSON lines
    sc.setJobDescription("gold_forecast")
    t0 = time.time()
    path = scratch_path(spark, "bench-forecast")
    (t["gold_actual_sales_agg_fact"].filter(F.col("year") < FORECAST_BEFORE_YEAR)
     .select(F.col("country_region").alias("countryRegion"), "brand", "year",
             (F.col("total_actual_sales") * F.lit(FORECAST_FACTOR)).alias("forecast"))
     .write.json(path))
    from starloom.sources.forecast import forecast_rows, read_forecast_json
    store = TableStore(spark, root)
    forecast = forecast_rows(read_forecast_json(spark, path))
    quality.assert_unique(forecast, ["country_region", "brand", "year"], "gold_forecast")
    forecast = store.write(forecast, "gold_forecast")
    timings["gold_forecast"] = round(time.time() - t0, 3)

    sc.setJobDescription("forecast_vs_actual")
    t0 = time.time()
    forecast_vs_actual(t["gold_actual_sales_agg_fact"], forecast).collect()
    timings["forecast_vs_actual"] = round(time.time() - t0, 3)

    sc.setJobDescription("reconcile")
    t0 = time.time()
    quality.reconcile(t["silver_sales"], t["gold_fact_sales"],
                      t["gold_actual_sales_agg_fact"]).collect()
    quality.fact_orphans(t["gold_fact_sales"], t["gold_dim_product"], t["gold_dim_customer"],
                         t["gold_dim_location"], t["gold_dim_date"]).collect()
    timings["reconcile"] = round(time.time() - t0, 3)

    # second load: SCD2 merge of the later orders into a first-batch dimension
    sc.setJobDescription("scd2_merge")
    t0 = time.time()
    silver = t["silver_sales"]
    cut = F.lit(BATCH_CUT).cast("timestamp_ntz")
    b1 = silver.filter(F.coalesce(F.col("ORDER_DATE") < cut, F.lit(True)))
    b2 = silver.filter(F.col("ORDER_DATE") >= cut)
    from starloom.operators.dims import product_dimension_initial
    dim1 = store.write(product_dimension_initial(b1), "bench_dim_product_b1")
    merged = store.write(scd2.scd2_merge(dim1, b2, dt.date.fromisoformat(BATCH_CUT)),
                         "bench_dim_product_merged")
    timings["scd2_merge"] = round(time.time() - t0, 3)

    sc.setJobDescription("scd2_lookup_and_fanout")
    t0 = time.time()
    scd2.scd2_lookup(silver.select("PRODUCTKEY", "ORDER_DATE"), merged) \
        .groupBy("product_key").count().collect()
    scd2.version_fanout(silver, merged, as_written=False, limit=None).count()
    timings["scd2_lookup_and_fanout"] = round(time.time() - t0, 3)

    total = round(time.time() - t_all, 3)
    print(json.dumps({"metric": "warehouse_build_and_checks", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus}))
    spark.stop()


def _has_checkpoint_default() -> bool:
    import pyspark
    conf = os.path.join(os.path.dirname(pyspark.__file__), "conf", "spark-defaults.conf")
    try:
        return "spark.checkpoint.dir" in open(conf).read()
    except OSError:
        return False


if __name__ == "__main__":
    main()
