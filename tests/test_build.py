"""End-to-end build (section 3.1 order) on sf0.001, initial load then an
SCD2 merge load, with the reconciliation checks as assertions."""

import datetime as dt
import os

from pyspark.sql import functions as F

from starloom.operators import dims, facts, quality
from starloom.plans.warehouse import build_warehouse
from starloom.sources.driver_tables import raw_sales_records, split_by_order_date
from tests.conftest import SF_SMALL


def test_build_then_merge(spark, tmp_root):
    raw = raw_sales_records(spark, SF_SMALL)
    first, second = split_by_order_date(raw, "1998-07-01", "OrderDate")
    root = os.path.join(tmp_root, "wh")
    r1 = build_warehouse(spark, first, root, date_start="1995-01-01", date_end="2001-12-31",
                         reset=True)
    t = r1.tables
    checks = {r["check"]: r for r in quality.reconcile(
        t["silver_sales"], t["gold_fact_sales"], t["gold_actual_sales_agg_fact"]).collect()}
    assert checks["silver_vs_fact_rows"]["ok"] and checks["silver_vs_fact_amount"]["ok"]
    assert checks["fact_vs_agg_amount"]["ok"] and checks["unknown_date_rows"]["ok"]
    steps = {r["step"] for r in r1.metrics.collect()}
    assert {"bronze_sales", "silver_sales", "gold_fact_sales"} <= steps

    # second load appends to bronze and merges products on the cut day
    r2 = build_warehouse(spark, second, root, date_start="1995-01-01", date_end="2001-12-31",
                         previous_product_dim=t["gold_dim_product"],
                         effective_date=dt.date(1998, 7, 1))
    t2 = r2.tables
    assert t2["bronze_sales"].count() == raw.count()
    fact = t2["gold_fact_sales"]
    assert fact.count() == t2["silver_sales"].count()
    assert fact.filter(F.col("product_key") == -1).count() == 0
    dim = t2["gold_dim_product"]
    per_key = dim.filter("product_key <> -1").groupBy("product_number").agg(
        F.sum("is_current").alias("cur"))
    assert per_key.filter("cur <> 1").count() == 0
    assert quality.fact_orphans(fact, dim, t2["gold_dim_customer"], t2["gold_dim_location"],
                                t2["gold_dim_date"]).filter("orphan_rows > 0").count() == 0


def test_date_grain_day_and_holidays(spark):
    silver = spark.createDataFrame(
        [(1, "C1", "EU", "FR", "P", "S", dt.datetime(2007, 1, 2, 10, 0), 2, 3)],
        "PRODUCTKEY long, CUSTOMER_CODE string, CONTINENT string, COUNTRY_REGION string, "
        "CITY string, STATE string, ORDER_DATE timestamp_ntz, QUANTITY long, NET_PRICE long")
    prod = spark.createDataFrame([(1, 1, dt.date(2007, 1, 1), dt.date(9999, 12, 31))],
                                 "product_key long, product_number long, "
                                 "change_begin_date date, change_end_date date")
    cust = spark.createDataFrame([(5, "C1")], "customer_key long, customer_code string")
    loc = spark.createDataFrame([(7, "EU", "FR", "S", "P")],
                                "location_key long, continent string, country_region string, "
                                "state string, city string")
    hol = spark.createDataFrame([(dt.date(2007, 1, 2),)], "date date")
    dd = dims.date_dimension(spark, "2007-01-01", "2007-01-03", holidays=hol)
    assert [r["is_holiday"] for r in dd.orderBy("date").collect()] == [0, 1, 0]
    exact = facts.sales_fact(silver, prod, cust, loc, dd).first()
    by_day = facts.sales_fact(silver, prod, cust, loc, dd, date_grain="day").first()
    assert exact["date_key"] == -1 and by_day["date_key"] == 20070102
    assert (by_day["product_key"], by_day["customer_key"], by_day["location_key"]) == (1, 5, 7)
    assert by_day["total_amount"] == 6.0


def test_reloading_the_same_batch_changes_nothing_downstream(spark, tmp_root):
    raw = raw_sales_records(spark, SF_SMALL)
    root = os.path.join(tmp_root, "wh2")
    kw = dict(date_start="1995-01-01", date_end="2001-12-31")
    r1 = build_warehouse(spark, raw, root, **kw)
    silver1 = r1.tables["silver_sales"].count()
    agg1 = {tuple(r) for r in r1.tables["gold_actual_sales_agg_fact"].collect()}
    fc = spark.createDataFrame([("NATION_0", "Brand#1", 1997, 10.0)],
                               "countryRegion string, brand string, year int, forecast double")
    r2 = build_warehouse(spark, raw, root, forecast_records=fc, **kw)  # bronze holds rows twice
    assert r2.tables["bronze_sales"].count() == 2 * raw.count()
    assert r2.tables["silver_sales"].count() == silver1
    assert {tuple(r) for r in r2.tables["gold_actual_sales_agg_fact"].collect()} == agg1
    assert [tuple(r) for r in r2.tables["gold_forecast"].collect()] == [
        ("NATION_0", "Brand#1", 10.0, 1997)]
    assert "gold_forecast" in {r["step"] for r in r2.metrics.collect()}


def test_scratch_scope_removes_staging(spark, tmp_root):
    from starloom.operators.keys import assign_keys
    from starloom.session import scratch_scope
    with scratch_scope(spark) as made:
        out = assign_keys(spark.range(10).toDF("v"), ["v"], "k")
        out.write.parquet(os.path.join(tmp_root, "keyed"))
    assert made and all(not os.path.exists(p.replace("file:", "")) for p in made)
    assert spark.read.parquet(os.path.join(tmp_root, "keyed")).count() == 10
