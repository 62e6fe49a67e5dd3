"""Plan shapes that the scale design depends on (read from explain())."""

import contextlib
import datetime as dt
import io
import os
import re

from pyspark.sql import functions as F

from starloom.operators import facts, scd2
from starloom.operators.silver import typed
from starloom.schemas import BRONZE_BUSINESS_COLUMNS


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_silver_runs_each_string_function_once(spark):
    bronze = spark.createDataFrame([tuple(["x"] * 18)],
                                   ", ".join(f"{c} string" for c in BRONZE_BUSINESS_COLUMNS))
    plan = _plan(typed(bronze), "simple")
    assert plan.count("translate(") == 14          # 13 text columns + the order date
    assert plan.count("RLIKE(") == 6               # 4 numbers + 2 exact key checks


def test_aggregate_reads_four_columns_and_reduces_before_its_joins(spark, tmp_root):
    fact = spark.createDataFrame(
        [(1, 1, 1, 1, 20070101, 2, 3.0, 6.0)],
        "transaction_key long, product_key long, customer_key long, location_key long, "
        "date_key int, quantity long, net_price double, total_amount double")
    path = os.path.join(tmp_root, "fact")
    fact.write.parquet(path)
    fact = spark.read.parquet(path)
    prod = spark.createDataFrame([(1, "B")], "product_key long, brand string")
    loc = spark.createDataFrame([(1, "FR")], "location_key long, country_region string")
    dd = spark.createDataFrame([(20070101, 2007)], "date_key int, year int")
    plan = _plan(facts.actual_sales_agg(fact, prod, loc, dd))
    assert "ReadSchema: struct<product_key:bigint,location_key:bigint,date_key:int," \
           "total_amount:double>" in plan
    tree = plan.split("\n\n")[0]
    # partial sums by key combination, then by label: no row of the fact is shuffled itself
    assert len(re.findall(r"(?<!Broadcast)Exchange \(\d+\)", tree)) == 2
    assert "SortMergeJoin" not in plan


def test_fact_reads_nine_columns_and_has_no_range_shuffle(spark, tmp_root, monkeypatch):
    from starloom.schemas import SILVER
    path = os.path.join(tmp_root, "silver")
    spark.createDataFrame([], SILVER).write.parquet(path)
    prod = spark.createDataFrame([], "product_key long, product_number long, change_begin_date date, change_end_date date")
    cust = spark.createDataFrame([], "customer_key long, customer_code string")
    loc = spark.createDataFrame([], "location_key long, continent string, country_region string, state string, city string")
    dd = spark.createDataFrame([], "date_key int, date date")
    plans = []
    monkeypatch.setattr(facts, "number_rows", lambda df, key: plans.append(_plan(df)) or df.withColumn(key, F.lit(1)))
    facts.sales_fact(spark.read.parquet(path), prod, cust, loc, dd)
    scan = re.search(r"ReadSchema: struct<(PRODUCTKEY[^>]*)>|ReadSchema: struct<([^>]*NET_PRICE[^>]*)>", plans[0])
    assert len((scan[1] or scan[2]).split(",")) == 9
    assert "rangepartitioning" not in plans[0]


def test_reconcile_reads_each_table_once(spark, tmp_root):
    from starloom.operators import quality
    frames = []
    for name, cols in (("s", "QUANTITY long, NET_PRICE long"), ("f", "date_key int, total_amount double"),
                       ("a", "total_actual_sales double")):
        spark.createDataFrame([], cols).write.parquet(os.path.join(tmp_root, name))
        frames.append(spark.read.parquet(os.path.join(tmp_root, name)))
    plan = _plan(quality.reconcile(*frames)).split("\n\n")[0]
    assert plan.count("Scan parquet") == 3
    assert "PushedFilters: [IsNotNull(date_key), EqualTo(date_key,-1)]" in _plan(quality.unknown_date_rows(frames[1]))


def test_scd2_lookup_is_an_equi_join_with_a_range_residual(spark):
    dim = spark.createDataFrame([(10, 1, dt.date(2007, 1, 1), dt.date(9999, 12, 31))],
                                "product_key long, product_number long, "
                                "change_begin_date date, change_end_date date")
    sales = spark.createDataFrame([(1, dt.datetime(2007, 1, 2))],
                                  "PRODUCTKEY long, ORDER_DATE timestamp_ntz")
    plan = _plan(scd2.scd2_lookup(sales, dim))
    assert "HashJoin LeftOuter" in plan or "SortMergeJoin LeftOuter" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_checks_pair_aggregates_without_a_join(spark):
    from starloom.operators import quality
    a = spark.range(5).selectExpr("id AS QUANTITY", "id AS NET_PRICE")
    f = spark.range(5).selectExpr("CAST(id AS DOUBLE) AS total_amount")
    for df in (quality.row_counts(a, f), quality.amount_totals(a, f)):
        plan = _plan(df, "simple")
        assert "Join" not in plan and "Cartesian" not in plan
    assert tuple(quality.row_counts(a, f).first()) == (5, 5)
