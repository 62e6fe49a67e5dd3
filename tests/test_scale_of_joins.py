"""Records and facts dealt out by the number of lines: same rows, fewer shuffles."""

import datetime as dt
import re

from pyspark.sql import functions as F

from starloom.operators import facts, incremental, quality, scd2
from starloom.operators.silver import clean_distinct, clean_sales, drop_exact_duplicates
from starloom.schemas import BRONZE_BUSINESS_COLUMNS
from starloom.sources import driver_tables
from starloom.sources.bronze import normalize_columns, stamp_ingestion
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(map(str, df.collect()))


def test_large_tables_give_the_records_of_small_ones(spark, monkeypatch):
    small = _rows(driver_tables.raw_sales_records(spark, SF_SMALL))
    monkeypatch.setattr(driver_tables, "LARGE", 1)
    monkeypatch.setattr(driver_tables, "LINES_PER_TASK", 400)
    raw = driver_tables.raw_sales_records(spark, SF_SMALL)
    assert _rows(raw) == small
    deduplicated = drop_exact_duplicates(stamp_ingestion(normalize_columns(raw)))
    assert deduplicated.count() == len(set(small))
    # tasks in proportion to the lines, and equal records meet without a shuffle of their own
    plan = deduplicated._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_product" in plan and "SortMergeJoin" not in plan
    assert not re.search(r"hashpartitioning\(PRODUCTKEY", plan)
    monkeypatch.setattr(driver_tables, "LINES_PER_TASK", 1)  # every product has more lines than a task holds
    assert _rows(driver_tables.raw_sales_records(spark, SF_SMALL)) == small


def test_ordered_fact_keys(spark):
    silver = spark.createDataFrame(
        [(1, "a", "C", "R", "c", "s", dt.datetime(2007, 1, d) if d else None, q, 5) for d, q in ((3, 1), (2, 9), (2, 4), (None, 7), (3, 1))],
        "PRODUCTKEY long, CUSTOMER_CODE string, CONTINENT string, COUNTRY_REGION string, CITY string, STATE string, "
        "ORDER_DATE timestamp_ntz, QUANTITY long, NET_PRICE long")
    prod = spark.createDataFrame([], "product_key long, product_number long, change_begin_date date, change_end_date date")
    cust = spark.createDataFrame([], "customer_key long, customer_code string")
    loc = spark.createDataFrame([], "location_key long, continent string, country_region string, state string, city string")
    dd = spark.createDataFrame([], "date_key int, date date")
    fact = facts.sales_fact(silver, prod, cust, loc, dd, ordered=True)
    assert [(r.transaction_key, r.quantity) for r in fact.orderBy("transaction_key").collect()] == [(1, 7), (2, 4), (3, 9), (4, 1), (5, 1)]


def test_orphans_are_counted_by_key(spark):
    fact = spark.createDataFrame([(1, 1, 1, 1), (2, 1, None, 1), (2, 3, 1, 1)],
                                 "product_key long, customer_key long, location_key long, date_key int")
    parents = [spark.createDataFrame([(1,), (1,)], f"{k} long") for k in ("product_key", "customer_key", "location_key", "date_key")]
    found = quality.fact_orphans(fact, *parents)
    assert dict(found.collect()) == {"product_key": 2, "customer_key": 1, "location_key": 0, "date_key": 0}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"keys=\[product_key#\d+L, customer_key", plan)  # combinations are as many as the rows


def test_batches_of_seen_and_new_records(spark, monkeypatch):
    cols = ["a", "b"]
    rows = spark.createDataFrame([("1", "x"), ("1", "x"), ("12", None), ("1", "2x"), (None, "n")], "a string, b string")
    old = spark.createDataFrame([("1", "x"), ("1", "n"), (None, "n")], "a string, b string")
    # every hash agrees: only equal records are dropped
    monkeypatch.setattr(incremental, "record_hash", lambda columns: F.lit(7).cast("long"))
    seen = spark.range(1).select(F.lit(7).cast("long").alias("h"), F.lit("one").alias("batch"))
    out = incremental.unseen_records(rows, seen, lambda batches: old, cols)
    assert sorted((r.a, r.b) for r in out.select(*cols).fillna("-").collect()) == [("1", "2x"), ("12", "-")]
    again = incremental.unseen_records(old, seen, lambda batches: old, cols)
    assert again.count() == 0 and again.columns == [*cols, "h"]


def test_a_first_batch_is_not_staged(spark, monkeypatch):
    monkeypatch.setattr(incremental, "stage", lambda *a: (_ for _ in ()).throw(AssertionError("staged")))
    rows = spark.createDataFrame([("1", "x"), ("1", "x")], "a string, b string")
    seen = spark.range(0).select(F.lit(7).cast("long").alias("h"), F.lit("one").alias("batch"))
    assert incremental.unseen_records(rows, seen, lambda batches: None, ["a", "b"]).count() == 1


def test_only_repeated_records_are_moved(spark, monkeypatch):
    rows = spark.createDataFrame([("1", "x"), ("1", "x"), ("12", None), ("1", "2x"), (None, "n"), (None, "n"), ("3", "y")], "a string, b string")
    distinct = {("1", "x"), ("12", None), ("1", "2x"), (None, "n"), ("3", "y")}
    moved = []
    drop = type(rows).dropDuplicates
    monkeypatch.setattr(type(rows), "dropDuplicates", lambda df, cols: moved.append(df.count()) or drop(df, cols))
    out = incremental.unseen_records(rows, spark.range(0).withColumn("h", F.col("id")), lambda batches: None, ["a", "b"])
    assert out.columns == ["a", "b", "h"]
    assert sorted(map(str, out.select("a", "b").collect())) == sorted(str(r) for r in rows.distinct().collect())
    assert out.count() == len(distinct) and moved == [4]
    # records of one hash are told apart by what they hold
    monkeypatch.setattr(incremental, "record_hash", lambda columns: F.lit(-7).cast("long"))
    assert {(r.a, r.b) for r in incremental.distinct_records(rows, ["a", "b"]).collect()} == distinct


def test_bounded_versions_do_not_move_the_lines(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales = spark.createDataFrame([(7, "a", "C", "R", "c", "s", dt.datetime(2007, 1, 3), 2, 5), (8, "a", "C", "R", "c", "s", dt.datetime(2006, 1, 3), 1, 1)],
                                      "PRODUCTKEY long, CUSTOMER_CODE string, CONTINENT string, COUNTRY_REGION string, CITY string, STATE string, "
                                      "ORDER_DATE timestamp_ntz, QUANTITY long, NET_PRICE long")
        day = dt.date(2007, 1, 1)
        prod = spark.createDataFrame([(1, 7, day, dt.date(9999, 12, 31)), (2, 8, day, dt.date(9999, 12, 31))],
                                     "product_key long, product_number long, change_begin_date date, change_end_date date")
        cust = spark.createDataFrame([(4, "a")], "customer_key long, customer_code string")
        loc = spark.createDataFrame([(5, "C", "R", "s", "c")], "location_key long, continent string, country_region string, state string, city string")
        dd = spark.createDataFrame([(20070103, dt.date(2007, 1, 3))], "date_key int, date date")
        found = facts.look_up_sales(sales, prod, cust, loc, dd)
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert {(r.PRODUCTKEY, r.product_key, r.customer_key, r.location_key, r.date_key) for r in found.collect()} == {(7, 1, 4, 5, 20070103), (8, -1, 4, 5, -1)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_members_are_cleaned_once_a_tuple(spark):
    records = spark.createDataFrame(
        [(str(i % 2 + 1), " a, " if i % 3 else None, q) for i in range(12) for q in ("1", "2.0", None)] + [("9", "z", "1.5"), ("8", "y", "x")],
        "CUSTOMERKEY string, NAME string, QUANTITY string")
    for c in BRONZE_BUSINESS_COLUMNS:
        if c not in records.columns:
            records = records.withColumn(c, F.lit("1"))
    whole = clean_sales(records, dedup=False).select("CUSTOMER_KEY", "NAME", "CONTINENT").distinct()
    found = clean_distinct(records, ["CUSTOMER_KEY", "NAME", "CONTINENT"])
    assert _rows(found) == _rows(whole) and found.count() == 5
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[CUSTOMERKEY#\d+, NAME#\d+", plan)  # text is made distinct, then cleaned


def _plans(monkeypatch):
    """Executed plans of the rows that ``DataFrame.first`` fetches."""
    from pyspark.sql import DataFrame
    seen, first = [], DataFrame.first

    def noted(df):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return first(df)
    # the class of the session's frames has its own method
    for cls in DataFrame.__subclasses__():
        if "first" in vars(cls):
            monkeypatch.setattr(cls, "first", lambda df, _f=vars(cls)["first"]: seen.append(df._jdf.queryExecution().executedPlan().toString()) or _f(df))
    monkeypatch.setattr(DataFrame, "first", noted)
    return seen


def test_lines_are_counted_where_they_are_stored_and_places_come_last(spark, monkeypatch):
    monkeypatch.setattr(driver_tables, "LARGE", 1)
    monkeypatch.setattr(driver_tables, "LINES_PER_TASK", 400)
    seen = _plans(monkeypatch)
    raw = driver_tables.raw_sales_records(spark, SF_SMALL)
    counted = [p for p in seen if "l_partkey" in p]
    assert counted and not any("hashpartitioning(l_orderkey" in p for p in counted)
    # names of nation and region are joined above the shuffle by product
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert plan.index("n_name") < plan.index("hashpartitioning(_product")
    below = plan[plan.index("hashpartitioning(_product"):plan.index("hashpartitioning(_part")]
    assert "n_name" not in below and "r_name" not in below


def test_digests_alone_meet_the_past(spark, monkeypatch):
    staged, stage = {}, incremental.stage
    monkeypatch.setattr(incremental, "stage", lambda df, name: staged.setdefault(name, df) and stage(df, name))
    old = spark.createDataFrame([("1", "x"), (None, "n")], "a string, b string")
    rows = old.unionByName(spark.createDataFrame([("2", "x"), ("2", "x"), ("1", None)], "a string, b string"))
    seen = old.select(incremental.record_hash(["a", "b"]).alias("h"), F.lit("one").alias("batch"))
    out = incremental.unseen_records(rows, seen, lambda batches: old, ["a", "b"])
    assert sorted((r.a, r.b or "-") for r in out.select("a", "b").collect()) == [("1", "-"), ("2", "x")]
    assert out.columns == ["a", "b", "h"] and staged["unseen"].columns == ["_d"]


def test_fanout_is_dealt_by_the_number_of_lines(spark, monkeypatch):
    day, end = dt.date(2007, 1, 1), dt.date(9999, 12, 31)
    silver = spark.createDataFrame([(p, dt.datetime(2007, 1, d)) for p in (1, 2, 3, None) for d in (1, 2, 2)], "PRODUCTKEY long, ORDER_DATE timestamp_ntz")
    dim = spark.createDataFrame([(1, 1, day, end), (2, 1, day, end), (3, 2, day, end)],
                                "product_key long, product_number long, change_begin_date date, change_end_date date")
    small = [_rows(scd2.version_fanout(silver, dim, as_written, None)) for as_written in (True, False)]
    monkeypatch.setattr(scd2, "DAYS_PER_TASK", 3)
    dealt = [scd2.version_fanout(silver, dim, as_written, None) for as_written in (True, False)]
    assert [_rows(df) for df in dealt] == small and [len(x) for x in small] == [3, 2]
    assert all("REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString() for df in dealt)


def test_versions_cut_into_many_bins_are_not_broadcast(spark):
    sales = spark.createDataFrame([(p, dt.datetime(y, 1, 3)) for p in (1, 2, None) for y in (1990, 2010)], "PRODUCTKEY long, ORDER_DATE timestamp_ntz")
    day = dt.date(2000, 1, 1)
    dim = spark.createDataFrame([(1, 1, dt.date(1900, 1, 1), day), (2, 1, day, dt.date(9999, 12, 31)), (3, 2, day, dt.date(9999, 12, 31))],
                                "product_key long, product_number long, change_begin_date date, change_end_date date")
    for how in ("left", "inner"):
        few, many = (incremental.binned_lookup(sales, dim, how=how, bin_days=30, broadcast_max_rows=n) for n in (1000, 100))
        assert _rows(few) == _rows(many) == _rows(scd2.scd2_lookup(sales, dim, how=how))
        assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
        # three versions make some 500 rows: the planner, which sees three, must not send them through the driver
        assert "Broadcast" not in many._jdf.queryExecution().executedPlan().toString()
