"""Failed writes, malformed input, exact sums, SCD2 edges, the file run."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from starloom.operators import quality, scd2
from starloom.operators.dims import product_dimension_initial
from starloom.operators.keys import fits
from starloom.plans.warehouse import build_warehouse, run_pipeline
from starloom.schemas import SILVER
from starloom.sources.bronze import append_bronze, read_bronze, read_sales_json, split_sales_lines
from starloom.sources.driver_tables import SOURCE_NAMES
from starloom.sources.forecast import read_forecast_json, split_forecast_lines
from starloom.sources.tables import TableStore


def _record(**kw):
    base = dict(zip(SOURCE_NAMES, ["1", "Red thing", "B", "Red", "Sub", "Cat", "7", "C7", "Name", "Edu", "Occ",
                                   "Europe", "City", "State", "Land", "2007-01-02", "2", "10"]))
    return base | kw


def _sales(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in SOURCE_NAMES) for r in rows],
                                 ", ".join(f"`{n}` string" for n in SOURCE_NAMES))


def test_store_survives_failed_writes(spark, tmp_root):
    store = TableStore(spark, tmp_root)
    df = spark.range(3)
    (df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{tmp_root}/t/v000001"))
    assert not store.exists("t")
    store.append(df, "t", "b1")  # not into what the failed write left
    assert store.read("t").count() == 3
    store.append(df, "t", "b1")  # a repeated append
    assert store.read("t").count() == 3 and store.batches("t") == ["b1"]
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{store.current_path('t')}-b2")
    assert store.read("t").count() == 3  # a batch without its marker isn't seen
    store.append(df, "t", "b2")
    assert store.read("t").count() == 6 and store.read_batch("t", "b2").count() == 3
    store.write(spark.range(5), "t")
    store.write(spark.range(6), "t")
    assert store.read("t").count() == 6
    gone = store.expire("t", keep=1)
    assert len(gone) == 5 and store.read("t").count() == 6
    with pytest.raises(ValueError):
        store.append(df, "t", "a/b")


def test_malformed_lines(spark, tmp_path):
    good = [_record(Quantity=str(i)) for i in range(3)]
    lines = [json.dumps(r) for r in good] + ['{"ProductKey": "1", "Prod', "[1, 2]", "", json.dumps(_record(Extra="x"))]
    path = tmp_path / "sales"
    path.mkdir()
    (path / "a.json").write_text("\n".join(lines))
    ok, bad = split_sales_lines(spark, str(path), SOURCE_NAMES)
    assert ok.count() == 3 and ok.filter("PRODUCTKEY is null").count() == 0
    assert sorted(r.reject_reason for r in bad.collect()) == ["malformed_line", "malformed_line", "unknown_field"]
    with pytest.raises(Exception, match="(?i)malformed|corrupt|unreadable|parse"):
        read_sales_json(spark, str(path), names=SOURCE_NAMES).collect()
    (tmp_path / "f.json").write_text('{"countryRegion":"a","brand":"b","year":2000,"forecast":1.5}\n{"country\n'
                                     '{"countryRegion":"a","brand":"b","year":"x","forecast":1}\n')
    ok, bad = split_forecast_lines(spark, str(tmp_path / "f.json"))
    assert ok.count() == 1 and bad.count() == 2
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_forecast_json(spark, str(tmp_path / "f.json")).collect()


def test_csv_keeps_odd_text(spark, tmp_root):
    odd = ["a\nb", "a\r\nb", "", None, '"q"', "a\\", "%0A", "%", "%00", "%2500", " edge ", 'x","y', "é,;"]
    df = _sales(spark, [_record(Name=t, Quantity=str(i)) for i, t in enumerate(odd)])
    df = df.toDF(*[c.replace(" ", "_").replace("-", "_").upper() for c in df.columns])
    append_bronze(df, tmp_root + "/csv", fmt="csv")
    back = {int(r.QUANTITY): r.NAME for r in read_bronze(spark, tmp_root + "/csv", fmt="csv").collect()}
    assert back == dict(enumerate(odd))


def test_sums_beyond_2_to_53_do_not_depend_on_order(spark):
    values = [9007199254740992.0, 1.0, 1.0, 3.0, 9007199254740992.0, 1.0] * 50
    def total(vs, parts):
        df = spark.createDataFrame([(v,) for v in vs], "total_amount double").repartition(parts)
        return df.agg(quality.exact_sum("total_amount").alias("s")).first()["s"]
    assert total(values, 1) == total(values[::-1], 7) == sum(int(v) for v in values)


def _silver(spark, rows):
    cols = {f.name: f.dataType for f in SILVER.fields}
    base = {"PRODUCT_NAME": "p", "COLOR": "red", "BRAND": "b", "SUBCATEGORY": "s", "CATEGORY": "c", "QUANTITY": 1}
    df = spark.range(0, 1, 1, 1)
    out = None
    for r in rows:
        v = base | r
        one = df.select(*[F.lit(v.get(n)).cast(t).alias(n) for n, t in cols.items()])
        out = one if out is None else out.unionByName(one)
    return out


def test_merge_closes_every_unequal_current_version(spark):
    day = dt.datetime(2007, 1, 2)
    two = _silver(spark, [{"PRODUCTKEY": 1, "NET_PRICE": 10, "COLOR": c, "ORDER_DATE": day} for c in ("red", "blue")])
    dim = product_dimension_initial(two)
    src = _silver(spark, [{"PRODUCTKEY": 1, "NET_PRICE": 10, "COLOR": "blue", "ORDER_DATE": dt.datetime(2008, 1, 2)}])
    out = {r.color: r for r in scd2.scd2_merge(dim, src, dt.date(2008, 1, 1)).filter("product_key <> -1").collect()}
    assert out["blue"].is_current == 1 and out["red"].is_current == 0
    assert out["red"].change_end_date == dt.date(2008, 1, 1) and len(out) == 2


def test_merge_never_ends_a_version_before_it_begins(spark):
    dim = product_dimension_initial(_silver(spark, [{"PRODUCTKEY": 1, "NET_PRICE": 10, "ORDER_DATE": dt.datetime(2007, 1, 2)}]))
    src = _silver(spark, [{"PRODUCTKEY": 1, "NET_PRICE": 8, "ORDER_DATE": dt.datetime(2008, 1, 2)}])
    rows = scd2.scd2_merge(dim, src, dt.date(2006, 1, 1)).filter("product_key <> -1").orderBy("product_key").collect()
    assert [(r.unit_price, r.change_begin_date, r.is_current) for r in rows] == [
        (10.0, dt.date(2007, 1, 2), 0), (8.0, dt.date(2007, 1, 2), 1)]
    assert all(r.change_begin_date <= r.change_end_date for r in rows)


def test_second_build_sees_a_price_fall(spark, tmp_root):
    first = build_warehouse(spark, _sales(spark, [_record()]), tmp_root, batch="one")
    dim = first.tables["gold_dim_product"]
    later = _sales(spark, [_record(OrderDate="2008-02-01", **{"Net-Price": "8"})])
    for _ in range(2):  # a repeated call lands its batch once
        second = build_warehouse(spark, later, tmp_root, batch="two", previous_product_dim=dim, effective_date="2008-01-01")
    rows = second.tables["gold_dim_product"].filter("product_key <> -1").orderBy("product_key").collect()
    assert [(r.unit_price, r.is_current) for r in rows] == [(10.0, 0), (8.0, 1)]
    assert second.tables["bronze_sales"].count() == 2
    assert second.tables["checks"].filter("not ok").count() == 0


def test_file_run_with_arrays_and_lines(spark, tmp_path):
    records = [_record(Quantity=str(i + 1)) for i in range(4)]
    (tmp_path / "s.json").write_text(json.dumps(records))
    (tmp_path / "f.json").write_text(json.dumps([{"countryRegion": "Land", "brand": "B", "year": 2007, "forecast": 5}]))
    res = run_pipeline(spark, str(tmp_path / "s.json"), str(tmp_path / "f.json"), str(tmp_path / "w1"))
    assert res.tables["gold_fact_sales"].count() == 4 and res.tables["gold_forecast"].count() == 1
    checks = res.tables["checks"]
    assert checks.filter("not ok").count() == 0
    assert checks.filter("check = 'rows' and table = 'gold_fact_sales'").first()["value"] == 4.0
    (tmp_path / "l.json").write_text("\n".join([*map(json.dumps, records), '{"cut']))
    res = run_pipeline(spark, str(tmp_path / "l.json"), None, str(tmp_path / "w2"), lines=True, names=SOURCE_NAMES)
    assert res.tables["gold_fact_sales"].count() == 4 and res.tables["dead_letter_lines"].count() == 1


def test_size_check_counts_bytes(spark):
    df = spark.range(10).withColumn("t", F.lit("x" * 1000))
    assert fits(df, 10) and not fits(df, 9) and not fits(df, 10, max_bytes=5000)
