"""Sources and sinks (S1-S11) on small files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from starloom.schemas import BRONZE_BUSINESS_COLUMNS, LAYERS
from starloom.sources.bronze import (
    append_bronze, normalize_columns, normalize_name, read_bronze, read_sales_json,
)
from starloom.sources.forecast import forecast_rows, read_forecast_json
from starloom.sources.tables import TableStore

RECORD = {"ProductKey": 1, "Product Name": "p", "Brand": "b", "Color": "c",
          "Subcategory": "s", "Category": "Small", "CustomerKey": 7, "Customer Code": "C7",
          "Name": "n", "Education": "e", "Occupation": "o", "Continent": "EU", "City": "ci",
          "State": "st", "CountryRegion": "FR", "OrderDate": "2007-01-02", "Quantity": 2,
          "Net-Price": 2.5}


def _write(path, obj):
    with open(path, "w") as f:
        json.dump(obj, f)
    return path


def test_normalize_name():
    assert normalize_name(" Net-Price ") == "NET_PRICE"
    assert normalize_name("Customer Code") == "CUSTOMER_CODE"


def test_json_array_every_value_as_text(spark, tmp_root):
    p = _write(os.path.join(tmp_root, "s.json"), [RECORD, dict(RECORD, Quantity="abc")])
    df = read_sales_json(spark, p, lines=False)
    assert df.columns == BRONZE_BUSINESS_COLUMNS
    assert sorted(r["QUANTITY"] for r in df.collect()) == ["2", "abc"]
    assert df.first()["NET_PRICE"] == "2.5"


def test_json_missing_column_is_null(spark, tmp_root):
    rec = {k: v for k, v in RECORD.items() if k != "Occupation"}
    df = read_sales_json(spark, _write(os.path.join(tmp_root, "m.json"), [rec]), lines=False)
    assert df.first()["OCCUPATION"] is None


@pytest.mark.parametrize("bad", [
    dict(RECORD, Brand={"nested": 1}),          # nested value
    dict(RECORD, Unknown="x"),                   # unknown column
    dict(RECORD, **{"customer code": "dup"}),    # two names normalise alike
])
def test_json_bad_records_rejected(spark, tmp_root, bad):
    p = _write(os.path.join(tmp_root, "bad.json"), [bad])
    with pytest.raises(ValueError):
        read_sales_json(spark, p, lines=False)


def test_normalize_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `A-B` int")
    with pytest.raises(ValueError):
        normalize_columns(df)


def test_csv_round_trip_keeps_text(spark, tmp_root):
    row = {c: f"v{i}" for i, c in enumerate(BRONZE_BUSINESS_COLUMNS)}
    row.update(NAME=" a, (b);", EDUCATION="  ", OCCUPATION=None)
    df = spark.createDataFrame([tuple(row[c] for c in BRONZE_BUSINESS_COLUMNS)],
                               ", ".join(f"{c} string" for c in BRONZE_BUSINESS_COLUMNS))
    path = os.path.join(tmp_root, "bronze_csv")
    append_bronze(df, path, fmt="csv")
    back = read_bronze(spark, path, fmt="csv").first()
    assert back["NAME"] == " a, (b);" and back["EDUCATION"] == "  " and back["OCCUPATION"] is None
    assert back["INGESTION_DATE"] is not None


def test_table_store_versions_and_schema(spark, tmp_root):
    store = TableStore(spark, os.path.join(tmp_root, "wh"))
    tables = store.init_layers()
    assert set(tables) == {n for layer in LAYERS.values() for n in layer}
    assert tables["gold_dim_year"].count() == 0
    loc_schema = LAYERS["gold"]["gold_dim_location"]
    df = spark.createDataFrame([(1, "EU", "FR", "S", "C")],
                               "location_key long, continent string, country_region string, "
                               "state string, city string")
    store.write(df, "gold_dim_location", loc_schema)
    store.write(df.union(df), "gold_dim_location", loc_schema)   # replace, not append
    assert store.read("gold_dim_location").count() == 2
    assert store.current_path("gold_dim_location").endswith("v000003")
    with pytest.raises(ValueError):
        store.write(df.drop("city"), "gold_dim_location", loc_schema)
    store.append(df, "gold_dim_location")
    assert store.read("gold_dim_location").count() == 3
    copy = store.copy("gold_dim_location", "loc_copy")
    assert copy.count() == 3


def test_forecast_json_array(spark, tmp_root):
    p = _write(os.path.join(tmp_root, "f.json"),
               [{"countryRegion": "FR", "brand": "B", "year": 2007, "forecast": 1.5}])
    fc = forecast_rows(read_forecast_json(spark, p, lines=False))
    assert fc.columns == ["country_region", "brand", "forecast", "year"]
    assert tuple(fc.first()) == ("FR", "B", 1.5, 2007)
    assert fc.filter(F.col("year") == 2007).count() == 1


def test_json_with_given_names_skips_inference(spark, tmp_root):
    p = _write(os.path.join(tmp_root, "n.json"), [RECORD])
    df = read_sales_json(spark, p, lines=False, names=list(RECORD))
    assert df.columns == BRONZE_BUSINESS_COLUMNS
    assert df.first()["QUANTITY"] == "2" and df.first()["NET_PRICE"] == "2.5"


def test_load_forecast_rejects_duplicates(spark, tmp_root):
    from starloom.sources.forecast import load_forecast
    rec = {"countryRegion": "FR", "brand": "B", "year": 2007, "forecast": 1.5}
    ok = _write(os.path.join(tmp_root, "ok.json"), [rec])
    assert load_forecast(spark, ok, lines=False).count() == 1
    dup = _write(os.path.join(tmp_root, "dup.json"), [rec, dict(rec, forecast=2.0)])
    with pytest.raises(ValueError):
        load_forecast(spark, dup, lines=False)


def test_a_stored_table_moves_repeated_records_only(spark, tmp_root, monkeypatch):
    from starloom.operators import silver
    from starloom.sources.bronze import stamp_ingestion
    rows = [tuple(v if c == "NAME" else "1" for c in BRONZE_BUSINESS_COLUMNS) for v in ("a", "a", "b", None, None, "")]
    store = TableStore(spark, tmp_root)
    stored = store.write(stamp_ingestion(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in BRONZE_BUSINESS_COLUMNS))), "t")
    moved, drop = [], type(stored).dropDuplicates
    monkeypatch.setattr(type(stored), "dropDuplicates", lambda df, cols: moved.append(df.count()) or drop(df, cols))
    out = silver.drop_exact_duplicates(stored, stored=True)
    assert out.columns == stored.columns and moved == [4]
    assert sorted(str(r.NAME) for r in out.collect()) == ["", "None", "a", "b"]


def test_written_records_are_compressed(spark, tmp_root):
    import glob
    store = TableStore(spark, f"{tmp_root}/store")
    spark.conf.set("spark.sql.parquet.compression.codec", "none")
    try:
        store.write(spark.range(3), "t")
        store.append(spark.range(3), "t", "b")
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")
    files = glob.glob(f"{tmp_root}/store/t/*/part-*")
    assert files and all(".zstd." in f for f in files)


def test_landed_json_is_compressed(spark, monkeypatch):
    import glob

    from starloom.plans import catalog
    from tests.conftest import SF_SMALL
    made, path_of = [], catalog.scratch_path
    monkeypatch.setattr(catalog, "scratch_path", lambda *a: made.append(path_of(*a)) or made[-1])
    for name in ("s13_read_sales_json_array", "s12_stream_ingest_bronze"):
        assert catalog.QUERIES[name](spark, SF_SMALL).count() > 0
    landed = [f for p in made for f in glob.glob(f"{p.removeprefix('file:')}/**/part-*", recursive=True) if not f.endswith(".parquet")]
    assert landed and all(f.endswith((".txt.gz", ".json.gz")) for f in landed)
    assert [f for p in made for f in glob.glob(f"{p.removeprefix('file:')}/**/part-*.zstd.parquet", recursive=True)]
