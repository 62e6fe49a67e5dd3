"""Bronze -> silver (C1, A1, P9) on literal bronze rows."""

import datetime as dt

from starloom.operators.silver import clean_sales, clean_sales_split, split_dead_letter
from starloom.schemas import BRONZE_BUSINESS_COLUMNS, SILVER


def _bronze(spark, rows):
    full = [{c: r.get(c) for c in BRONZE_BUSINESS_COLUMNS} for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in BRONZE_BUSINESS_COLUMNS) for r in full],
                                 ", ".join(f"{c} string" for c in BRONZE_BUSINESS_COLUMNS))


BASE = {"PRODUCTKEY": "1", "PRODUCT_NAME": "p", "BRAND": "b", "COLOR": "c", "SUBCATEGORY": "s",
        "CATEGORY": "Small", "CUSTOMERKEY": "7", "CUSTOMER_CODE": "C7", "NAME": " n, (x);",
        "EDUCATION": "  ", "OCCUPATION": None, "CONTINENT": "EU", "CITY": "ci", "STATE": "st",
        "COUNTRYREGION": "FR", "ORDERDATE": "2007-01-02", "QUANTITY": "2", "NET_PRICE": "2.5"}


def test_clean_types_and_values(spark):
    out = clean_sales(_bronze(spark, [BASE])).collect()
    assert len(out) == 1
    r = out[0]
    assert r["PRODUCTKEY"] == 1 and r["CUSTOMER_KEY"] == 7
    assert r["NAME"] == "n   x" and r["EDUCATION"] == "Not Provided"
    assert r["OCCUPATION"] == "Not Provided"
    assert r["ORDER_DATE"] == dt.datetime(2007, 1, 2)
    assert r["QUANTITY"] == 2 and r["NET_PRICE"] == 2
    assert r["COUNTRY_REGION"] == "FR"
    silver = clean_sales(_bronze(spark, [BASE]))
    assert [f.name for f in silver.schema.fields] == SILVER.fieldNames()
    assert [f.dataType for f in silver.schema.fields] == [f.dataType for f in SILVER.fields]


def test_duplicates_dropped_nulls_equal(spark):
    rows = [BASE, dict(BASE), dict(BASE, EDUCATION=None), dict(BASE, EDUCATION=None)]
    assert clean_sales(_bronze(spark, rows)).count() == 2


def test_bad_number_only_nulls_its_cell(spark):
    rows = [dict(BASE, QUANTITY="abc"), dict(BASE, PRODUCTKEY="2", QUANTITY="3")]
    got = sorted((r["PRODUCTKEY"], r["QUANTITY"]) for r in clean_sales(_bronze(spark, rows)).collect())
    assert got == [(1, None), (2, 3)]


def test_fractional_quantity_goes_to_rejects(spark):
    rows = [dict(BASE, QUANTITY="1.5"), dict(BASE, PRODUCTKEY="2")]
    good, bad = clean_sales_split(_bronze(spark, rows))
    assert good.count() == 1
    b = bad.collect()
    assert len(b) == 1 and b[0]["reject_reason"] == "fractional_quantity"
    assert b[0]["QUANTITY"] == "1.5"  # raw text kept


def test_dead_letter_non_positive(spark):
    rows = [dict(BASE, QUANTITY="0"), dict(BASE, PRODUCTKEY="2", NET_PRICE="-1"),
            dict(BASE, PRODUCTKEY="3")]
    good, bad = split_dead_letter(_bronze(spark, rows))
    assert good.count() == 1
    assert sorted(r["reject_reason"] for r in bad.collect()) == [
        "non_positive_price", "non_positive_quantity"]


def test_sides_read_together_share_one_deduplication(spark):
    odd = [{}, {}, {"QUANTITY": "1.5"}, {"QUANTITY": "1.5"}, {"QUANTITY": None}, {"QUANTITY": "-2", "NET_PRICE": "0"}, {"NET_PRICE": "0"},
           {"NET_PRICE": "n/a"}, {"NAME": None}, {"NAME": ""}]
    bronze = _bronze(spark, [BASE | o for o in odd])
    one, two = split_dead_letter(bronze), split_dead_letter(bronze, together=True)
    for a, b in zip(one, two):
        a, b = a.drop("TRANSFORMED_DATE"), b.drop("TRANSFORMED_DATE")
        assert a.dtypes == b.dtypes and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert (two[0].count(), two[1].count()) == (5, 3)
    outcomes = two[0].select("NAME").unionByName(two[1].select("reject_reason").withColumnRenamed("reject_reason", "NAME"))
    plan = outcomes._jdf.queryExecution().optimizedPlan().toString()
    assert not any("_raw_" in x or "QUANTITY" in x for x in plan.splitlines() if "Filter" in x), plan  # no side cleans numbers of its own
