"""Product SCD2 (C6, C7, J4, J5, V5) and facts (C8-C11) on literal rows."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators import dims, facts, quality, scd2

COLS = ("PRODUCTKEY long, PRODUCT_NAME string, COLOR string, BRAND string, SUBCATEGORY string, "
        "CATEGORY string, NET_PRICE long, ORDER_DATE timestamp_ntz")


def ts(d):
    return dt.datetime.fromisoformat(d)


def batch_a(spark):
    return spark.createDataFrame([
        (1, "p1", "red", "B", "S", "Small", 10, ts("2007-01-01")),
        (1, "p1", "red", "B", "S", "Small", 12, ts("2007-01-05")),   # one key, two prices
        (2, "p2", "blue", "B", "S", "Small", 5, ts("2007-01-02")),
        (3, "p3", "red", "B", "S", "Small", None, ts("2007-01-03")),  # NULL price
        (None, "px", "red", "B", "S", "Small", 9, ts("2007-01-03")),  # NULL key
        (6, "p6", "red", "B", "S", "Small", 1, ts("2007-01-03")),    # absent later
    ], COLS)


def batch_b(spark):
    return spark.createDataFrame([
        (1, "p1", "red", "B", "S", "Small", 11, ts("2007-02-01")),
        (1, "p1", "red", "B", "S", "Small", 12, ts("2007-02-02")),   # unchanged (max 12)
        (2, "p2", "blue", "B", "S", "Small", 6, ts("2007-02-01")),   # price change
        (3, "p3", "red", "B", "S", "Small", 7, ts("2007-02-01")),    # NULL -> 7 is a change
        (4, "p4", "red", "B", "S", "Small", 3, ts("2007-02-03")),    # new key
        (None, "px", "red", "B", "S", "Small", 9, ts("2007-02-03")),
    ], COLS)


EFF = dt.date(2007, 2, 1)


def test_initial_load(spark):
    d = dims.product_dimension_initial(batch_a(spark))
    rows = {r["product_number"]: r for r in d.collect()}
    assert set(rows) == {None, 1, 2, 3, 6}
    assert rows[1]["unit_price"] == 12.0 and rows[1]["change_begin_date"] == dt.date(2007, 1, 1)
    assert rows[None]["product_key"] == -1
    assert sorted(r["product_key"] for r in rows.values()) == [-1, 1, 2, 3, 4]


def test_merge_semantics_and_invariants(spark):
    d1 = dims.product_dimension_initial(batch_a(spark))
    merged = scd2.scd2_merge(d1, batch_b(spark), EFF)
    rows = merged.collect()
    by = {}
    for r in rows:
        by.setdefault(r["product_number"], []).append(r)
    # unchanged and absent keys keep one open version
    assert len(by[1]) == 1 and by[1][0]["is_current"] == 1
    assert len(by[6]) == 1 and by[6][0]["is_current"] == 1
    # changed keys: old closed on the effective date, new opens there
    for k in (2, 3):
        old = [r for r in by[k] if r["is_current"] == 0]
        new = [r for r in by[k] if r["is_current"] == 1]
        assert len(old) == 1 and len(new) == 1
        assert old[0]["change_end_date"] == EFF and new[0]["change_begin_date"] == EFF
    # new key begins at the batch's first order day
    assert by[4][0]["change_begin_date"] == dt.date(2007, 2, 1)
    # old keys never change, new keys continue after the maximum
    old_keys = {r["product_key"]: r["product_number"] for r in d1.collect()}
    assert all(old_keys[r["product_key"]] == r["product_number"]
               for r in rows if r["product_key"] in old_keys)
    assert sorted(r["product_key"] for r in rows if r["product_key"] not in old_keys) == [5, 6, 7]
    # one current version per key, intervals do not overlap
    for k, vs in by.items():
        if k is None:
            continue
        assert sum(v["is_current"] for v in vs) == 1
        spans = sorted((v["change_begin_date"], v["change_end_date"]) for v in vs)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_merge_is_idempotent(spark):
    d1 = dims.product_dimension_initial(batch_a(spark))
    m1 = scd2.scd2_merge(d1, batch_b(spark), EFF)
    m1 = spark.createDataFrame(m1.collect(), m1.schema)
    m2 = scd2.scd2_merge(m1, batch_b(spark), EFF)
    assert sorted(map(tuple, m1.collect()), key=str) == sorted(map(tuple, m2.collect()), key=str)


def test_validity_is_half_open(spark):
    dim = spark.createDataFrame(
        [(10, 1, dt.date(2007, 1, 1), dt.date(2007, 1, 10)),
         (11, 1, dt.date(2007, 1, 10), dt.date(9999, 12, 31))],
        "product_key long, product_number long, change_begin_date date, change_end_date date")
    sales = spark.createDataFrame([
        (1, ts("2007-01-01")), (1, ts("2007-01-09")), (1, ts("2007-01-10")),
        (1, ts("2006-12-31")), (1, None), (None, ts("2007-01-02"))],
        "PRODUCTKEY long, ORDER_DATE timestamp_ntz")
    got = [r["product_key"] for r in
           scd2.scd2_lookup(sales, dim).orderBy(F.col("ORDER_DATE").asc_nulls_last(),
                                                "PRODUCTKEY").collect()]
    # 2006-12-31 -> -1, begin day -> 10, day before end -> 10, (NULL key) -> -1,
    # end day -> 11, NULL date -> -1
    assert got == [-1, 10, -1, 10, 11, -1]


def test_fanout_check_as_written_and_distinct(spark):
    dim = spark.createDataFrame(
        [(10, 1, dt.date(2007, 1, 1), dt.date(9999, 12, 31)),
         (20, 2, dt.date(2007, 1, 1), dt.date(9999, 12, 31)),
         (21, 2, dt.date(2007, 1, 1), dt.date(9999, 12, 31))],
        "product_key long, product_number long, change_begin_date date, change_end_date date")
    silver = spark.createDataFrame([(1, ts("2007-01-02")), (1, ts("2007-01-02")),
                                    (2, ts("2007-01-03"))], "PRODUCTKEY long, ORDER_DATE timestamp_ntz")
    written = {r["PRODUCTKEY"] for r in scd2.version_fanout(silver, dim, as_written=True).collect()}
    distinct = {r["PRODUCTKEY"] for r in
                scd2.version_fanout(silver, dim, as_written=False, limit=None).collect()}
    assert written == {1, 2} and distinct == {2}


def test_forecast_duplicate_key_fails(spark):
    fc = spark.createDataFrame([("FR", "B", 2007, 1.0), ("FR", "B", 2007, 2.0),
                                (None, "B", 2007, 3.0), (None, "B", 2007, 4.0)],
                               "country_region string, brand string, year int, forecast double")
    assert quality.duplicate_keys(fc, ["country_region", "brand", "year"]).count() == 1
    try:
        quality.assert_unique(fc, ["country_region", "brand", "year"])
    except ValueError:
        return
    raise AssertionError("duplicate forecast key must fail")


def test_forecast_vs_actual_full_outer(spark):
    agg = spark.createDataFrame([("FR", "B", 2007, 100.0), ("FR", "B", None, 5.0)],
                                "country_region string, brand string, year int, total_actual_sales double")
    fc = spark.createDataFrame([("FR", "B", 2007, 80.0), ("F.R", "B", 2007, 1.0)],
                               "country_region string, brand string, year int, forecast double")
    rows = {(r["country_region"], r["year"]): r for r in facts.forecast_vs_actual(agg, fc).collect()}
    assert rows[("FR", 2007)]["variance"] == 20.0 and rows[("FR", 2007)]["attainment"] == 1.25
    assert rows[("F.R", 2007)]["total_actual_sales"] is None
    assert rows[("FR", None)]["forecast"] is None


def test_agg_forms_agree(spark):
    fact = spark.createDataFrame(
        [(1, 1, 20070101, 10.0), (1, 1, 20070102, 5.0), (2, 1, -1, 7.0), (-1, 2, 20070101, None)],
        "product_key long, location_key long, date_key int, total_amount double")
    prod = spark.createDataFrame([(1, "B1"), (2, "B2"), (-1, None)], "product_key long, brand string")
    loc = spark.createDataFrame([(1, "FR"), (2, "JP")], "location_key long, country_region string")
    dd = spark.createDataFrame([(20070101, 2007), (20070102, 2007)], "date_key int, year int")
    big = facts.actual_sales_agg(fact, prod, loc, dd, broadcast_max_rows=1)
    small = facts.actual_sales_agg(fact, prod, loc, dd)
    want = {("FR", "B1", 2007, 15.0), ("FR", "B2", None, 7.0), ("JP", None, 2007, None)}
    assert {tuple(r) for r in big.collect()} == want == {tuple(r) for r in small.collect()}


def test_amount_does_not_overflow(spark):
    silver = spark.createDataFrame(
        [(1, "C1", "EU", "FR", "P", "S", dt.datetime(2007, 1, 2), 2**40, 2**40)],
        "PRODUCTKEY long, CUSTOMER_CODE string, CONTINENT string, COUNTRY_REGION string, "
        "CITY string, STATE string, ORDER_DATE timestamp_ntz, QUANTITY long, NET_PRICE long")
    prod = spark.createDataFrame([(1, 1, dt.date(2007, 1, 1), dt.date(9999, 12, 31))],
                                 "product_key long, product_number long, "
                                 "change_begin_date date, change_end_date date")
    cust = spark.createDataFrame([(5, "C1")], "customer_key long, customer_code string")
    loc = spark.createDataFrame([(7, "EU", "FR", "S", "P")],
                                "location_key long, continent string, country_region string, "
                                "state string, city string")
    dd = dims.date_dimension(spark, "2007-01-01", "2007-01-03")
    row = facts.sales_fact(silver, prod, cust, loc, dd).first()
    assert row["total_amount"] == float(2**80)


def test_random_merges_keep_invariants(spark):
    import random
    rnd = random.Random(11)
    dim = None
    seen_keys = {}
    for load in range(3):
        eff = dt.date(2008 + load, 1, 1)
        rows = []
        for _ in range(60):
            pn = rnd.choice([None, *range(12)])
            # the first load keeps every attribute set of a product as a current
            # version (as the reference does), so it gets one set per product;
            # later loads may send several and the merge keeps the latest
            color = ["red", "blue", None][pn % 3 if pn is not None else 0] if load == 0 \
                else rnd.choice(["red", "blue", None])
            rows.append((pn, f"p{pn}", color, "B", "S", "Small",
                         rnd.choice([None, 1, 2, 3]),
                         dt.datetime(2007 + load, rnd.randint(1, 12), rnd.randint(1, 28))))
        batch = spark.createDataFrame(rows, COLS)
        dim = (dims.product_dimension_initial(batch) if dim is None
               else scd2.scd2_merge(dim, batch, eff))
        dim = spark.createDataFrame(dim.collect(), dim.schema)   # cut lineage for the test
        out = dim.collect()
        # surrogate keys unique and stable across loads
        keys = [r["product_key"] for r in out]
        assert len(keys) == len(set(keys))
        for r in out:
            if r["product_key"] in seen_keys:
                assert seen_keys[r["product_key"]] == r["product_number"]
            seen_keys[r["product_key"]] = r["product_number"]
        # after a merge: one current version per product and no overlapping validity
        if load:
            by = {}
            for r in out:
                if r["product_number"] is not None:
                    by.setdefault(r["product_number"], []).append(r)
            for vs in by.values():
                assert sum(v["is_current"] for v in vs) == 1
                spans = sorted((v["change_begin_date"], v["change_end_date"]) for v in vs)
                assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
            again = scd2.scd2_merge(dim, batch, eff).collect()
            assert sorted(map(tuple, again), key=str) == sorted(map(tuple, out), key=str)


def test_generic_merge_on_another_dimension(spark):
    dim = spark.createDataFrame(
        [(1, "C1", "retail", dt.date(2007, 1, 1), dt.date(9999, 12, 31), 1),
         (2, "C2", "bank", dt.date(2007, 1, 1), dt.date(9999, 12, 31), 1)],
        "sk long, code string, segment string, change_begin_date date, "
        "change_end_date date, is_current int")
    src = spark.createDataFrame([("C1", "retail"), ("C2", "insurance"), ("C3", "bank")],
                                "code string, segment string")
    out = scd2.scd2_merge_versions(dim, src, dt.date(2008, 1, 1), dt.date(2007, 6, 1),
                                   key="code", values=["segment"], surrogate="sk").collect()
    got = sorted((r["sk"], r["code"], r["segment"], r["is_current"], str(r["change_begin_date"]),
                  str(r["change_end_date"])) for r in out)
    assert got == [(1, "C1", "retail", 1, "2007-01-01", "9999-12-31"),
                   (2, "C2", "bank", 0, "2007-01-01", "2008-01-01"),
                   (3, "C2", "insurance", 1, "2008-01-01", "9999-12-31"),
                   (4, "C3", "bank", 1, "2007-06-01", "9999-12-31")]
