"""The load-by-load warehouse on small literal loads, and its operators."""

import datetime as dt
import glob
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from starloom.operators import dims, incremental, quality, scd2
from starloom.operators.facts import actual_sales_agg, sales_fact
from starloom.operators.keys import number_rows
from starloom.operators.silver import clean_sales
from starloom.plans.incremental import IncrementalWarehouse
from starloom.schemas import BRONZE_BUSINESS_COLUMNS, DIM_PRODUCT, FACT_SALES, PRIMARY_KEYS
from starloom.sources.partitioned import PartitionedTable

RAW = ", ".join(f"{c} string" for c in BRONZE_BUSINESS_COLUMNS)


def _sale(product, customer, country, day, quantity=1, price=10, color="red"):
    return (str(product), f"P{product}", "B", color, "S", "C", str(customer), f"C{customer}", f"N{customer}", "E", "O", "K", f"{country}-city",
            f"{country}-state", country, day, str(quantity), str(price))


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def _dim(df, key):
    return {r[key]: tuple(r) for r in df.collect()}


ONE = [_sale(1, 5, "M", "2007-01-05", 2), _sale(2, 7, "T", "2007-02-05", 3, 20), _sale(1, 5, "M", "2008-03-01", 1)]
TWO = [_sale(1, 3, "A", "2008-06-01", 4, 12), _sale(3, 5, "T", "2008-07-01", 1, 7), _sale(2, 7, "T", "2008-07-02", 5, 20)]
THREE = [_sale(3, 1, "B", "2009-01-01", 2, 7), _sale(4, 9, "Z", "2009-01-02", 2, 7)]


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """The loads are tiny: many small tasks would only take time."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def house(spark, tmp_root):
    return IncrementalWarehouse(spark, os.path.join(tmp_root, "inc"), product_buckets=8)


@pytest.fixture(scope="module")
def three(spark, tmp_path_factory):
    """Three loads, with what each left behind."""
    house = IncrementalWarehouse(spark, str(tmp_path_factory.mktemp("three")), product_buckets=8)
    states = []
    for name, rows, day in (("one", ONE + ONE[:1], None), ("two", TWO, "2008-06-01"), ("three", THREE, "2009-01-01")):
        assert house.load(_raw(spark, rows), name, effective_date=day)
        states.append({"locations": _dim(house.location_dim(), "location_key"), "customers": _dim(house.customer_dim(), "customer_key"),
                       "fact": _dim(house.fact_sales(), "transaction_key"), "files": _files(house, "facts") | _files(house, "products")})
    return house, states


def _files(house, table):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{getattr(house, table).path}/**/part-*", recursive=True)}


def test_three_loads_keep_keys_and_rewrite_nothing(spark, three):
    house, states = three
    locations, customers, fact = (states[0][k] for k in ("locations", "customers", "fact"))
    assert set(locations) == {-1, 1, 2} and locations[1][2] == "M" and set(customers) == {-1, 1, 2} and set(fact) == {1, 2, 3}
    assert not house.load(_raw(spark, TWO), "one")  # a name is loaded once
    # new members sort ahead of old ones, and come after them
    now = states[2]["locations"]
    assert {k: now[k] for k in locations} == locations and [now[k][2] for k in (3, 4, 5)] == ["A", "B", "Z"]
    now = states[2]["customers"]
    assert {k: now[k] for k in customers} == customers and [now[k][1] for k in (3, 4, 5)] == [3, 1, 9]
    now = states[2]["fact"]
    assert {k: now[k] for k in fact} == fact and set(now) == set(range(1, 9))
    # nothing that an earlier load wrote is touched
    for early, late in zip(states, states[1:]):
        assert early["files"].items() <= late["files"].items()
    assert house.reconcile().filter("not ok").count() == 0 and house.repeated_keys().first()[0] == 0


def test_loads_equal_one_build(spark, three):
    """Facts of several loads are those of one, but for their keys; so are
    the sums."""
    house, _ = three
    whole = sales_fact(house.silver_sales(), house.product_dim(), house.customer_dim(), house.location_dim(), house.date_dim())
    cols = [c for c in FACT_SALES.fieldNames() if c != "transaction_key"]
    assert sorted(house.fact_sales().select(*cols).collect()) == sorted(whole.select(*cols).collect())
    agg = actual_sales_agg(whole, house.product_dim(), house.location_dim(), house.date_dim())
    assert sorted(house.sales_agg().collect(), key=str) == sorted(agg.collect(), key=str)
    assert quality.fact_orphans(house.fact_sales(), house.product_dim(), house.customer_dim(), house.location_dim(), house.date_dim()) \
        .filter("orphan_rows > 0").count() == 0


def test_a_failed_load_shows_nothing_and_can_be_tried_again(spark, house, monkeypatch):
    house.load(_raw(spark, ONE), "one")
    before = sorted(house.fact_sales().collect())
    commit = house._commit
    monkeypatch.setattr(house, "_commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        house.load(_raw(spark, TWO), "two", effective_date="2008-06-01")
    assert sorted(house.fact_sales().collect()) == before and house.location_dim().count() == 3 and len(house.loads()) == 1
    assert house.product_dim().filter("is_current = 0").count() == 0
    monkeypatch.setattr(house, "_commit", commit)
    assert house.load(_raw(spark, TWO), "two", effective_date="2008-06-01")
    assert house.fact_sales().count() == 6 and house.silver_sales().count() == 6 and house.reconcile().filter("not ok").count() == 0


def test_resent_records_add_nothing(spark, house):
    house.load(_raw(spark, ONE), "one")
    fresh = _sale(1, 5, "M", "2007-01-05", 2, 11)  # differs in its price alone
    null = list(ONE[0])
    null[4] = None
    house.load(_raw(spark, [*ONE, fresh, tuple(null), tuple(null)]), "again", effective_date="2008-06-01")
    assert house.silver_sales().count() == 5 and house.bronze.read(["again"]).count() == 2
    house.load(_raw(spark, [*ONE, tuple(null)]), "third", effective_date="2008-07-01")
    assert house.bronze.read(["third"]).count() == 0 and house.fact_sales().count() == 5
    assert len(house.loads()) == 3 and house.reconcile().filter("not ok").count() == 0


def test_new_records_read_no_past_batch(spark, three):
    asked = []
    records = _raw(spark, [_sale(9, 9, "N", "2010-01-01"), _sale(9, 9, "N", "2010-01-01")])
    out = incremental.unseen_records(records, three[0].seen.read(), lambda batches: asked.append(batches))
    assert out.count() == 1 and asked == []


def test_a_batch_of_seen_and_new_records_moves_the_new_ones(spark, house):
    assert house.load(_raw(spark, ONE), "one")
    assert house.load(_raw(spark, ONE + TWO + TWO), "two", effective_date="2008-06-01")
    assert sorted(tuple(r)[:len(BRONZE_BUSINESS_COLUMNS)] for r in house.bronze.read(["two"]).select(*BRONZE_BUSINESS_COLUMNS).collect()) == sorted(TWO)


def test_a_digest_is_made_once(spark):
    rows = _raw(spark, ONE).select(incremental.record_digest().alias("d"), "NAME")
    other = rows.select("d").hint("merge")
    plan = rows.join(other, "d", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sha2(") == 2  # once a side, and no more for a test for NULL


def test_settled_lines_are_staged_without_names(spark, house, monkeypatch):
    from starloom.plans import incremental as plan
    staged = []
    monkeypatch.setattr(plan, "number_rows", lambda df, *a: staged.append(df) or number_rows(df, *a))
    late = _sale(1, 8, "M", "2007-01-06", 2)
    house.load(_raw(spark, [*ONE, late]), "one", members=_raw(spark, ONE))
    rows = staged[0].collect()
    assert len(rows) == 4 and all((r["CUSTOMER_CODE"] is None) == (r["customer_key"] != -1) for r in rows)
    assert [r["CUSTOMER_CODE"] for r in house.late_sales().collect()] == ["C8"]


def test_late_customers_move_from_minus_one(spark, house):
    known = [r for r in ONE if r[6] != "7"]
    house.load(_raw(spark, ONE), "one", members=_raw(spark, known), products=_raw(spark, known))
    fact = {r.transaction_key: r for r in house.fact_sales().collect()}
    late = [k for k, r in fact.items() if r.customer_key == -1]
    assert len(fact) == 3 and len(late) == 1 and fact[late[0]].product_key == -1 and house.late_sales().count() == 1
    before = {(r.country_region, r.year): r.total_actual_sales for r in house.sales_agg().collect()}
    assert before[("Unknown", 2007)] == 60  # its location is late as well
    house.load(_raw(spark, TWO[:1]), "two", members=_raw(spark, ONE + TWO[:1]), products=_raw(spark, ONE + TWO[:1]),
               effective_date="2008-06-01")
    now = {r.transaction_key: r for r in house.fact_sales().collect()}
    assert house.late_sales().count() == 0 and len(now) == 4
    assert now[late[0]].customer_key > 0 and now[late[0]].product_key > 0 and now[late[0]].total_amount == 60
    assert all(now[k] == fact[k] for k in fact if k not in late)
    after = {(r.country_region, r.year): r.total_actual_sales for r in house.sales_agg().collect()}
    assert after == {**{k: v for k, v in before.items() if k[0] != "Unknown"}, ("T", 2007): 60, ("A", 2008): 48}
    assert house.reconcile().filter("not ok").count() == 0


def test_a_late_customer_of_several_tuples(spark, house):
    """The line keeps its key once; the other matches are lines of their own."""
    house.load(_raw(spark, ONE[1:2]), "one", members=_raw(spark, ONE[:1]))
    twin = list(ONE[1])
    twin[9] = "other education"
    house.load(_raw(spark, []), "two", members=_raw(spark, [ONE[1], tuple(twin)]), effective_date="2008-01-01")
    rows = house.fact_sales().collect()
    assert sorted(r.transaction_key for r in rows) == [1, 2] and len({r.customer_key for r in rows}) == 2


def test_a_year_is_reloaded_alone(spark, house):
    house.load(_raw(spark, ONE), "one")
    house.load(_raw(spark, TWO), "two", effective_date="2008-01-01")
    files, before = set(house.facts.files()), {r.transaction_key: r for r in house.fact_sales().collect()}
    assert house.reload_year(2008, "again") and not house.reload_year(2008, "again")
    assert {re.sub("/part.*", "", f) for f in set(house.facts.files()) - files} == {"batch=again/order_year=2008"}
    now = {r.transaction_key: r for r in house.fact_sales().collect()}
    assert len(now) == len(before) and {k for k, r in before.items() if r.order_year == 2007} == {k for k, r in now.items() if r.order_year == 2007}
    assert all(k > max(before) for k, r in now.items() if r.order_year == 2008)
    # the line of March 2008 now has the version that began in January
    begins = {r.product_key: r.change_begin_date for r in house.product_dim().filter("product_number = 1").collect()}
    assert sorted(str(begins[r.product_key]) for r in now.values() if r.product_key in begins) == ["2007-01-05", "2008-01-01", "2008-01-01"]
    assert house.reconcile().filter("not ok").count() == 0
    house.load(_raw(spark, [_sale(1, 5, "M", "2008-12-01", 9)]), "three", effective_date="2009-01-01")
    assert house.fact_sales().filter("order_year = 2008").count() == 5
    total = house.fact_sales().agg(F.sum("total_amount")).first()[0]
    assert house.sales_agg().agg(F.sum("total_actual_sales")).first()[0] == total and house.reconcile().filter("not ok").count() == 0


def test_a_year_filter_opens_that_year(spark, three):
    house, _ = three
    scan = house.fact_sales().filter("order_year = 2008")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*order_year[^\]]*2008", plan)
    opened = house.facts.read().filter("order_year = 2008").select("_metadata.file_path").distinct().collect()
    assert opened and all("order_year=2008" in r[0] for r in opened)
    assert {r.order_year for r in scan.collect()} == {2008}


def test_an_altered_line_is_found(spark, house):
    house.load(_raw(spark, ONE), "one")
    house.load(_raw(spark, TWO), "two", effective_date="2008-06-01")
    table = house.facts
    rows = incremental.stage(table.read(["two"]).withColumn("net_price", F.when(F.col("quantity") == 4, F.col("net_price") + 1)
                                                            .otherwise(F.col("net_price"))), "altered")
    table.append(rows, "two", again=True)
    bad = {r.check for r in house.reconcile().filter("not ok").collect()}
    assert bad == {"last_load_settled_line_hash"}


def test_empty_loads(spark, house):
    assert house.load(_raw(spark, []), "none") and house.fact_sales().count() == 0 and house.sales_agg().count() == 0
    assert house.load(_raw(spark, ONE), "one", effective_date="2008-01-01") and house.fact_sales().count() == 3
    assert house.reload_year(1990, "nothing") and house.fact_sales().count() == 3
    assert house.reconcile().filter("not ok").count() == 0


def test_odd_records(spark, house):
    odd = [_sale(1, 5, "M", None), _sale(1, 5, "M", "not a day", 2), _sale(2, 6, "M", "2007-01-01", "1.5"), (None,) * 18]
    house.load(_raw(spark, odd), "odd")
    assert house.fact_sales().count() == 3 and {r.order_year for r in house.fact_sales().collect()} == {0}
    assert house.rejects.read().count() == 1 and house.late_sales().count() == 2  # no version is valid without a date
    assert house.reconcile().filter("not ok").count() == 0


# -- operators -----------------------------------------------------------------

def test_unchanged_products_and_other_buckets_are_not_written(spark, house):
    house.load(_raw(spark, [_sale(p, 5, "M", "2007-01-05", 1, p) for p in range(40)]), "one")
    house.load(_raw(spark, [_sale(3, 5, "M", "2007-02-05", 1, 99), _sale(4, 5, "M", "2007-02-05", 2, 4)]), "two", effective_date="2007-02-01")
    written = [f for f in house.products.files() if f.startswith("batch=two")]
    assert len({f.split("/")[1] for f in written}) == 1  # product 4 kept its price
    dim = house.product_dim()
    assert dim.filter("product_number = 3").count() == 2 and dim.filter("is_current = 1 and product_key > 0").count() == 40
    assert dim.count() == 42


def test_merge_by_buckets_equals_the_merge_of_the_whole(spark, house):
    r = random.Random(3)
    rows = [_sale(r.randrange(30), 5, "M", f"2007-01-{r.randint(1, 28):02d}", 1, r.randint(1, 3)) for _ in range(120)]
    more = [_sale(r.randrange(35), 5, "M", f"2007-03-{r.randint(1, 28):02d}", 1, r.randint(1, 3)) for _ in range(60)]
    house.load(_raw(spark, rows), "one")
    before, landed = incremental.stage(house.product_dim(), "before"), None
    house.load(_raw(spark, more), "two", effective_date="2007-03-01")
    landed = house.silver.read(["two"])
    expect = scd2.scd2_merge(before, landed, "2007-03-01")
    assert sorted(house.product_dim().collect(), key=str) == sorted(expect.select(*DIM_PRODUCT.fieldNames()).collect(), key=str)


def test_the_dimension_is_not_shuffled_by_a_merge(spark, house):
    products = [_sale(p, 5, "M", "2007-01-05", 1, p) for p in range(40)]
    house.products.append(dims.product_dimension_initial(clean_sales(_raw(spark, products))).withColumn("bucket", F.lit(0)), "one")
    dim = house.products.read(["one"]).select(*DIM_PRODUCT.fieldNames())
    changed = incremental.stage(dim.filter("product_number in (3, 4)").select(
        "product_number", *scd2.VALUE_COLS).withColumn("unit_price", F.lit(77.0)).withColumn("bucket", F.lit(0)), "changed")
    plan = incremental.merge_buckets(dim, changed, "2007-02-01", dt.date(2007, 2, 1), 100) \
        ._jdf.queryExecution().executedPlan().toString()
    for kind in ("LeftAnti", "LeftSemi"):
        for join in re.finditer(rf"BroadcastHashJoin[^\n]*{kind}", plan):
            scan = plan[join.end():].index("FileScan")
            assert "Exchange hashpartitioning" not in plan[join.end():join.end() + scan]
    assert "SortMergeJoin [product_number" not in plan.split("BroadcastHashJoin")[0]


def test_repeated_keys_are_found_without_a_shuffle_of_them(spark):
    df = spark.range(100_000).withColumnRenamed("id", "k")
    assert incremental.repeated_keys(df, "k").first()[0] == 0
    planted = df.unionByName(spark.createDataFrame([(5,), (5,), (99_999,), (32_768,)], "k long"))
    out = incremental.repeated_keys(planted, "k")
    assert out.first()[0] == 4
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\(([^,]+),", plan) and not re.search(r"hashpartitioning\(k#", plan)
    assert sorted(map(tuple, incremental.duplicate_dense_keys(planted, "k").collect())) == [(5, 3), (32_768, 2), (99_999, 2)]
    sparse = spark.createDataFrame([(-10 ** 15,), (10 ** 15,), (10 ** 15,), (None,), (None,)], "k long")
    assert incremental.key_ranges(sparse, "k") is None and incremental.repeated_keys(sparse, "k").first()[0] == 1
    assert [tuple(r) for r in incremental.duplicate_dense_keys(sparse, "k").collect()] == [(10 ** 15, 2)]
    below = spark.createDataFrame([(-3,), (-2,), (-3,), (0,), (None,)], "k long")
    assert [tuple(r) for r in incremental.duplicate_dense_keys(below, "k").collect()] == [(-3, 2)]
    assert incremental.repeated_keys(below.limit(0), "k").first()[0] == 0 and incremental.duplicate_dense_keys(below.limit(0), "k").count() == 0


@pytest.mark.parametrize("seed,bin_days", [(1, 30), (2, 1), (3, 4000)])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_binned_lookup_equals_the_plain_one(spark, seed, bin_days, how):
    r = random.Random(seed)
    day = lambda: dt.date(2007, 1, 1) + dt.timedelta(days=r.randrange(700))
    dim = []
    for p in range(6):  # one product of many versions
        cuts = sorted({day() for _ in range(60 if p == 0 else 3)})
        for b, e in zip(cuts, [*cuts[1:], dt.date(9999, 12, 31)]):
            dim.append((len(dim) + 1, p, b, e))
    dim += [(900, 1, dt.date(2007, 5, 1), dt.date(2007, 5, 1)), (901, None, dt.date(2007, 1, 1), dt.date(9999, 12, 31)), (-1, None, None, None),
            (902, 2, dt.date(2007, 6, 1), dt.date(2007, 9, 1))]  # empty, without a product, unknown, overlapping
    sales = [(r.choice([0, 0, 0, 1, 2, 3, 9, None]), r.choice([dt.datetime.combine(day(), dt.time(r.choice([0, 13]))), None]), i) for i in range(400)]
    d = spark.createDataFrame(dim, "product_key long, product_number long, change_begin_date date, change_end_date date")
    s = spark.createDataFrame(sales, "PRODUCTKEY long, ORDER_DATE timestamp_ntz, n int")
    for rows in (s, s.limit(0), s.filter("ORDER_DATE is null")):
        a, b = (f(rows, d, how=how).select("n", "product_key") for f in (
            scd2.scd2_lookup, lambda x, y, how: incremental.binned_lookup(x, y, how=how, bin_days=bin_days)))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_partitioned_table(spark, tmp_root):
    schema = spark.range(0).selectExpr("id as a", "cast(id as string) as b").schema
    t = PartitionedTable(spark, tmp_root, "t", schema, "y")
    rows = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], "a long, b string, y int")
    assert t.read().count() == 0 and t.append(rows, "one") and not t.append(rows, "one") and t.append(rows, "two")
    os.remove(f"{t.path}/batch=two/_SUCCESS")  # a write that did not end
    assert t.batches() == ["one"] and t.read().columns == ["a", "b", "batch", "y"] and t.read().count() == 2
    assert t.append(rows.filter("y = 1"), "two") and sorted(map(tuple, t.read().collect())) == [
        (1, "x", "one", 1), (1, "x", "two", 1), (2, "y", "one", 2)]
    assert sorted(t.leaves(["one", "two", "three"])) == [("one", 1), ("one", 2), ("two", 1)]
    before = {f: os.stat(f"{t.path}/{f}").st_mtime_ns for f in t.files()}
    t.replace(spark.createDataFrame([(7, "z", "one", 2)], "a long, b string, batch string, y int"))
    after = {f: os.stat(f"{t.path}/{f}").st_mtime_ns for f in t.files()}
    assert {f for f in before if "y=1" in f} <= set(after) and all(after[f] == before[f] for f in before if f in after)
    assert sorted(map(tuple, t.read(["one"]).collect())) == [(1, "x", "one", 1), (7, "z", "one", 2)]
    with pytest.raises(ValueError):
        t.append(rows, "../up")


def test_fact_key_check_of_loads(spark, three):
    key = PRIMARY_KEYS["gold_fact_sales"][0]
    fact = three[0].fact_sales()
    assert incremental.repeated_keys(fact.unionByName(fact.limit(2)), key).first()[0] == 2
