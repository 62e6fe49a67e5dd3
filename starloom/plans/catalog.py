"""Registry of checkable queries: one entry per operator of the warehouse,
named by its inventory id, each a Spark DataFrame over the driver's tables
plus (where SQL can say it) the equivalent DuckDB statement.

Every query reads the given tables (or data Spark derives from them) in
full; nothing is sampled or capped except the reference's own LIMIT in
the fan-out check.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import dates as fd
from starloom.functions import numbers as fn
from starloom.functions import text as ft
from starloom.operators import dims, quality, scd2
from starloom.operators.facts import BROADCAST_MAX_ROWS, forecast_vs_actual
from starloom.operators.keys import broadcast_if_bounded, with_unknown_member
from starloom.operators.silver import clean_sales, drop_exact_duplicates, split_dead_letter
from starloom.plans import oracle as O
from starloom.plans.context import BATCH_CUT, context
from starloom.schemas import (
    BRONZE_BUSINESS_COLUMNS, DIM_CUSTOMER, DIM_LOCATION, LAYERS, SILVER,
)
from starloom.session import scratch_path
from starloom.sources.bronze import (
    append_bronze, normalize_columns, read_bronze, read_sales_json, split_sales_lines, stamp_ingestion,
)
from starloom.sources.driver_tables import SOURCE_NAMES, split_by_order_date
from starloom.sources.forecast import forecast_rows, read_forecast_json, split_forecast_lines
from starloom.sources.tables import TableStore

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


SILVER_CMP = [c for c in SILVER.fieldNames() if c not in ("INGESTION_DATE", "TRANSFORMED_DATE")]
_SILVER_CMP_SQL = ", ".join(SILVER_CMP)
_RAW_CMP_SQL = "SELECT * EXCLUDE (NET_PRICE_D), NET_PRICE_D AS NET_PRICE FROM {src}"


def raw_cmp(df: DataFrame) -> DataFrame:
    """Raw text columns; the price text is compared as the number it holds
    (engines print doubles differently)."""
    return df.select(*[F.col(c).cast("double").alias(c) if c == "NET_PRICE" else F.col(c)
                       for c in BRONZE_BUSINESS_COLUMNS])


def _ctx(spark, sf):
    return context(spark, sf)


def _store(spark, name):
    return TableStore(spark, scratch_path(spark, name))


_YDIM_D = ("SELECT -1 AS YEAR_KEY, 9999 AS YEAR UNION ALL SELECT DISTINCT year, year FROM ddim "
           "WHERE year IS NOT NULL AND year <> -1")


# ---------------------------------------------------------------- sources / sinks
@query("s01_read_sales_json", O.compose(_RAW_CMP_SQL.format(src="raw"), "raw"))
def s01(spark, sf):
    path = scratch_path(spark, "sales-json")
    _ctx(spark, sf).raw_source.write.json(path)
    return raw_cmp(read_sales_json(spark, path, lines=True))


@query("s02_normalize_columns", O.compose(_RAW_CMP_SQL.format(src="raw"), "raw"))
def s02(spark, sf):
    return raw_cmp(normalize_columns(_ctx(spark, sf).raw_source))


@query("s03_append_bronze", O.compose(
    "SELECT * EXCLUDE (NET_PRICE_D), NET_PRICE_D AS NET_PRICE, true AS stamped FROM raw", "raw"))
def s03(spark, sf):
    store = _store(spark, "bronze")
    first, second = split_by_order_date(_ctx(spark, sf).raw_source, BATCH_CUT)
    for batch in (first, second):
        store.append(stamp_ingestion(normalize_columns(batch)), "bronze_sales")
    out = store.read("bronze_sales")
    stamped = F.col("INGESTION_DATE").isNotNull().alias("stamped")
    return out.select(*raw_cmp(out).columns, stamped).transform(
        lambda df: df.withColumn("NET_PRICE", F.col("NET_PRICE").cast("double")))


@query("s04_scan_layer", O.compose(f"SELECT {_SILVER_CMP_SQL} FROM silver", "silver"))
def s04(spark, sf):
    store = _store(spark, "layers")
    store.write(_ctx(spark, sf).silver, "silver_sales", SILVER)
    return store.read("silver_sales").select(*SILVER_CMP)


@query("s05_replace_table", O.compose(_RAW_CMP_SQL.format(src="dedup"), "dedup"))
def s05(spark, sf):
    store = _store(spark, "layers")
    bronze = _ctx(spark, sf).bronze
    store.write(bronze, "bronze_sales")
    store.write(drop_exact_duplicates(store.read("bronze_sales"), stored=True), "bronze_sales")
    return raw_cmp(store.read("bronze_sales"))


@query("s06_truncate_reload", O.compose("SELECT * FROM loc", "loc"))
def s06(spark, sf):
    ctx = _ctx(spark, sf)
    store = _store(spark, "layers")
    store.write(dims.location_dimension(ctx.silver_batch1), "gold_dim_location", DIM_LOCATION)
    store.write(ctx.location_dim, "gold_dim_location", DIM_LOCATION)
    return store.read("gold_dim_location")


@query("s07_copy_table", O.compose("SELECT * FROM cust", "cust"))
def s07(spark, sf):
    store = _store(spark, "layers")
    store.write(_ctx(spark, sf).customer_dim, "gold_dim_customer", DIM_CUSTOMER)
    return store.copy("gold_dim_customer", "gold_dim_customer_copy", DIM_CUSTOMER)


@query("s08_load_forecast_json", O.compose("SELECT * FROM forecast", "forecast"))
def s08(spark, sf):
    path = scratch_path(spark, "forecast-json")
    _ctx(spark, sf).forecast_records.write.json(path)
    return forecast_rows(read_forecast_json(spark, path, lines=True))


@query("s09_init_layers", "SELECT table_name, CAST(row_count AS BIGINT) AS row_count, column_names FROM (VALUES "
       + ", ".join(f"('{n}', 0, '{','.join(f.name for f in s.fields)}')" for t in LAYERS.values() for n, s in t.items())
       + ") AS t(table_name, row_count, column_names) WHERE (SELECT count(*) FROM orders) >= 0")
def s09(spark, sf):
    """A store that holds the customer dimension is reset; every
    layer table is there, empty, with its declared columns."""
    store = _store(spark, "reset")
    store.write(_ctx(spark, sf).customer_dim, "gold_dim_customer", DIM_CUSTOMER)
    tables = store.init_layers()
    columns = F.create_map(*[F.lit(x) for n, t in tables.items() for x in (n, ",".join(t.columns))])
    return quality.table_row_counts({n: store.read(n) for n in tables}).withColumn("column_names", columns[F.col("table_name")])


@query("s13_read_sales_json_array", O.compose(_RAW_CMP_SQL.format(src="raw"), "raw"))
def s13(spark, sf):
    """S1 in the form that the reference reads: one JSON array per file."""
    path = scratch_path(spark, "sales-array")
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("r")
    # an array per task's rows, cut into compressed files of a bounded number of records
    rows = _ctx(spark, sf).raw_source.select(record, F.spark_partition_id().alias("p"),
                                             F.floor(F.monotonically_increasing_id() / 5000).alias("f"))
    rows.groupBy("p", "f").agg(F.concat(F.lit("["), F.array_join(F.collect_list("r"), ","), F.lit("]")).alias("value")) \
        .select("value", "p", "f").write.partitionBy("p", "f").option("compression", "gzip").text(path)
    return raw_cmp(read_sales_json(spark, f"{path}/*/*", lines=False))


_BAD_EVERY = 50


@query("s14_malformed_sales_lines", O.compose(
    f"SELECT 'kept' AS outcome, CAST(count(*) AS BIGINT) AS n FROM raw "
    f"WHERE CAST(CUSTOMERKEY AS BIGINT) % {_BAD_EVERY} NOT IN (0, 1) "
    f"UNION ALL SELECT 'malformed_line', count(*) FROM raw WHERE CAST(CUSTOMERKEY AS BIGINT) % {_BAD_EVERY} = 0 "
    f"UNION ALL SELECT 'unknown_field', count(*) FROM raw WHERE CAST(CUSTOMERKEY AS BIGINT) % {_BAD_EVERY} = 1", "raw"))
def s14(spark, sf):
    """Lines of some customers arrive cut off, those of others with a
    field too many; they go to the dead letter, the rest is read."""
    path = scratch_path(spark, "bad-lines")
    key = F.col("CustomerKey").cast("long") % _BAD_EVERY
    line = F.to_json(F.struct("*"))
    line = F.when(key == 0, F.expr("left(line, length(line) - 5)")).when(
        key == 1, F.concat(F.expr("left(line, length(line) - 1)"), F.lit(',"Extra":"x"}'))).otherwise(F.col("line"))
    _ctx(spark, sf).raw_source.withColumn("line", F.to_json(F.struct("*"))).select(line.alias("value")).write.text(path)
    good, rejects = split_sales_lines(spark, path, SOURCE_NAMES)
    outcomes = good.select(F.lit("kept").alias("outcome")).unionByName(rejects.select(F.col("reject_reason").alias("outcome")))
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("s15_malformed_forecast_lines", O.compose(
    "SELECT country_region, brand, forecast, year FROM forecast WHERE year % 2 = 0", "forecast"))
def s15(spark, sf):
    """Forecast lines of odd years arrive cut off; the others are read."""
    path = scratch_path(spark, "bad-forecast")
    line = F.to_json(F.struct("countryRegion", "brand", "year", "forecast"))
    _ctx(spark, sf).forecast_records.select("year", line.alias("line")).select(
        F.when(F.col("year") % 2 != 0, F.expr("left(line, length(line) - 3)")).otherwise(F.col("line")).alias("value")) \
        .write.text(path)
    return forecast_rows(split_forecast_lines(spark, path)[0])


@query("s16_csv_line_breaks", O.compose(
    "SELECT CUSTOMERKEY AS customer, concat(CUSTOMER_CODE, chr(10), 'a', chr(13), '%0A', '\"\\') AS text, "
    "CAST(count(*) AS BIGINT) AS n FROM raw GROUP BY ALL", "raw"))
def s16(spark, sf):
    """Text with line breaks, quotes, backslashes and percent signs
    comes back from CSV as it was."""
    path = scratch_path(spark, "csv-breaks")
    odd = F.concat("CUSTOMER_CODE", F.lit('\na\r%0A"\\'))
    append_bronze(normalize_columns(_ctx(spark, sf).raw_source).withColumn("NAME", odd), path, fmt="csv")
    return read_bronze(spark, path, fmt="csv").groupBy(F.col("CUSTOMERKEY").alias("customer"), F.col("NAME").alias("text")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("s11_bronze_csv", O.compose(_RAW_CMP_SQL.format(src="raw"), "raw"))
def s11(spark, sf):
    path = scratch_path(spark, "bronze-csv")
    append_bronze(normalize_columns(_ctx(spark, sf).raw_source), path, fmt="csv")
    return raw_cmp(read_bronze(spark, path, fmt="csv"))


@query("s12_stream_ingest_bronze", O.compose(
    "SELECT * EXCLUDE (NET_PRICE_D), NET_PRICE_D AS NET_PRICE, true AS stamped FROM raw", "raw"))
def s12(spark, sf):
    """Raw records land as two JSON-lines drops; a file stream appends each
    file to bronze once (running the stream twice adds nothing)."""
    from starloom.streaming import ingest_sales_files
    src, bronze, ckpt = (scratch_path(spark, n) for n in ("drop", "bronze", "stream-ckpt"))
    first, second = split_by_order_date(_ctx(spark, sf).raw_source, BATCH_CUT)
    for i, batch in enumerate((first, second)):
        batch.write.option("compression", "gzip").json(f"{src}/drop={i}")
        ingest_sales_files(spark, f"{src}/drop=*", bronze, ckpt, SOURCE_NAMES).awaitTermination()
    ingest_sales_files(spark, f"{src}/drop=*", bronze, ckpt, SOURCE_NAMES).awaitTermination()
    out = spark.read.parquet(bronze)
    return out.select(*raw_cmp(out).columns, F.col("INGESTION_DATE").isNotNull().alias("stamped")) \
        .withColumn("NET_PRICE", F.col("NET_PRICE").cast("double"))


# ---------------------------------------------------------------- projections / filters
@query("p01_rename_columns", O.compose(
    "SELECT CUSTOMER_KEY, ORDER_DATE, COUNTRY_REGION FROM silver", "silver"))
def p01(spark, sf):
    return _ctx(spark, sf).silver.select("CUSTOMER_KEY", "ORDER_DATE", "COUNTRY_REGION")


@query("p02_select_reorder", O.compose(
    "SELECT customer_code, customer_key, name FROM cust", "cust"))
def p02(spark, sf):
    return _ctx(spark, sf).customer_dim.select("customer_code", "customer_key", "name")


@query("p03_business_key_alias", O.compose(
    "SELECT product_number, product_description, unit_price FROM prod", "prod"))
def p03(spark, sf):
    return _ctx(spark, sf).product_dim.select("product_number", "product_description", "unit_price")


@query("p04_amount_expression", O.compose(
    "SELECT QUANTITY, NET_PRICE, CAST(QUANTITY AS DOUBLE) * CAST(NET_PRICE AS DOUBLE) AS amount "
    "FROM silver", "silver"))
def p04(spark, sf):
    s = _ctx(spark, sf).silver
    return s.select("QUANTITY", "NET_PRICE",
                    (F.col("QUANTITY").cast("double") * F.col("NET_PRICE").cast("double"))
                    .alias("amount"))


@query("p05_unknown_key_coalesce", O.compose(
    "SELECT product_key, customer_key, location_key, date_key FROM fact", "fact"))
def p05(spark, sf):
    return _ctx(spark, sf).fact.select("product_key", "customer_key", "location_key", "date_key")


@query("p06_year_filter", O.compose(
    "SELECT DISTINCT year FROM cal WHERE year IS NOT NULL AND year <> -1", "cal"))
def p06(spark, sf):
    c = _ctx(spark, sf).calendar
    return c.filter(F.col("year").isNotNull() & (F.col("year") != -1)).select("year").distinct()


_CUR_B1 = ("(SELECT * FROM prod_b1 WHERE is_current = 1 AND product_key <> -1 "
           "AND product_number IS NOT NULL)")
_ATTR_EQ = " AND ".join(f"c.{x} IS NOT DISTINCT FROM s.{x}" for x in
                        ["product_description", "color", "brand", "subcategory", "category"])
_CHANGED_SQL = f"""
SELECT c.product_number,
       NOT (c.unit_price IS NOT DISTINCT FROM s.unit_price) AS unit_price_changed,
       NOT ({_ATTR_EQ}) AS attributes_changed
FROM {_CUR_B1} c JOIN src_b2 s ON c.product_number = s.product_number
WHERE NOT ({_ATTR_EQ} AND c.unit_price IS NOT DISTINCT FROM s.unit_price)
"""


@query("p07_changed_predicate", O.compose(_CHANGED_SQL, "prod_b1", "src_b2"))
def p07(spark, sf):
    ctx = _ctx(spark, sf)
    return scd2.changed_products(ctx.product_dim_batch1, ctx.silver_batch2)


@query("p08_filter_unknown_date", O.compose("SELECT * FROM fact WHERE date_key = -1", "fact"))
def p08(spark, sf):
    """P8, with the keys of the fact in its order."""
    return _ctx(spark, sf).ordered_fact.filter(F.col("date_key") == -1)


@query("p09_dead_letter_split", O.compose("""
SELECT outcome, count(*) AS row_count FROM (
  SELECT CASE WHEN coalesce(QUANTITY <= 0, false) THEN 'non_positive_quantity'
              WHEN coalesce(NET_PRICE <= 0, false) THEN 'non_positive_price'
              ELSE 'accepted' END AS outcome
  FROM silver) GROUP BY outcome""", "silver"))
def p09(spark, sf):
    good, bad = split_dead_letter(_ctx(spark, sf).bronze)
    ok = good.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("accepted").alias("outcome"), "row_count")
    rejected = bad.groupBy(F.col("reject_reason").alias("outcome")).agg(
        F.count(F.lit(1)).alias("row_count"))
    return ok.filter(F.col("row_count") > 0).unionByName(rejected)


_DIRT_EVERY = 20
_DIRTY = f"""
(SELECT DISTINCT * EXCLUDE (QUANTITY, NET_PRICE_D, ORDERDATE, PRODUCTKEY, EDUCATION, k),
  CASE k WHEN 1 THEN '1.5' WHEN 2 THEN '0' WHEN 3 THEN '-2' WHEN 4 THEN 'abc' WHEN 5 THEN NULL ELSE QUANTITY END AS q,
  CASE k WHEN 6 THEN 0 WHEN 7 THEN NULL ELSE NET_PRICE_D END AS p,
  CASE k WHEN 8 THEN NULL ELSE ORDERDATE END AS d, CASE k WHEN 9 THEN NULL ELSE PRODUCTKEY END AS product,
  CASE k WHEN 10 THEN NULL ELSE EDUCATION END AS edu
  FROM (SELECT *, CAST(CUSTOMERKEY AS BIGINT) % {_DIRT_EVERY} AS k FROM raw))"""


def dirty_records(raw: DataFrame) -> DataFrame:
    """Raw records in which some customers have odd values: fractional, zero,
    negative, worded and missing quantities, bad prices and dates, missing
    products, blanks from outside ASCII."""
    k = F.col("CustomerKey").cast("long") % _DIRT_EVERY

    def odd(name: str, values: dict) -> Column:
        c = F.col(name)
        for n, v in values.items():
            c = F.when(k == n, F.lit(v)).otherwise(c)
        return c.alias(name)

    dirt = {"Quantity": {1: "1.5", 2: "0", 3: "-2", 4: "abc", 5: None}, "Net-Price": {6: "0", 7: "n/a"},
            "OrderDate": {8: "some day"}, "ProductKey": {9: None}, "Education": {10: "\u00a0\u3000 "}}
    return raw.select(*[odd(c, dirt.get(c, {})) if c in dirt else F.col(f"`{c}`") for c in raw.columns])


@query("p09b_dead_letter_reasons", O.compose(f"""
SELECT CASE WHEN q = '1.5' THEN 'fractional_quantity' WHEN q IN ('0', '-2') THEN 'non_positive_quantity'
            WHEN round_even(p, 0) <= 0 THEN 'non_positive_price' ELSE 'accepted' END AS outcome, count(*) AS n
FROM {_DIRTY} GROUP BY 1""", "raw"))
def p09b(spark, sf):
    """P9 on odd values: every reason to reject occurs."""
    bronze = stamp_ingestion(normalize_columns(dirty_records(_ctx(spark, sf).raw_source)))
    good, bad = split_dead_letter(bronze, together=True)
    outcomes = good.select(F.lit("accepted").alias("outcome")).unionByName(bad.select(F.col("reject_reason").alias("outcome")))
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("c01b_clean_odd_values", O.compose(f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE d IS NULL) AS no_date, count(*) FILTER (WHERE product IS NULL) AS no_product,
       count(*) FILTER (WHERE try_cast(q AS DOUBLE) IS NULL) AS no_quantity, count(*) FILTER (WHERE p IS NULL) AS no_price,
       count(*) FILTER (WHERE edu IS NULL OR trim(edu) = '') AS no_education,
       count(*) FILTER (WHERE try_cast(q AS DOUBLE) <= 0) AS not_positive
FROM {_DIRTY} WHERE q IS DISTINCT FROM '1.5'""", "raw"))
def c01b(spark, sf):
    """C1, F5, F6, F8 on odd values: a bad cell becomes NULL and leaves its
    row's other cells alone."""
    silver = clean_sales(stamp_ingestion(normalize_columns(dirty_records(_ctx(spark, sf).raw_source))))
    n = lambda c: F.count(F.when(c, 1))
    return silver.agg(F.count(F.lit(1)).alias("rows"), n(F.col("ORDER_DATE").isNull()).alias("no_date"),
                      n(F.col("PRODUCTKEY").isNull()).alias("no_product"), n(F.col("QUANTITY").isNull()).alias("no_quantity"),
                      n(F.col("NET_PRICE").isNull()).alias("no_price"),
                      n(F.col("EDUCATION") == "Not Provided").alias("no_education"),
                      n(F.col("QUANTITY") <= 0).alias("not_positive"))


@query("p10_constant_column", O.compose("SELECT date_key, is_holiday FROM cal", "cal"))
def p10(spark, sf):
    return _ctx(spark, sf).calendar.select("date_key", "is_holiday")


# ---------------------------------------------------------------- joins
@query("j01_customer_lookup", O.compose("""
SELECT s.CUSTOMER_CODE, coalesce(c.customer_key, -1) AS customer_key
FROM silver s LEFT JOIN cust c ON s.CUSTOMER_CODE = c.customer_code""", "silver", "cust"))
def j01(spark, sf):
    ctx = _ctx(spark, sf)
    c = ctx.customer_dim.select(F.col("customer_key").alias("_k"), F.col("customer_code").alias("_c"))
    return (ctx.silver.select("CUSTOMER_CODE").join(c, F.col("CUSTOMER_CODE") == F.col("_c"), "left")
            .select("CUSTOMER_CODE", F.coalesce("_k", F.lit(-1)).cast("long").alias("customer_key")))


@query("j02_location_lookup", O.compose("""
SELECT s.CONTINENT, s.COUNTRY_REGION, s.CITY, s.STATE, coalesce(l.location_key, -1) AS location_key
FROM silver s LEFT JOIN loc l ON s.CONTINENT = l.continent AND s.COUNTRY_REGION = l.country_region
 AND s.CITY = l.city AND s.STATE = l.state""", "silver", "loc"))
def j02(spark, sf):
    ctx = _ctx(spark, sf)
    l = ctx.location_dim.select(*[F.col(c).alias(f"_{c}") for c in ctx.location_dim.columns])
    cond = ((F.col("CONTINENT") == F.col("_continent")) & (F.col("COUNTRY_REGION") == F.col("_country_region"))
            & (F.col("CITY") == F.col("_city")) & (F.col("STATE") == F.col("_state")))
    return (ctx.silver.select("CONTINENT", "COUNTRY_REGION", "CITY", "STATE").join(l, cond, "left")
            .select("CONTINENT", "COUNTRY_REGION", "CITY", "STATE",
                    F.coalesce("_location_key", F.lit(-1)).cast("long").alias("location_key")))


@query("j03_date_lookup", O.compose("""
SELECT s.ORDER_DATE, CAST(coalesce(d.date_key, -1) AS INTEGER) AS date_key
FROM silver s LEFT JOIN ddim d ON CAST(d.date AS TIMESTAMP) = s.ORDER_DATE""", "silver", "ddim"))
def j03(spark, sf):
    ctx = _ctx(spark, sf)
    d = broadcast_if_bounded(
        ctx.date_dim.select(F.col("date_key").alias("_k"), F.col("date").alias("_d")), BROADCAST_MAX_ROWS)
    return (ctx.silver.select("ORDER_DATE")
            .join(d, F.col("ORDER_DATE") == F.col("_d").cast("timestamp_ntz"), "left")
            .select("ORDER_DATE", F.coalesce("_k", F.lit(-1)).cast("int").alias("date_key")))


_LOOKUP_MERGED = """
FROM silver s {how} JOIN prod_merged p ON s.PRODUCTKEY = p.product_number
 AND s.ORDER_DATE >= p.change_begin_date AND s.ORDER_DATE < p.change_end_date"""


@query("j04_scd2_lookup", O.compose(
    "SELECT s.PRODUCTKEY, s.ORDER_DATE, coalesce(p.product_key, -1) AS product_key"
    + _LOOKUP_MERGED.format(how="LEFT"), "silver", "prod_merged"))
def j04(spark, sf):
    ctx = _ctx(spark, sf)
    return scd2.scd2_lookup(ctx.silver.select("PRODUCTKEY", "ORDER_DATE"), ctx.product_dim_merged)


@query("j05_scd2_inner_join", O.compose(
    "SELECT p.product_key, count(*) AS sales" + _LOOKUP_MERGED.format(how="") +
    " GROUP BY p.product_key", "silver", "prod_merged"))
def j05(spark, sf):
    ctx = _ctx(spark, sf)
    m = scd2.scd2_lookup(ctx.silver.select("PRODUCTKEY", "ORDER_DATE"), ctx.product_dim_merged,
                         how="inner")
    return m.groupBy("product_key").agg(F.count(F.lit(1)).alias("sales"))


_EQ_ALL = _ATTR_EQ + " AND c.unit_price IS NOT DISTINCT FROM s.unit_price"


@query("j06_new_or_changed", O.compose(f"""
SELECT s.product_number,
       CASE WHEN c.product_number IS NULL THEN 'new' WHEN {_EQ_ALL} THEN 'unchanged'
            ELSE 'changed' END AS status
FROM src_b2 s LEFT JOIN {_CUR_B1} c ON s.product_number = c.product_number""",
    "prod_b1", "src_b2"))
def j06(spark, sf):
    ctx = _ctx(spark, sf)
    return scd2.classify_incoming(ctx.product_dim_batch1, ctx.silver_batch2)


@query("j07_semi_join_changed", O.compose(
    f"SELECT * FROM prod_b1 WHERE product_number IN (SELECT product_number FROM ({_CHANGED_SQL}))",
    "prod_b1", "src_b2"))
def j07(spark, sf):
    ctx = _ctx(spark, sf)
    return scd2.versions_of_changed(ctx.product_dim_batch1, ctx.silver_batch2)


@query("j08_unknown_member_guard", O.compose("SELECT * FROM loc", "loc"))
def j08(spark, sf):
    loc = _ctx(spark, sf).location_dim
    again = with_unknown_member(loc, {"location_key": -1, "continent": "Unknown",
                                      "country_region": "Unknown", "state": "Unknown",
                                      "city": "Unknown"}, "location_key")
    return again


@query("j09_star_join", O.compose("""
SELECT f.quantity, f.net_price, p.brand, l.country_region, d.year
FROM fact f LEFT JOIN prod p ON f.product_key = p.product_key
LEFT JOIN loc l ON f.location_key = l.location_key
LEFT JOIN ddim d ON f.date_key = d.date_key""", "fact", "prod", "loc", "ddim"))
def j09(spark, sf):
    ctx = _ctx(spark, sf)
    return (ctx.fact.select("quantity", "net_price", "product_key", "location_key", "date_key")
            .join(ctx.product_dim.select("product_key", "brand"), "product_key", "left")
            .join(ctx.location_dim.select("location_key", "country_region"), "location_key", "left")
            .join(broadcast_if_bounded(ctx.date_dim.select("date_key", "year"), BROADCAST_MAX_ROWS),
                  "date_key", "left")
            .select("quantity", "net_price", "brand", "country_region", "year"))


@query("j11_orphan_keys", O.compose("""
SELECT 'product_key' AS foreign_key, count(*) AS orphan_rows FROM fact f
  WHERE NOT EXISTS (SELECT 1 FROM prod p WHERE p.product_key = f.product_key)
UNION ALL SELECT 'customer_key', count(*) FROM fact f
  WHERE NOT EXISTS (SELECT 1 FROM cust c WHERE c.customer_key = f.customer_key)
UNION ALL SELECT 'location_key', count(*) FROM fact f
  WHERE NOT EXISTS (SELECT 1 FROM loc l WHERE l.location_key = f.location_key)
UNION ALL SELECT 'date_key', count(*) FROM fact f
  WHERE NOT EXISTS (SELECT 1 FROM ddim d WHERE d.date_key = f.date_key)""",
    "fact", "prod", "cust", "loc", "ddim"))
def j11(spark, sf):
    ctx = _ctx(spark, sf)
    return quality.fact_orphans(ctx.fact, ctx.product_dim, ctx.customer_dim,
                                ctx.location_dim, ctx.date_dim)


@query("j11b_year_foreign_keys", O.compose(f"""
SELECT 'gold_actual_sales_agg_fact.year' AS foreign_key, count(*) AS orphan_rows FROM agg a
  WHERE a.year IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ({_YDIM_D}) y WHERE y.YEAR = a.year)
UNION ALL SELECT 'gold_forecast.year', count(*) FROM forecast f
  WHERE f.year IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ({_YDIM_D}) y WHERE y.YEAR = f.year)""",
    "agg", "forecast", "ddim"))
def j11b(spark, sf):
    ctx = _ctx(spark, sf)
    return quality.year_orphans(ctx.agg, forecast_rows(ctx.forecast_records),
                                dims.year_dimension(ctx.date_dim))


# ---------------------------------------------------------------- aggregation
@query("a01_drop_duplicates", O.compose(_RAW_CMP_SQL.format(src="dedup"), "dedup"))
def a01(spark, sf):
    return raw_cmp(drop_exact_duplicates(_ctx(spark, sf).bronze))


@query("a02_select_distinct", O.compose(
    "SELECT DISTINCT CONTINENT, COUNTRY_REGION, CITY, STATE FROM silver", "silver"))
def a02(spark, sf):
    return _ctx(spark, sf).silver.select("CONTINENT", "COUNTRY_REGION", "CITY", "STATE").distinct()


@query("a03_max_price_per_product", O.compose(
    "SELECT * EXCLUDE (last_order_date) FROM (" + O._versions("silver") + ")", "silver"))
def a03(spark, sf):
    return dims.product_versions(_ctx(spark, sf).silver).drop("last_order_date", "first_order_date")


@query("a04_sum_by_country_brand_year", O.compose("SELECT * FROM agg", "agg"))
def a04(spark, sf):
    """The join-then-group form (c09 is the pre-aggregated form)."""
    ctx = _ctx(spark, sf)
    return (ctx.fact.join(ctx.product_dim.select("product_key", "brand"), "product_key", "left")
            .join(ctx.location_dim.select("location_key", "country_region"), "location_key", "left")
            .join(broadcast_if_bounded(ctx.date_dim.select("date_key", "year"), BROADCAST_MAX_ROWS),
                  "date_key", "left")
            .groupBy("country_region", "brand", "year")
            .agg(F.sum("total_amount").alias("total_actual_sales")))


@query("a05_first_order_day", O.compose(
    "SELECT coalesce(min(CAST(ORDER_DATE AS DATE)), DATE '1900-01-01') AS first_order_day "
    "FROM silver", "silver"))
def a05(spark, sf):
    return _ctx(spark, sf).silver.agg(
        F.coalesce(F.min(F.to_date("ORDER_DATE")), F.lit("1900-01-01").cast("date"))
        .alias("first_order_day"))


@query("a06_count_and_sum", O.compose(
    "SELECT count(*) AS row_count, sum(total_amount) AS total_amount FROM fact", "fact"))
def a06(spark, sf):
    return _ctx(spark, sf).fact.agg(F.count(F.lit(1)).alias("row_count"),
                                    F.sum("total_amount").alias("total_amount"))


@query("a07_group_having", O.compose(
    "SELECT PRODUCTKEY, ORDER_DATE, count(*) AS sales FROM silver "
    "GROUP BY PRODUCTKEY, ORDER_DATE HAVING count(*) > 1", "silver"))
def a07(spark, sf):
    return (_ctx(spark, sf).silver.groupBy("PRODUCTKEY", "ORDER_DATE")
            .agg(F.count(F.lit(1)).alias("sales")).filter(F.col("sales") > 1))


_HISTORY_SQL = """
SELECT product_number, count(*) AS version_count,
       string_agg(CAST(unit_price AS VARCHAR), ',' ORDER BY product_key) AS unit_prices
FROM prod_merged WHERE product_number IS NOT NULL GROUP BY product_number"""


@query("a08_group_concat", O.compose(_HISTORY_SQL, "prod_merged"))
def a08(spark, sf):
    return quality.version_history(_ctx(spark, sf).product_dim_merged)


_YDIM = ("SELECT -1 AS YEAR_KEY, 9999 AS YEAR UNION ALL SELECT DISTINCT year, year FROM cal "
         "WHERE year IS NOT NULL AND year <> -1")


def _dup_sql(name, src, keys):
    k = ", ".join(keys)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in keys)
    return (f"SELECT '{name}' AS table_name, count(*) AS duplicate_groups FROM "
            f"(SELECT {k} FROM {src} WHERE {nn} GROUP BY {k} HAVING count(*) > 1)")


@query("a09_primary_key_unique", O.compose(" UNION ALL ".join([
    _dup_sql("gold_actual_sales_agg_fact", "agg", ["country_region", "brand", "year"]),
    _dup_sql("gold_forecast", "forecast", ["country_region", "brand", "year"]),
    _dup_sql("gold_dim_year", f"({_YDIM})", ["YEAR_KEY"]),
    _dup_sql("gold_fact_sales", "fact", ["transaction_key"]),
]), "agg", "forecast", "cal", "fact"))
def a09(spark, sf):
    ctx = _ctx(spark, sf)
    checks = [
        ("gold_actual_sales_agg_fact", ctx.agg, ["country_region", "brand", "year"]),
        ("gold_forecast", forecast_rows(ctx.forecast_records), ["country_region", "brand", "year"]),
        ("gold_dim_year", dims.year_dimension(ctx.calendar), ["YEAR_KEY"]),
        ("gold_fact_sales", ctx.fact, ["transaction_key"]),
    ]
    return reduce(DataFrame.unionByName, [
        quality.duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("duplicate_groups"))
        .select(F.lit(name).alias("table_name"), "duplicate_groups")
        for name, df, keys in checks])


@query("a10_not_null_year", O.compose(
    f"SELECT count(*) FILTER (WHERE YEAR IS NULL) AS null_rows FROM ({_YDIM})", "cal"))
def a10(spark, sf):
    return quality.null_count(dims.year_dimension(_ctx(spark, sf).calendar), "YEAR")


# ---------------------------------------------------------------- windows / keys
@query("w01_location_row_number", O.compose(
    "SELECT location_key, continent, country_region, city, state FROM loc WHERE location_key > 0",
    "loc"))
def w01(spark, sf):
    return (_ctx(spark, sf).location_dim.filter(F.col("location_key") > 0)
            .select("location_key", "continent", "country_region", "city", "state"))


@query("w02_customer_row_number", O.compose(
    "SELECT customer_key, customer_number, customer_code FROM cust WHERE customer_key > 0", "cust"))
def w02(spark, sf):
    return (_ctx(spark, sf).customer_dim.filter(F.col("customer_key") > 0)
            .select("customer_key", "customer_number", "customer_code"))


@query("w03_assign_keys", O.compose(
    "SELECT count(*) AS rows, CAST(1 AS BIGINT) AS first_key, count(*) AS last_key, count(*) AS keys FROM fact", "fact"))
def w03(spark, sf):
    """Transaction keys are dense; which row has which is left open."""
    k = "transaction_key"
    return _ctx(spark, sf).fact.agg(F.count(F.lit(1)).alias("rows"), F.min(k).alias("first_key"),
                                    F.max(k).alias("last_key"), F.countDistinct(k).alias("keys"))


@query("w04_order_by_year", O.compose(f"SELECT * FROM ({_YDIM}) ORDER BY YEAR", "cal"))
def w04(spark, sf):
    return dims.year_dimension(_ctx(spark, sf).calendar).orderBy("YEAR")


@query("w06_unknown_rows_union", O.compose("""
SELECT 'gold_dim_location' AS dimension, count(*) AS unknown_rows FROM loc WHERE location_key = -1
UNION ALL SELECT 'gold_dim_customer', count(*) FROM cust WHERE customer_key = -1
UNION ALL SELECT 'gold_dim_product', count(*) FROM prod WHERE product_key = -1""",
    "loc", "cust", "prod"))
def w06(spark, sf):
    ctx = _ctx(spark, sf)
    parts = [(n, df.filter(F.col(k) == -1)) for n, df, k in [
        ("gold_dim_location", ctx.location_dim, "location_key"),
        ("gold_dim_customer", ctx.customer_dim, "customer_key"),
        ("gold_dim_product", ctx.product_dim, "product_key")]]
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("unknown_rows")).select(F.lit(n).alias("dimension"),
                                                               "unknown_rows")
        for n, df in parts])


# ---------------------------------------------------------------- scalar functions
@query("f01_punct_to_space", O.compose(
    "SELECT NAME, regexp_replace(NAME, '[,;?()]', ' ', 'g') AS name_f1 FROM raw", "raw"))
def f01(spark, sf):
    r = normalize_columns(_ctx(spark, sf).raw_source)
    return r.select("NAME", ft.punct_to_space("NAME").alias("name_f1"))


@query("f02_strip_whitespace", O.compose(
    "SELECT NAME, trim(regexp_replace(NAME, '[,;?()]', ' ', 'g')) AS name_f2 FROM raw", "raw"))
def f02(spark, sf):
    r = normalize_columns(_ctx(spark, sf).raw_source)
    return r.select("NAME", ft.strip_unicode(ft.punct_to_space("NAME")).alias("name_f2"))


@query("f03_empty_to_not_provided", O.compose(
    "SELECT EDUCATION, CASE WHEN EDUCATION IS NULL OR trim(EDUCATION) = '' THEN 'Not Provided' "
    "ELSE trim(EDUCATION) END AS education_clean FROM raw", "raw"))
def f03(spark, sf):
    r = normalize_columns(_ctx(spark, sf).raw_source)
    return r.select("EDUCATION", ft.clean_text("EDUCATION").alias("education_clean"))


@query("f04_null_to_not_provided", O.compose(
    "SELECT OCCUPATION, coalesce(trim(regexp_replace(OCCUPATION, '[,;?()]', ' ', 'g')), "
    "'Not Provided') AS occupation_clean FROM raw", "raw"))
def f04(spark, sf):
    r = normalize_columns(_ctx(spark, sf).raw_source)
    return r.select("OCCUPATION", ft.clean_text("OCCUPATION").alias("occupation_clean"))


@query("f05_parse_date", O.compose(
    "SELECT ORDERDATE, try_strptime(trim(ORDERDATE), ['%Y-%m-%d', '%Y-%m-%d %H:%M:%S', "
    "'%Y-%m-%dT%H:%M:%S']) AS order_ts FROM raw", "raw"))
def f05(spark, sf):
    r = normalize_columns(_ctx(spark, sf).raw_source)
    return r.select("ORDERDATE", fd.parse_order_date("ORDERDATE").alias("order_ts"))


@query("f06_parse_number", O.compose(
    "SELECT QUANTITY, TRY_CAST(trim(QUANTITY) AS DOUBLE) AS quantity_num, "
    "TRY_CAST(trim(PRODUCTKEY) AS BIGINT) AS product_key_num FROM raw", "raw"))
def f06(spark, sf):
    r = normalize_columns(_ctx(spark, sf).raw_source)
    return r.select("QUANTITY", fn.parse_double("QUANTITY").alias("quantity_num"),
                    fn.parse_long("PRODUCTKEY").alias("product_key_num"))


@query("f07_round_half_even", O.compose(
    "SELECT NET_PRICE_D AS price, CAST(round_even(NET_PRICE_D, 0) AS BIGINT) AS price_rounded "
    "FROM raw", "raw"))
def f07(spark, sf):
    r = normalize_columns(_ctx(spark, sf).raw_source)
    p = fn.parse_double("NET_PRICE")
    return r.select(p.alias("price"), fn.round_half_even_long(p).alias("price_rounded"))


@query("f08_whole_quantity", O.compose(
    "SELECT q AS quantity_num, CASE WHEN q = floor(q) THEN CAST(q AS BIGINT) END AS quantity, "
    "coalesce(q <> floor(q), false) AS is_fractional FROM "
    "(SELECT TRY_CAST(trim(QUANTITY) AS DOUBLE) AS q FROM raw)", "raw"))
def f08(spark, sf):
    r = normalize_columns(_ctx(spark, sf).raw_source)
    q = fn.parse_double("QUANTITY")
    return r.select(q.alias("quantity_num"),
                    F.when(fn.is_whole(q), q.try_cast("bigint")).alias("quantity"),
                    F.coalesce(~fn.is_whole(q), F.lit(False)).alias("is_fractional"))


@query("f09_date_range", O.compose("SELECT date FROM cal", "cal"))
def f09(spark, sf):
    return _ctx(spark, sf).calendar.select("date")


def _silver_dates(spark, sf, *cols):
    return _ctx(spark, sf).silver.select("ORDER_DATE", *cols)


@query("f10_date_key", O.compose(
    "SELECT ORDER_DATE, CAST(strftime(ORDER_DATE, '%Y%m%d') AS INTEGER) AS date_key FROM silver",
    "silver"))
def f10(spark, sf):
    return _silver_dates(spark, sf, fd.date_key("ORDER_DATE").alias("date_key"))


@query("f11_full_date_description", O.compose(
    "SELECT ORDER_DATE, strftime(ORDER_DATE, '%A, %d %B %Y') AS full_date_description FROM silver",
    "silver"))
def f11(spark, sf):
    return _silver_dates(spark, sf,
                         fd.full_date_description("ORDER_DATE").alias("full_date_description"))


@query("f12_date_parts", O.compose(
    "SELECT ORDER_DATE, CAST(day(ORDER_DATE) AS INTEGER) AS day, CAST(month(ORDER_DATE) AS INTEGER) "
    "AS month, CAST(year(ORDER_DATE) AS INTEGER) AS year, CAST(quarter(ORDER_DATE) AS INTEGER) "
    "AS quarter FROM silver", "silver"))
def f12(spark, sf):
    d = F.col("ORDER_DATE")
    return _silver_dates(spark, sf, F.dayofmonth(d).alias("day"), F.month(d).alias("month"),
                         F.year(d).alias("year"), F.quarter(d).alias("quarter"))


@query("f13_iso_week", O.compose(
    "SELECT ORDER_DATE, CAST(weekofyear(ORDER_DATE) AS INTEGER) AS week_number FROM silver",
    "silver"))
def f13(spark, sf):
    return _silver_dates(spark, sf, F.weekofyear("ORDER_DATE").alias("week_number"))


@query("f14_weekday_flag", O.compose(
    "SELECT ORDER_DATE, CASE WHEN isodow(ORDER_DATE) <= 5 THEN 1 ELSE 0 END AS is_weekday "
    "FROM silver", "silver"))
def f14(spark, sf):
    return _silver_dates(spark, sf, fd.is_weekday("ORDER_DATE").alias("is_weekday"))


@query("f15_to_date", O.compose(
    "SELECT ORDER_DATE, CAST(ORDER_DATE AS DATE) AS order_day FROM silver", "silver"))
def f15(spark, sf):
    return _silver_dates(spark, sf, fd.to_day("ORDER_DATE").alias("order_day"))


# ---------------------------------------------------------------- composite operators
@query("c01_clean_sales", O.compose(f"SELECT {_SILVER_CMP_SQL} FROM silver", "silver"))
def c01(spark, sf):
    return _ctx(spark, sf).silver.select(*SILVER_CMP)


@query("c02_date_dimension", O.compose("SELECT * FROM cal", "cal"))
def c02(spark, sf):
    return _ctx(spark, sf).calendar


@query("c03_year_dimension", O.compose(_YDIM, "cal"))
def c03(spark, sf):
    return dims.year_dimension(_ctx(spark, sf).calendar)


@query("c04_location_dimension", O.compose("SELECT * FROM loc", "loc"))
def c04(spark, sf):
    return _ctx(spark, sf).location_dim


@query("c05_customer_dimension", O.compose("SELECT * FROM cust", "cust"))
def c05(spark, sf):
    return _ctx(spark, sf).customer_dim


@query("c05b_customer_type1", O.compose(
    "SELECT count(*) AS customers, count(DISTINCT customer_code) AS codes FROM cust WHERE customer_key <> -1", "cust"))
def c05b(spark, sf):
    """C5, one row per code: as many customers as codes."""
    dim = dims.customer_dimension(_ctx(spark, sf).silver, type1=True).filter(F.col("customer_key") != -1)
    return dim.agg(F.count(F.lit(1)).alias("customers"), F.countDistinct("customer_code").alias("codes"))


@query("c06_product_dimension_initial", O.compose("SELECT * FROM prod", "prod"))
def c06(spark, sf):
    return _ctx(spark, sf).product_dim


@query("c07_scd2_merge", O.compose("SELECT * FROM prod_merged", "prod_merged"))
def c07(spark, sf):
    return _ctx(spark, sf).product_dim_merged


@query("c08_sales_fact", O.compose("SELECT * EXCLUDE (transaction_key) FROM fact", "fact"))
def c08(spark, sf):
    return _ctx(spark, sf).fact.drop("transaction_key")


@query("c09_actual_sales_agg", O.compose("SELECT * FROM agg", "agg"))
def c09(spark, sf):
    return _ctx(spark, sf).agg


@query("c10_forecast_fact", O.compose("SELECT * FROM forecast", "forecast"))
def c10(spark, sf):
    fc = forecast_rows(_ctx(spark, sf).forecast_records)
    quality.assert_unique(fc, ["country_region", "brand", "year"], "gold_forecast")
    return fc


@query("c11_forecast_vs_actual", O.compose("""
SELECT coalesce(a.country_region, f.country_region) AS country_region,
       coalesce(a.brand, f.brand) AS brand, coalesce(a.year, f.year) AS year,
       a.total_actual_sales, f.forecast,
       a.total_actual_sales - f.forecast AS variance,
       CASE WHEN f.forecast = 0 THEN NULL ELSE a.total_actual_sales / f.forecast END AS attainment
FROM agg a FULL OUTER JOIN forecast f
  ON a.country_region IS NOT DISTINCT FROM f.country_region
 AND a.brand IS NOT DISTINCT FROM f.brand AND a.year IS NOT DISTINCT FROM f.year""",
    "agg", "forecast"))
def c11(spark, sf):
    ctx = _ctx(spark, sf)
    return forecast_vs_actual(ctx.agg, forecast_rows(ctx.forecast_records))


@query("c12_date_unknown_row", O.compose(
    "SELECT * FROM cal UNION ALL SELECT 20061231, DATE '2006-01-31', 'Unknown', 31, 12, 2006, "
    "4, 48, 0, 1", "cal"))
def c12(spark, sf):
    a, b = _ctx(spark, sf).order_day_range
    return dims.date_dimension(spark, a, b, unknown=True)


# ---------------------------------------------------------------- reconciliation checks
@query("v01_row_counts", O.compose(
    "SELECT (SELECT count(*) FROM silver) AS silver_rows, (SELECT count(*) FROM fact) AS fact_rows",
    "silver", "fact"))
def v01(spark, sf):
    ctx = _ctx(spark, sf)
    return quality.row_counts(ctx.silver, ctx.fact)


@query("v02_amount_totals", O.compose(
    "SELECT (SELECT sum(CAST(QUANTITY AS DOUBLE) * CAST(NET_PRICE AS DOUBLE)) FROM silver) "
    "AS silver_total, (SELECT sum(total_amount) FROM fact) AS fact_total", "silver", "fact"))
def v02(spark, sf):
    ctx = _ctx(spark, sf)
    return quality.amount_totals(ctx.silver, ctx.fact)


@query("v03_agg_vs_fact_total", O.compose(
    "SELECT (SELECT sum(total_actual_sales) FROM agg) AS agg_total, "
    "(SELECT sum(total_amount) FROM fact) AS fact_total", "agg", "fact"))
def v03(spark, sf):
    ctx = _ctx(spark, sf)
    return quality.agg_total(ctx.agg, ctx.fact)


@query("v04_unknown_date_rows", O.compose(
    "SELECT count(*) FILTER (WHERE date_key = -1) AS unknown_date_rows FROM fact", "fact"))
def v04(spark, sf):
    return quality.unknown_date_rows(_ctx(spark, sf).fact)


_FANOUT = ("SELECT s.PRODUCTKEY, s.ORDER_DATE, {agg} AS match_count" + _LOOKUP_MERGED.format(how="")
           + " GROUP BY s.PRODUCTKEY, s.ORDER_DATE HAVING {agg} > 1")


@query("v05_version_fanout", O.compose(
    _FANOUT.format(agg="count(*)") + " ORDER BY match_count DESC, PRODUCTKEY, ORDER_DATE LIMIT 5",
    "silver", "prod_merged"))
def v05(spark, sf):
    ctx = _ctx(spark, sf)
    return scd2.version_fanout(ctx.silver, ctx.product_dim_merged, as_written=True, limit=5)


@query("v05b_version_fanout_distinct", O.compose(
    _FANOUT.format(agg="count(DISTINCT p.product_key)"), "silver", "prod_merged"))
def v05b(spark, sf):
    ctx = _ctx(spark, sf)
    return scd2.version_fanout(ctx.silver, ctx.product_dim_merged, as_written=False, limit=None)


@query("v06_version_history", O.compose(
    f"SELECT * FROM ({_HISTORY_SQL}) WHERE version_count > 1", "prod_merged"))
def v06(spark, sf):
    return quality.version_history(_ctx(spark, sf).product_dim_merged).filter(
        F.col("version_count") > 1)


@query("v07_table_row_counts", O.compose("""
SELECT 'silver_sales' AS table_name, count(*) AS row_count FROM silver
UNION ALL SELECT 'gold_dim_product', count(*) FROM prod
UNION ALL SELECT 'gold_dim_customer', count(*) FROM cust
UNION ALL SELECT 'gold_dim_location', count(*) FROM loc
UNION ALL SELECT 'gold_dim_date', count(*) FROM ddim
UNION ALL SELECT 'gold_dim_year', count(*) FROM (SELECT -1 UNION ALL SELECT DISTINCT year FROM ddim)""",
    "silver", "prod", "cust", "loc", "ddim"))
def v07(spark, sf):
    ctx = _ctx(spark, sf)
    return quality.table_row_counts({
        "silver_sales": ctx.silver, "gold_dim_product": ctx.product_dim,
        "gold_dim_customer": ctx.customer_dim, "gold_dim_location": ctx.location_dim,
        "gold_dim_date": ctx.date_dim, "gold_dim_year": dims.year_dimension(ctx.date_dim)})


@query("v08_step_metrics", O.compose(
    "SELECT 'silver_sales' AS step, count(*) AS records, 20 AS columns FROM silver", "silver"))
def v08(spark, sf):
    m = quality.StepMetrics()
    import time
    started = time.time()
    observed, obs = m.observed(_ctx(spark, sf).silver, "silver_sales")
    observed.write.parquet(scratch_path(spark, "silver-observed"))
    m.record("silver_sales", obs, len(observed.columns), started)
    return m.to_df(spark).drop("seconds")


@query("v09_reconcile", O.compose("""
SELECT 'silver_vs_fact_rows' AS "check", CAST((SELECT count(*) FROM silver) AS DOUBLE) AS left_value,
       CAST((SELECT count(*) FROM fact) AS DOUBLE) AS right_value,
       (SELECT count(*) FROM silver) = (SELECT count(*) FROM fact) AS ok
UNION ALL SELECT 'silver_vs_fact_amount',
       (SELECT sum(CAST(QUANTITY AS DOUBLE) * CAST(NET_PRICE AS DOUBLE)) FROM silver),
       (SELECT sum(total_amount) FROM fact),
       (SELECT sum(CAST(QUANTITY AS DOUBLE) * CAST(NET_PRICE AS DOUBLE)) FROM silver)
         IS NOT DISTINCT FROM (SELECT sum(total_amount) FROM fact)
UNION ALL SELECT 'fact_vs_agg_amount', (SELECT sum(total_amount) FROM fact),
       (SELECT sum(total_actual_sales) FROM agg),
       (SELECT sum(total_amount) FROM fact) IS NOT DISTINCT FROM (SELECT sum(total_actual_sales) FROM agg)
UNION ALL SELECT 'unknown_date_rows', CAST((SELECT count(*) FROM fact WHERE date_key = -1) AS DOUBLE),
       0.0, (SELECT count(*) FROM fact WHERE date_key = -1) = 0""", "silver", "fact", "agg"))
def v09(spark, sf):
    ctx = _ctx(spark, sf)
    return quality.reconcile(ctx.silver, ctx.fact, ctx.agg)


from starloom.plans import catalog_loads  # noqa: E402, F401  registers the queries of loads
