"""Raw sales records derived from the driver's TPC-H-like tables.

The reference's input files are not published, so raw sales are a view
over lineitem / orders / customer / nation / region / part, shaped like the
source JSON (source-style column names, every value as text).  Built only
from joins and projections, it scales with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.keys import broadcast_if_bounded, fits

#: Lines of one task of the joins, whatever the size of the tables.
LINES_PER_TASK = 250_000
#: Lines from which the joins are dealt out by that number; fewer are left to the planner.
LARGE = 1_000_000

# Fixed values of the raw-record layout: source field names in source order.
SOURCE_NAMES = [
    "ProductKey", "Product Name", "Brand", "Color", "Subcategory", "Category",
    "CustomerKey", "Customer Code", "Name", "Education", "Occupation",
    "Continent", "City", "State", "CountryRegion", "OrderDate", "Quantity",
    "Net-Price",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_sales_records(spark: SparkSession, sf_dir: str, duplicate_every: int = 20,
                      retail_price_every: int = 3) -> DataFrame:
    """One raw record per lineitem, plus a second copy of every line whose
    order key is a multiple of ``duplicate_every`` (exact duplicates for the
    dedup step; 0 disables).  Parts whose key is a multiple of
    ``retail_price_every`` sell at the list price so they have one price
    (0 disables)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    # A file stored as one row group scans as one task, and every join and
    # text conversion below would then run in that task.  Only when the scan
    # has fewer partitions than the cluster has cores, spread it by the next
    # join key (a deterministic hash, safe to recompute).
    lines = li.count()  # from the files' footers
    target = max(spark.sparkContext.defaultParallelism * 2, -(-lines // LINES_PER_TASK))
    stored = li
    if lines >= LARGE or li.rdd.getNumPartitions() < target:
        li = li.repartition(target, "l_orderkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    rg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    pa = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")

    # nation and region are small reference tables; broadcast after a size check
    geo = na.join(broadcast_if_bounded(rg, 100_000), na.n_regionkey == rg.r_regionkey)
    # many lines get their nation after the shuffle by product, which then carries no names of places
    later = lines >= LARGE and fits(geo, 100_000)
    cust = cu if later else cu.join(broadcast_if_bounded(geo, 100_000), cu.c_nationkey == geo.n_nationkey)
    li = li.withColumn("_product", F.col("l_partkey").cast("string"))
    pa = pa.withColumn("_part", F.col("p_partkey").cast("string"))
    if lines < LARGE:
        j = (li.join(od, li.l_orderkey == od.o_orderkey)
             .join(cust, od.o_custkey == cust.c_custkey))
    else:
        # an order meets its customer once, not with each of its lines; every
        # join builds tables of its smaller side's share, so no line is sorted
        oc = od.join(cust.hint("shuffle_hash"), od.o_custkey == cust.c_custkey).repartition(target, "o_orderkey")
        j = li.join(oc.hint("shuffle_hash"), li.l_orderkey == oc.o_orderkey)
        # counted where the lines are stored: only counts are exchanged
        most = stored.groupBy("l_partkey").count().agg(F.max("count")).first()[0] or 0
        if most <= 4 * LINES_PER_TASK:
            # dealt by the product's text, records that are equal lie together:
            # de-duplication finds them without another shuffle.  (A product
            # with more lines than tasks hold is left to the skew join.)
            j, pa = j.repartition(target, "_product"), pa.hint("shuffle_hash")
    j = j.join(pa, F.col("_product") == F.col("_part"))
    if later:
        j = j.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))

    k = F.col("c_custkey")
    if retail_price_every:
        unit = F.when(F.col("p_partkey") % retail_price_every == 0, F.col("p_retailprice")) \
            .otherwise(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")))
    else:
        unit = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    values = [
        F.col("_product"),
        F.col("p_name"),
        F.col("p_brand"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)),
        F.col("p_type"),
        F.when(F.col("p_size") <= 16, "Small").when(F.col("p_size") <= 33, "Medium")
        .otherwise("Large"),
        k.cast("string"),
        F.col("c_name"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(", ("), F.col("c_mktsegment"), F.lit(");")),
        F.when(k % 7 == 0, F.lit("  ")).when(k % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
        .when(F.col("c_acctbal") < 5000, "Manual?").otherwise("Professional"),
        F.col("r_name"),
        F.concat(F.col("n_name"), F.lit("_C"), (k % 10).cast("string")),
        F.concat(F.col("n_name"), F.lit("_S"), (k % 5).cast("string")),
        F.col("n_name"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd"),
        F.col("l_quantity").cast("string"),
        unit.cast("string"),
    ]
    rows = j.select(*[v.alias(n) for v, n in zip(values, SOURCE_NAMES)], "l_orderkey")
    if duplicate_every:
        # one pass over the joins: lines of every n-th order are emitted twice
        copies = F.when(F.col("l_orderkey") % duplicate_every == 0, F.array(F.lit(1), F.lit(2))) \
            .otherwise(F.array(F.lit(1)))
        rows = rows.withColumn("_copy", F.explode(copies)).drop("_copy")
    return rows.drop("l_orderkey")


def split_by_order_date(raw: DataFrame, cut: str, date_col: str = "OrderDate"):
    """Two load batches: orders before ``cut`` and from ``cut`` on (text
    comparison of ISO dates).  Rows with a missing date go to the first."""
    first = raw.filter(F.coalesce(F.col(date_col) < F.lit(cut), F.lit(True)))
    second = raw.filter(F.col(date_col) >= F.lit(cut))
    return first, second
