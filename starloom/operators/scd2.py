"""SCD type 2 on the product dimension: the merge (C7) and the validity
lookups (J4 left, J5 inner).

Validity is half-open, ``[change_begin_date, change_end_date)``: a sale on
the end day belongs to the next version.  Open versions end on 9999-12-31,
so the lookup is a plain equi-join on the product number with the two date
bounds as a residual condition (hash or sort-merge join on the key, with
AQE splitting a hot product's partition).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.dims import (
    FALLBACK_BEGIN_DATE, OPEN_END_DATE, PRODUCT_ATTRS, product_versions,
)
from starloom.operators.keys import assign_keys
from starloom.schemas import DIM_PRODUCT
from starloom.session import scratch_path

VALUE_COLS = [*PRODUCT_ATTRS, "unit_price"]

#: Product days of one task of the fan-out check, at most one a line, whatever their number.
DAYS_PER_TASK = 250_000


def _in_version(order_date: Column) -> Column:
    return ((order_date >= F.col("change_begin_date"))
            & (order_date < F.col("change_end_date")))


def versions_for_lookup(dim: DataFrame) -> DataFrame:
    return (dim.filter(F.col("product_number").isNotNull())
            .select("product_key", "product_number", "change_begin_date", "change_end_date"))


def scd2_lookup(sales: DataFrame, dim: DataFrame, key_col: str = "PRODUCTKEY",
                date_col: str = "ORDER_DATE", how: str = "left") -> DataFrame:
    """J4 (``how='left'``) / J5 (``how='inner'``): attach ``product_key`` of
    the version valid on the order date.  Left: no valid version -> -1."""
    v = versions_for_lookup(dim)
    cond = (F.col(key_col) == F.col("product_number")) & _in_version(F.col(date_col))
    out = sales.join(v, cond, how).drop("product_number", "change_begin_date",
                                         "change_end_date")
    if how == "left":
        out = out.withColumn("product_key", F.coalesce(F.col("product_key"), F.lit(-1).cast("long")))
    return out


def latest_version_per_product(incoming: DataFrame) -> DataFrame:
    """Q14 + Q16: reduce a batch to one row per product number: MAX(price)
    per attribute set, then the set seen on the latest order (ties: the
    greatest set)."""
    return latest_of(product_versions(incoming))


def latest_of(versions: DataFrame) -> DataFrame:
    """One row per product of its ``product_versions`` (Q16)."""
    pick = F.struct(*VALUE_COLS)
    rank = F.struct("last_order_date", *VALUE_COLS)
    return (versions.groupBy("product_number")
            .agg(F.max_by(pick, rank).alias("v"))
            .select("product_number", *[F.col(f"v.{c}").alias(c) for c in VALUE_COLS]))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _as_date_col(d):
    if d is None:
        return F.current_date()
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)))


def scd2_merge_versions(dim: DataFrame, src: DataFrame, effective_date, first_day, *,
                        key: str, values: list[str], surrogate: str,
                        unknown_key: int = -1, next_key: int | None = None) -> DataFrame:
    """C7 core for any SCD2 dimension laid out as (surrogate, key, *values,
    change_begin_date, change_end_date, is_current), given ``src`` with one
    row per business key (key, *values).  Returns the whole new snapshot.

    - only current versions are compared and closed (Q12), NULL-safely (Q15);
    - every current version that differs from its source is closed on
      ``effective_date``; if none equals it, a new version begins there;
    - no version ends before it begins: an ``effective_date`` ahead of a
      key's current versions gives way to the last of their begin dates;
    - a key new to the dimension starts on ``first_day``;
    - keys absent from ``src`` stay as they are (nothing is deleted);
    - NULL keys and the unknown member are left untouched;
    - new surrogates continue after the highest existing one (or begin at
      ``next_key``), in (key, *values) order.
    Merging the same source twice changes nothing.
    """
    eff = _as_date_col(effective_date)
    layout = [surrogate, key, *values, "change_begin_date", "change_end_date", "is_current"]
    is_cur = F.coalesce((F.col("is_current") == 1) & (F.col(surrogate) != unknown_key)
                        & F.col(key).isNotNull(), F.lit(False))
    cur = dim.filter(is_cur)
    hist = dim.filter(~is_cur)

    s = src.filter(F.col(key).isNotNull()).select(
        key, *[F.col(c).alias(f"s_{c}") for c in values], F.lit(True).alias("_src"))
    joined = cur.join(s, key, "full_outer")
    equal = reduce(lambda a, b: a & b, [_same(c, f"s_{c}") for c in values])
    # at most a few rows per key meet here (current versions x one source row)
    per_key = Window.partitionBy(key)
    joined = (joined
              .withColumn("_has_cur", F.col(surrogate).isNotNull())
              .withColumn("_has_src", F.coalesce(F.col("_src"), F.lit(False)))
              .withColumn("_eq", F.coalesce(equal & F.col("_has_cur"), F.lit(False)))
              .withColumn("_any_eq", F.max(F.col("_eq").cast("int")).over(per_key) == 1)
              .withColumn("_from", F.greatest(eff, F.max("change_begin_date").over(per_key))))

    closes = F.col("_has_cur") & F.col("_has_src") & ~F.col("_eq")
    kept = joined.filter(F.col("_has_cur")).select(
        surrogate, key, *values, "change_begin_date",
        F.when(closes, F.col("_from")).otherwise(F.col("change_end_date")).alias("change_end_date"),
        F.when(closes, F.lit(0)).otherwise(F.col("is_current")).alias("is_current"),
    )

    new_rows = joined.filter(F.col("_has_src") & ~F.col("_any_eq")).select(
        key, *[F.col(f"s_{c}").alias(c) for c in values], "_has_cur", "_from",
    ).dropDuplicates([key])
    if next_key is None:
        next_key = max(dim.agg(F.max(surrogate).alias("m")).first()["m"] or 0, 0) + 1
    keyed = assign_keys(new_rows, [key, *values], surrogate, start=next_key)
    inserted = keyed.select(
        surrogate, key, *values,
        F.when(F.col("_has_cur"), F.col("_from")).otherwise(_as_date_col(first_day))
        .alias("change_begin_date"),
        F.lit(dt.date.fromisoformat(OPEN_END_DATE)).alias("change_end_date"),
        F.lit(1).alias("is_current"),
    )
    return hist.select(*layout).unionByName(kept.select(*layout)) \
        .unionByName(inserted.select(*layout))


def scd2_merge(dim: DataFrame, incoming: DataFrame, effective_date=None) -> DataFrame:
    """C7 for the product dimension: reduce a silver batch to one row per
    product (Q14, Q16) and merge it with ``scd2_merge_versions``; products
    new to the dimension begin on the batch's first order day (Q13).

    The batch is read once: it is reduced to one row per product and
    attribute set, with first and last order day, and that is staged."""
    spark, path = incoming.sparkSession, scratch_path(incoming.sparkSession, "scd2-source")
    product_versions(incoming, keep_null=True).write.parquet(path)
    versions = spark.read.parquet(path)
    first = versions.agg(F.min(F.to_date("first_order_date")).alias("d")).first()["d"]
    return scd2_merge_versions(
        dim, latest_of(versions.filter(F.col("product_number").isNotNull())), effective_date,
        first or dt.date.fromisoformat(FALLBACK_BEGIN_DATE), key="product_number", values=VALUE_COLS,
        surrogate="product_key").select(*DIM_PRODUCT.fieldNames())


def version_fanout(silver: DataFrame, dim: DataFrame, as_written: bool = True,
                   limit: int | None = 5) -> DataFrame:
    """V5: (product, order date) groups that meet several versions.

    ``as_written=True`` counts matching pairs, as the reference does, so two
    sales of one product on one day are reported too (Q19);
    ``as_written=False`` counts distinct versions.  Ordered for a stable top."""
    # sales meet the versions as one row per product and day, so a hot product is small
    days = silver.filter(F.col("PRODUCTKEY").isNotNull()).groupBy("PRODUCTKEY", "ORDER_DATE") \
        .agg(F.count(F.lit(1)).alias("_sales"))
    tasks = silver.count() // DAYS_PER_TASK
    if tasks > 1:  # a number that is given is not merged into fewer, larger tasks
        days = days.repartition(tasks, "PRODUCTKEY")
    m = scd2_lookup(days, dim, how="inner")
    matches = F.sum("_sales") if as_written else F.countDistinct("product_key")
    out = m.groupBy("PRODUCTKEY", "ORDER_DATE").agg(matches.alias("match_count")) \
        .filter(F.col("match_count") > 1)
    if limit is None:
        return out
    return out.orderBy(F.col("match_count").desc(), "PRODUCTKEY", "ORDER_DATE").limit(limit)


def _current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.coalesce((F.col("is_current") == 1) & (F.col("product_key") != -1)
                                 & F.col("product_number").isNotNull(), F.lit(False)))


def classify_incoming(dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """Each incoming product (reduced to one row) against the current
    versions: ``new`` (no current version), ``changed`` or ``unchanged``.
    The ``is_current`` filter sits on the build side of the left join."""
    src = latest_version_per_product(incoming)
    cur = _current(dim).select("product_number", *[F.col(c).alias(f"c_{c}") for c in VALUE_COLS],
                               F.lit(True).alias("_cur"))
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in VALUE_COLS])
    return src.join(cur, "product_number", "left").select(
        "product_number",
        F.when(F.col("_cur").isNull(), "new").when(equal, "unchanged").otherwise("changed")
        .alias("status"))


def changed_products(dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """Products whose current version differs (NULL-safe) from the
    incoming one, with what changed."""
    src = latest_version_per_product(incoming)
    cur = _current(dim).select("product_number", *[F.col(c).alias(f"c_{c}") for c in VALUE_COLS])
    attrs_equal = reduce(lambda a, b: a & b,
                         [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in PRODUCT_ATTRS])
    price_equal = F.col("unit_price").eqNullSafe(F.col("c_unit_price"))
    return (src.join(cur, "product_number")
            .filter(~(attrs_equal & price_equal))
            .select("product_number", (~price_equal).alias("unit_price_changed"),
                    (~attrs_equal).alias("attributes_changed")))


def versions_of_changed(dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """Dimension rows of the products that changed (semi-join)."""
    return dim.join(changed_products(dim, incoming).select("product_number"),
                    "product_number", "left_semi")
