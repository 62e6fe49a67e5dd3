"""Operators of loads that touch only what arrived: a registry of surrogate
keys, records seen before, late members, copy-on-write product versions and
mergeable marks.  ``starloom.plans.incremental`` puts them together.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.dims import FALLBACK_BEGIN_DATE, product_versions
from starloom.operators.facts import BROADCAST_MAX_ROWS
from starloom.operators.keys import assign_keys, broadcast_if_bounded, fits
from starloom.operators.quality import exact_sum
from starloom.operators.scd2 import VALUE_COLS, latest_of, scd2_merge_versions
from starloom.schemas import BRONZE_BUSINESS_COLUMNS
from starloom.session import CODEC, scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- key registry (W1-W3 over loads) ------------------------------------------

def _as_old(df: DataFrame, cols: list[str]) -> tuple[DataFrame, Column]:
    """``df`` as one struct ``_old`` of ``cols``, and the NULL-safe test that it
    equals the columns of the other side (one test: the optimizer derives
    constraints from each of many equalities, and their number explodes)."""
    return df.select(F.struct(*cols).alias("_old")), F.struct(*cols).eqNullSafe(F.col("_old"))


def new_members(registry: DataFrame, members: DataFrame, business: list[str], surrogate: str, start: int) -> DataFrame:
    """Members that the registry doesn't hold, with keys ``start``, ``start`` + 1,
    ... in the order of the business key.  Keys given before neither move nor
    come again, whatever sorts ahead of them; NULL parts compare equal."""
    known, same = _as_old(registry.select(*business), business)
    unknown = members.select(*business).distinct().join(known, same, "left_anti")
    return assign_keys(unknown, business, surrogate, start=start).select(surrogate, *business)


# -- records seen before (A1 over loads) --------------------------------------

#: Bits of the filter over a batch's record hashes, 64 in a row: 524,288 rows whatever the batch.
FILTER_BITS = 1 << 25


def record_hash(columns: list[str] = BRONZE_BUSINESS_COLUMNS) -> Column:
    """Hash of a record's business columns; a NULL differs from any text."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def record_digest(columns: list[str] = BRONZE_BUSINESS_COLUMNS) -> Column:
    """SHA-256 of a record's business columns, each by its length and text (a
    NULL by a mark of its own): 32 bytes that stand for the record's hundreds."""
    parts = [F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("n")) for c in columns]
    # never NULL, and declared so: a join's test for NULL would make it twice
    return F.coalesce(F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256)), F.lit(b""))


def maybe_in(keys: DataFrame, column: str, rows: DataFrame) -> DataFrame:
    """Rows whose long ``column`` may be among ``keys``: all that are and few
    others.  The filter is a bitmap of fixed size that is broadcast; with many
    more keys than bits it lets all pass."""
    return _met(keys, column, rows, "inner").filter("_met").select(*rows.columns)


def _met(keys: DataFrame, column: str, rows: DataFrame, how: str) -> DataFrame:
    """``rows`` with ``_met``: true of all whose ``column`` is among ``keys`` and of few others."""
    slot = F.pmod(F.col(column), F.lit(FILTER_BITS))
    words = keys.select(slot.alias("_s")).groupBy(F.shiftright("_s", 6).alias("_w")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_s % 64 as int))")).alias("_bits"))
    met = rows.withColumn("_s", slot).withColumn("_w", F.shiftright("_s", 6)).join(F.broadcast(words), "_w", how)
    return met.withColumn("_met", F.coalesce(F.expr("shiftright(_bits, cast(_s % 64 as int)) & 1L") == 1, F.lit(False)))


def distinct_records(records: DataFrame, columns: list[str] = BRONZE_BUSINESS_COLUMNS) -> DataFrame:
    """A1 with the record's hash as ``h``: one row per distinct record.  Hashes
    alone are exchanged first; a record whose hash comes once stays where it
    lies, and only those that may come again are moved and compared whole."""
    hashed = records.withColumn("h", record_hash(columns))
    again = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("h")
    marked = _met(again, "h", hashed, "left")
    repeated = marked.filter("_met").select(*hashed.columns).dropDuplicates(columns)
    return marked.filter(~F.col("_met")).select(*hashed.columns).unionByName(repeated)


def unseen_records(records: DataFrame, seen: DataFrame, past, columns: list[str] = BRONZE_BUSINESS_COLUMNS) -> DataFrame:
    """A1 over loads: one row per distinct record of the batch that no earlier
    batch held, with its hash as ``h``.

    ``seen`` has (h, batch) of all past records; ``past(batches)`` reads their
    records.  The hashes of the past are thinned by a bitmap of the batch's
    before they meet it, and only the batches in which hashes agree are read,
    to compare the records' digests; a batch of new records reads none.  Whole
    records are moved once, those that were not seen before: hashes and
    digests alone tell which these are, and only digests meet.  ``records`` is read several times, so
    a view that is dear to make should be staged."""
    if seen.isEmpty():
        return distinct_records(records, columns)
    mine = stage(records.select(record_hash(columns).alias("h")), "hashes")
    hits = stage(maybe_in(mine, "h", seen.select("h", "batch")).join(mine, "h", "left_semi").distinct(), "hits")
    batches = [r[0] for r in hits.select("batch").distinct().collect()]  # names of loads
    if not batches:
        return distinct_records(records, columns)
    digest = record_digest(columns).alias("_d")
    old = past(batches)
    keys = hits.select("h")  # once a batch that holds it
    if fits(keys, BROADCAST_MAX_ROWS):  # else thinning would cost the shuffle that it saves
        old = old.withColumn("h", record_hash(columns)).join(F.broadcast(keys), "h", "left_semi")
    old = old.select(digest)
    named = records.select("*", record_hash(columns).alias("h"), digest)
    new = stage(named.select("_d").join(old, "_d", "left_anti").distinct(), "unseen")
    if new.isEmpty():
        return records.withColumn("h", record_hash(columns)).filter(F.lit(False))
    # one row of a record that arrived several times, with its whole row
    return named.join(broadcast_if_bounded(new, BROADCAST_MAX_ROWS), "_d", "left_semi") \
        .dropDuplicates(columns).select(*records.columns, "h")


# -- late members (J1-J4, P5 over loads) --------------------------------------

def is_late() -> Column:
    """A looked-up sale that names a product, customer or location without a
    member: the member may still arrive.  (An order day outside the calendar
    is settled as -1, and so is a sale that names none.)"""
    place = F.coalesce("CONTINENT", "COUNTRY_REGION", "CITY", "STATE")
    pairs = (("product_key", F.col("PRODUCTKEY")), ("customer_key", F.col("CUSTOMER_CODE")), ("location_key", place))
    return reduce(lambda a, b: a | b, [(F.col(k) == -1) & name.isNotNull() for k, name in pairs])


def first_of_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` in which all but one row of a key lose it: a sale that now
    meets several members keeps its key once, the others get new ones."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_nth", F.when(F.col(key).isNotNull(), place).otherwise(0)) \
        .withColumn(key, F.when(F.col("_nth") == 1, F.col(key))).drop("_nth")


# -- copy-on-write product versions (C7) --------------------------------------

def product_bucket(buckets: int, number: str = "product_number") -> Column:
    return F.coalesce(F.pmod(F.xxhash64(F.col(number)), F.lit(buckets)), F.lit(0)).cast("int")


def changed_sources(landed: DataFrame, current: DataFrame, buckets: int,
                    broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, dt.date]:
    """The landed products (one row each, Q14, Q16) that are new or differ from
    a current version, with their bucket, and the batch's first order day.
    The dimension isn't shuffled while the landed products fit a broadcast."""
    versions = stage(product_versions(landed, keep_null=True), "product-versions")
    first = versions.agg(F.min(F.to_date("first_order_date")).alias("d")).first()["d"] \
        or dt.date.fromisoformat(FALLBACK_BEGIN_DATE)
    src = stage(latest_of(versions.filter(F.col("product_number").isNotNull())), "product-source")
    named = src.select("product_number", *[F.col(c).alias(f"s_{c}") for c in VALUE_COLS])
    now = current.filter((F.col("is_current") == 1) & (F.col("product_key") != -1))
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in VALUE_COLS])
    same = now.join(broadcast_if_bounded(named, broadcast_max_rows), "product_number") \
        .groupBy("product_number").agg(F.min(equal.cast("int")).alias("same")).filter("same = 1")
    changed = src.join(same.select("product_number"), "product_number", "left_anti")
    return stage(changed.withColumn("bucket", product_bucket(buckets)), "product-changes"), first


def merge_buckets(part: DataFrame, changed: DataFrame, effective_date, first_day, next_key: int,
                  broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """C7 on the buckets that hold a changed product: ``part`` are their rows.
    Rows of other products pass by a broadcast join; only versions of changed
    products take part in the merge."""
    keys = broadcast_if_bounded(changed.select("product_number"), broadcast_max_rows)
    mine = part.join(keys, "product_number", "left_semi")
    merged = scd2_merge_versions(mine, changed.drop("bucket"), effective_date, first_day, key="product_number",
                                 values=VALUE_COLS, surrogate="product_key", next_key=next_key)
    return part.join(keys, "product_number", "left_anti").select(*merged.columns).unionByName(merged)


# -- mergeable marks (V1-V4) ---------------------------------------------------

def _marks(quantity: str, price: str, amount: Column) -> list[Column]:
    one = F.xxhash64(F.col(quantity).cast("long"), F.col(price).cast("double"))
    return [F.count(F.lit(1)).cast("decimal(38,0)").alias("lines"),
            F.coalesce(exact_sum(amount), F.lit(0)).cast("decimal(38,0)").alias("amount"),
            F.coalesce(F.sum(one.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("line_hash")]


def mark(lines: DataFrame, quantity: str, price: str, amount: Column) -> DataFrame:
    """One row (lines, amount, line_hash) of some sales lines: their number, an
    exact sum and a hash that no order changes.  Marks of parts add up to
    that of the whole, and one altered line changes it."""
    return lines.agg(*_marks(quantity, price, amount))


def mark_by(lines: DataFrame, by: str, quantity: str, price: str, amount: Column) -> DataFrame:
    """``mark`` for each value of a column."""
    return lines.groupBy(by).agg(*_marks(quantity, price, amount))


# -- primary keys without a shuffle of them (A9) -------------------------------

#: Keys of one bitmap: 2 to this.
BITMAP_BITS = 15
#: Keys per row below which a key counts as dense.
SPARSE = 64


def key_ranges(df: DataFrame, key: str) -> DataFrame | None:
    """(range, rows, keys) for each range of 32,768 values (``range`` * 32,768 on) of a dense
    whole-number key; more rows than keys mean duplicates.  ``None`` for a key
    that is not dense (by its minimum, maximum and count).

    Tasks build a bitmap for each range, and these are joined by ``or``: about
    one bit per key is exchanged, and never the key."""
    rows = df.select(F.col(key).cast("long").alias(key)).filter(F.col(key).isNotNull())
    lo, hi, n = rows.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    if n and hi - lo > SPARSE * n:
        return None
    return rows.groupBy(F.shiftright(key, BITMAP_BITS).alias("range")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bitmap_count(F.bitmap_construct_agg(F.col(key).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)))).alias("keys"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """A9 as one row: ``repeats``, rows beyond the first of their key."""
    ranges = key_ranges(df, key)
    if ranges is None:
        ranges = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows")).withColumn("keys", F.lit(1))
    return ranges.agg(F.coalesce(F.sum(F.col("rows") - F.col("keys")), F.lit(0)).cast("long").alias("repeats"))


def duplicate_dense_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, rows) of the keys that occur more than once; only rows of
    ranges that hold a duplicate are grouped by key."""
    ranges = key_ranges(df, key)
    rows = df.select(F.col(key).cast("long").alias(key)).filter(F.col(key).isNotNull())
    if ranges is not None:
        bad = stage(ranges.filter("keys < rows").select("range"), "key-ranges")
        rows = rows.withColumn("range", F.shiftright(key, BITMAP_BITS)).join(broadcast_if_bounded(bad, BROADCAST_MAX_ROWS), "range", "left_semi")
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


# -- interval join by time bins (J4, J5) ----------------------------------------

def binned_lookup(sales: DataFrame, dim: DataFrame, key_col: str = "PRODUCTKEY", date_col: str = "ORDER_DATE",
                  how: str = "left", bin_days: int = 90, broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """J4 / J5 for products of many versions: as ``scd2.scd2_lookup``, but
    validity is cut into bins of ``bin_days`` and the join is on (product,
    bin), so a sale meets the versions of its bin instead of all versions of
    its product, and a hot product is spread over its bins.

    Versions are clipped to the days that the sales span (one scalar pass), so
    open ends make no endless bins.  The planner's estimate of the versions
    leaves out that each becomes a row for every bin, so it is not asked: they
    are broadcast if their rows, counted bin by bin, are bounded, and otherwise both
    sides are dealt out by (product, bin) and merged."""
    epoch = dt.date(1970, 1, 1)
    lo, hi = sales.agg(F.min(F.to_date(date_col)), F.max(F.to_date(date_col))).first()
    v = dim.filter(F.col("product_number").isNotNull()) \
        .select(F.col("product_key").alias("_key"), F.col("product_number").alias("_number"),
                F.col("change_begin_date").alias("_begin"), F.col("change_end_date").alias("_end"))

    def bin_of(day: Column) -> Column:
        return F.floor(F.datediff(day, F.lit(epoch)) / F.lit(bin_days)).cast("int")

    if lo is None:  # no dates: no sale meets a version
        v = v.filter(F.lit(False)).withColumn("_bin", F.lit(0))
    else:
        v = v.filter((F.col("_begin") <= F.lit(hi)) & (F.col("_end") > F.lit(lo)) & (F.col("_begin") < F.col("_end"))) \
            .withColumn("_bin", F.explode(F.sequence(bin_of(F.greatest("_begin", F.lit(lo))), bin_of(F.least(F.date_sub("_end", 1), F.lit(hi))))))
    v = F.broadcast(v) if fits(v, broadcast_max_rows) else v.hint("merge")
    placed = sales.withColumn("_day_bin", bin_of(F.to_date(date_col)))
    met = placed.join(v, (F.col(key_col) == F.col("_number")) & (F.col("_day_bin") == F.col("_bin"))
                      & (F.col(date_col) >= F.col("_begin")) & (F.col(date_col) < F.col("_end")), how)
    found = F.coalesce(F.col("_key"), F.lit(-1).cast("long")) if how == "left" else F.col("_key")
    return met.select(*sales.columns, found.alias("product_key"))
