"""The warehouse fed load by load: each call reads what arrived and what it
changes, and nothing else of what earlier loads wrote.

- **Ledger.** Every load ends with one row of the table ``ledger``: its place in
  the order, the highest key of each table, and marks of its lines.  Readers
  only see loads with such a row, so a load that fails leaves nothing behind
  that anyone reads, and its name can be tried again.
- **Records** (A1): a record that any earlier load held is dropped (``unseen_records``).
- **Locations, customers** (C4, C5, W1-W3): registries that only grow; keys
  continue after the ledger's highest, so no key moves or comes again.
- **Products** (C7): versions in buckets by product number.  A load writes the
  buckets in which a version begins or ends, as new files; the current state
  of a bucket is its newest files.
- **Sales** (C8): only the landed lines are looked up and numbered; they are
  written in folders by order year.  A filter on ``order_year`` opens those
  years alone.
- **Late members** (P5): lines at -1 whose product, customer or location may
  still arrive wait in ``late_sales`` with their business keys and are looked
  up again by every load; a line that finds its members moves to the fact with
  its key.
- **Aggregate** (C9): exact sums per load add up; lines that wait are summed
  when it is read.
- **Marks** (V1-V4): lines, amount and an order-free hash of the lines of each
  load, from silver and from the fact; ``reconcile`` reads one load.

``reload_year`` looks a year's lines up again against today's dimensions and
writes that year once; its older files are no longer read.  Facts keep the
product version that was valid when they were loaded until then.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators import dims, incremental, quality
from starloom.operators.facts import SALES_COLUMNS, look_up_sales, sales_sums
from starloom.operators.keys import literal_row, number_rows, with_unknown_member
from starloom.operators.silver import clean_distinct, clean_sales, clean_sales_split
from starloom.schemas import (
    BRONZE, DIM_CUSTOMER, DIM_LOCATION, DIM_PRODUCT, FACT_SALES, SILVER,
)
from starloom.session import scratch_scope
from starloom.sources.bronze import normalize_columns, stamp_ingestion
from starloom.sources.partitioned import PartitionedTable

YEAR = "order_year"
LOCATION_KEY = ["CONTINENT", "COUNTRY_REGION", "CITY", "STATE"]
CUSTOMER_KEY = ["CUSTOMER_KEY", "CUSTOMER_CODE", "NAME", "EDUCATION", "OCCUPATION"]
KEYS = ("transaction_key", "product_key", "customer_key", "location_key")
MARKS = ("lines", "amount", "line_hash")


def _fields(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([schema[n] for n in (names or schema.fieldNames())])


_SALES = T.StructType([SILVER[c] for c in SALES_COLUMNS])
_NAMES = [c for c in SALES_COLUMNS if c not in ("QUANTITY", "NET_PRICE")]
_LEDGER = T.StructType([T.StructField("seq", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("year", T.IntegerType()),
                        T.StructField("state", T.StringType())])
_PART = T.StructType([T.StructField("country_region", T.StringType()), T.StructField("brand", T.StringType()),
                      T.StructField("year", T.IntegerType()), T.StructField("amount", T.DecimalType(38, 0))])


def order_year(date) -> Column:
    """Partition of an order: its year, 0 without a date."""
    return F.coalesce(F.year(date), F.lit(0)).cast("int")


class IncrementalWarehouse:
    def __init__(self, spark: SparkSession, root: str, date_start=dims.REFERENCE_DATE_START, date_end=dims.REFERENCE_DATE_END,
                 product_buckets: int = 64):
        self.spark, self.buckets = spark, product_buckets
        self.dates = dims.date_dimension(spark, date_start, date_end)

        def table(name: str, schema: T.StructType, by: str | None = None) -> PartitionedTable:
            return PartitionedTable(spark, root, name, schema, by)

        self.ledger = table("ledger", _LEDGER)
        self.bronze = table("bronze_sales", BRONZE)
        self.seen = table("seen_sales", T.StructType([T.StructField("h", T.LongType())]))
        self.silver = table("silver_sales", SILVER, YEAR)
        self.rejects = table("dead_letter_sales", T.StructType([*BRONZE, T.StructField("reject_reason", T.StringType())]))
        self.locations = table("gold_dim_location", _fields(DIM_LOCATION))
        self.customers = table("gold_dim_customer", _fields(DIM_CUSTOMER))
        self.products = table("gold_dim_product", DIM_PRODUCT, "bucket")
        self.facts = table("gold_fact_sales", FACT_SALES, YEAR)
        self.late = table("late_sales", T.StructType([FACT_SALES["transaction_key"], *_SALES, T.StructField(YEAR, T.IntegerType()),
                                                      *_fields(FACT_SALES, "product_key", "customer_key", "location_key", "date_key",
                                                               "total_amount")]))
        self.sums = table("sales_sums", _PART, YEAR)

    # -- the ledger ---------------------------------------------------------------
    def loads(self) -> list[dict]:
        """Finished loads in their order (a row each; they are few)."""
        rows = self.ledger.read().orderBy("seq").collect()
        return [{"seq": r["seq"], "batch": r["batch"], "kind": r["kind"], "year": r["year"], **json.loads(r["state"])} for r in rows]

    def _commit(self, before: list[dict], batch: str, kind: str, year: int | None, **state) -> None:
        values = {"seq": len(before) + 1, "kind": kind, "year": year, "state": json.dumps(state)}
        self.ledger.append(literal_row(self.spark, _LEDGER, values), batch)

    def _newest(self, table: PartitionedTable, loads: list[dict], only: set[int] | None = None) -> list[tuple[str, int]]:
        """(batch, bucket) of the newest files of each bucket."""
        place = {x["batch"]: x["seq"] for x in loads}
        newest: dict[int, str] = {}
        for batch, bucket in table.leaves([x["batch"] for x in loads]):
            if (only is None or bucket in only) and (bucket not in newest or place[newest[bucket]] < place[batch]):
                newest[bucket] = batch
        return [(b, k) for k, b in sorted(newest.items())]

    def _yearly(self, table: PartitionedTable, loads: list[dict], year: int | None = None) -> DataFrame:
        """A table by order year, each year from its last reload on."""
        since = {x["year"]: x["seq"] for x in loads if x["kind"] == "reload"}
        place = {x["batch"]: x["seq"] for x in loads}
        leaves = [(b, y) for b, y in table.leaves(list(place)) if place[b] >= since.get(y, 0) and year in (None, y)]
        return table.read_leaves(leaves)

    # -- readers --------------------------------------------------------------------
    def location_dim(self) -> DataFrame:
        return self._locations(self.loads())

    def _locations(self, loads: list[dict]) -> DataFrame:
        rows = self.locations.read([x["batch"] for x in loads]).select(*DIM_LOCATION.fieldNames())
        return with_unknown_member(rows, dims.unknown_location_row(), "location_key")

    def customer_dim(self) -> DataFrame:
        return self._customers(self.loads())

    def _customers(self, loads: list[dict]) -> DataFrame:
        rows = self.customers.read([x["batch"] for x in loads]).select(*DIM_CUSTOMER.fieldNames())
        return with_unknown_member(rows, dims.unknown_customer_row(), "customer_key")

    def product_dim(self) -> DataFrame:
        return self._products(self.loads())

    def _products(self, loads: list[dict], only: set[int] | None = None) -> DataFrame:
        return self.products.read_leaves(self._newest(self.products, loads, only)).select(*DIM_PRODUCT.fieldNames())

    def date_dim(self) -> DataFrame:
        return self.dates

    def silver_sales(self) -> DataFrame:
        return self.silver.read([x["batch"] for x in self.loads()]).select(*SILVER.fieldNames())

    def late_sales(self) -> DataFrame:
        return self._waiting(self.loads())

    def _waiting(self, loads: list[dict]) -> DataFrame:
        return self.late.read([x["batch"] for x in loads[-1:]])

    def _facts(self, loads: list[dict]) -> DataFrame:
        waiting = self._waiting(loads).select(
            "transaction_key", "product_key", "customer_key", "location_key", "date_key", F.col("QUANTITY").alias("quantity"),
            F.col("NET_PRICE").cast("double").alias("net_price"), "total_amount", YEAR)
        return self._yearly(self.facts, loads).select(*FACT_SALES.fieldNames(), YEAR).unionByName(waiting)

    def fact_sales(self) -> DataFrame:
        """The sales fact with its partition column ``order_year``."""
        return self._facts(self.loads())

    def sales_agg(self) -> DataFrame:
        """C9 from the sums of the loads and the lines that wait."""
        loads = self.loads()
        waiting = sales_sums(self._waiting(loads), self._products(loads), self._locations(loads), self.dates)
        settled = self._yearly(self.sums, loads)
        cols = ["country_region", "brand", F.col("year").cast("int").alias("year"), "amount"]
        return settled.select(*cols).unionByName(waiting.select(*cols)).groupBy("country_region", "brand", "year") \
            .agg(quality.exact_sum("amount").cast("double").alias("total_actual_sales"))

    # -- loads ------------------------------------------------------------------------
    def load(self, raw: DataFrame, batch: str, *, members: DataFrame | None = None, products: DataFrame | None = None,
             effective_date=None, date_grain: str = "exact") -> bool:
        """Load raw records as ``batch``; false if a batch of that name is in.

        Dimensions grow from the landed records; where members come from feeds
        of their own, locations and customers grow from ``members`` and
        products from ``products`` (raw records too)."""
        loads = self.loads()
        if batch in {x["batch"] for x in loads}:
            return False
        with scratch_scope(self.spark):
            self._load(loads, raw, batch, members, products, effective_date, date_grain)
        return True

    def _high(self, loads: list[dict], key: str) -> int:
        return loads[-1]["high"][key] if loads else 0

    def _load(self, loads, raw, batch, members, products, effective_date, date_grain) -> None:
        names = [x["batch"] for x in loads]
        records = stamp_ingestion(normalize_columns(raw))
        fresh = incremental.unseen_records(records, self.seen.read(names), self.bronze.read)
        self.bronze.append(fresh, batch, again=True)
        self.seen.append(self.bronze.read([batch]).select(incremental.record_hash().alias("h")), batch, again=True)
        landed, rejects = clean_sales_split(self.bronze.read([batch]), dedup=False)
        self.silver.append(landed.withColumn(YEAR, order_year("ORDER_DATE")), batch, again=True)
        sales = self.silver.read([batch])
        # a record is either in silver or rejected: the files' footers tell whether any is
        rejected = self.bronze.read([batch]).count() - sales.count()
        self.rejects.append(rejects if rejected else self.rejects.read([]), batch, again=True)

        def feed(records: DataFrame | None) -> DataFrame:
            # product versions are distinct anyway: copies need not be found first
            return sales if records is None else clean_sales(normalize_columns(records), dedup=False)

        source = sales
        if members is not None:
            source = incremental.stage(clean_distinct(normalize_columns(members), list(dict.fromkeys(LOCATION_KEY + CUSTOMER_KEY))), "members")
        high = {k: self._high(loads, k) for k in KEYS}
        high["location_key"] = self._grow(self.locations, loads, batch, source, LOCATION_KEY, "location_key", high["location_key"],
                                          {"CONTINENT": "continent", "COUNTRY_REGION": "country_region", "STATE": "state", "CITY": "city"})
        high["customer_key"] = self._grow(self.customers, loads, batch, source, CUSTOMER_KEY, "customer_key", high["customer_key"],
                                          {"CUSTOMER_KEY": "customer_number", "CUSTOMER_CODE": "customer_code", "NAME": "name",
                                           "EDUCATION": "education", "OCCUPATION": "occupation"})
        high["product_key"] = self._products_of(loads, batch, feed(products), effective_date, high["product_key"])

        now = [*loads, {"batch": batch, "seq": len(loads) + 1, "kind": "load", "year": None}]
        high["transaction_key"] = self._settle(now, sales, self._waiting(loads), batch, high["transaction_key"], date_grain)
        marks = {"silver": self._mark(incremental.mark(sales, "QUANTITY", "NET_PRICE", quality.sales_amount("QUANTITY", "NET_PRICE")))}
        marks |= self._fact_marks(batch)
        self._commit(loads, batch, "load", None, high=high, marks=marks)

    def _grow(self, table: PartitionedTable, loads, batch, source, business, key, high, names) -> int:
        """Append the members that the registry lacks; the new highest key."""
        mine = source.select(*[F.col(c).alias(f"b_{n}") for c, n in names.items()])
        old = table.read([x["batch"] for x in loads]).select(*[F.col(n).alias(f"b_{n}") for n in names.values()])
        # keys follow the order of the business key
        new = incremental.new_members(old, mine, [f"b_{names[c]}" for c in business], "k", high + 1)
        table.append(new.select(F.col("k").alias(key), *[F.col(f"b_{n}").alias(n) for n in names.values()]), batch, again=True)
        return table.read([batch]).agg(F.max(key)).first()[0] or high

    def _products_of(self, loads, batch, source, effective_date, high) -> int:
        """Write the buckets in which versions begin or end; the highest key."""
        if not loads:
            first = dims.product_dimension_initial(source).withColumn("bucket", incremental.product_bucket(self.buckets))
        else:
            changed, day = incremental.changed_sources(source, self._products(loads), self.buckets)
            touched = {r[0] for r in changed.select("bucket").distinct().collect()}  # at most the number of buckets
            first = self.products.read([]) if not touched else incremental.merge_buckets(self._products(loads, touched), changed, effective_date, day, high + 1) \
                .withColumn("bucket", incremental.product_bucket(self.buckets))
        self.products.append(first, batch, again=True)
        return max(high, self.products.read([batch]).agg(F.max("product_key")).first()[0] or 0)

    def _settle(self, now: list[dict], landed: DataFrame, waiting: DataFrame, batch: str, high: int, date_grain: str) -> int:
        """Look up and number the landed lines, look up those that wait, write
        what is settled by year and what waits on; the highest key."""
        dimensions = self._products(now), self._customers(now), self._locations(now), self.dates

        def flagged(sales: DataFrame) -> DataFrame:
            # names are staged with the lines that go on waiting only: a fact has keys
            looked_up = look_up_sales(sales, *dimensions, date_grain).withColumn("_late", F.coalesce(incremental.is_late(), F.lit(False)))
            return looked_up.withColumns({c: F.when(F.col("_late"), F.col(c)) for c in _NAMES})

        lines = flagged(landed.select(*SALES_COLUMNS, YEAR))
        if waiting.isEmpty():
            numbered = number_rows(lines, "transaction_key", high + 1)
        else:
            again = flagged(waiting.select("transaction_key", *SALES_COLUMNS, YEAR))
            again = incremental.stage(incremental.first_of_key(again, "transaction_key", ["product_key", "customer_key", "location_key"]), "waiting")
            lines = lines.unionByName(again.filter(F.col("transaction_key").isNull()).drop("transaction_key"))
            numbered = number_rows(lines, "transaction_key", high + 1).unionByName(again.filter(F.col("transaction_key").isNotNull()))
        settled = numbered.filter(~F.col("_late"))
        fact = settled.select("transaction_key", "product_key", "customer_key", "location_key", "date_key", F.col("QUANTITY").alias("quantity"),
                              F.col("NET_PRICE").cast("double").alias("net_price"), "total_amount", YEAR)
        self.facts.append(fact, batch, again=True)
        self.late.append(numbered.filter("_late"), batch, again=True)
        sums = sales_sums(self.facts.read([batch]), self._products(now), self._locations(now), self.dates, by=(YEAR,))
        self.sums.append(sums, batch, again=True)
        written = self.facts.read([batch]).select("transaction_key").unionByName(self.late.read([batch]).select("transaction_key"))
        return max(high, written.agg(F.max("transaction_key")).first()[0] or 0)

    def reload_year(self, year: int, batch: str, date_grain: str = "exact") -> bool:
        """Look the lines of one order year (0: no date) up again and write them
        as that year's only files.  They get new keys, as reloaded rows do; the
        other years' files stay."""
        loads = self.loads()
        if batch in {x["batch"] for x in loads}:
            return False
        with scratch_scope(self.spark):
            now = [*loads, {"batch": batch, "seq": len(loads) + 1, "kind": "reload", "year": year}]
            sales = self.silver.read_leaves([(b, y) for b, y in self.silver.leaves([x["batch"] for x in loads]) if y == year])
            # lines of other years go on waiting
            waiting = self._waiting(loads).filter(F.col(YEAR) != year)
            top = self._settle(now, sales, waiting, batch, self._high(loads, "transaction_key"), date_grain)
            self._commit(loads, batch, "reload", year, high=loads[-1]["high"] | {"transaction_key": top}, marks=self._fact_marks(batch))
        return True

    # -- checks -----------------------------------------------------------------------
    def _mark(self, df: DataFrame) -> dict:
        return {k: str(int(v)) for k, v in df.first().asDict().items()}

    def _fact_marks(self, batch: str) -> dict:
        """Marks of the lines that a load settled, by year, and of those that wait."""
        settled = incremental.mark_by(self.facts.read([batch]), YEAR, "quantity", "net_price", F.col("total_amount"))
        return {"settled": {str(r[YEAR]): {k: str(int(r[k])) for k in MARKS} for r in settled.collect()},  # a row a year
                "waiting": self._mark(incremental.mark(self.late.read([batch]), "QUANTITY", "NET_PRICE", F.col("total_amount")))}

    def reconcile(self) -> DataFrame:
        """V1-V4 as rows (check, left_value, right_value, ok): silver's lines
        against the fact's (settled and waiting), by the loads' marks.  Of the
        files only the last load's are read: their marks are taken again and
        compared with the ledger's, so an altered line shows."""
        loads = self.loads()
        since = {x["year"]: x["seq"] for x in loads if x["kind"] == "reload"}
        silver, fact = dict.fromkeys(MARKS, 0), dict.fromkeys(MARKS, 0)
        for x in loads:
            for k in MARKS:
                silver[k] += int(x["marks"].get("silver", {}).get(k, 0))
                fact[k] += sum(int(m[k]) for y, m in x["marks"]["settled"].items() if x["seq"] >= since.get(int(y), 0))
        found = []
        if loads:
            last = loads[-1]
            for k in MARKS:
                fact[k] += int(last["marks"]["waiting"][k])
            again = self._fact_marks(last["batch"])
            for k in MARKS:
                found.append((f"last_load_settled_{k}", *(sum(int(m[k]) for m in x["settled"].values()) for x in (last["marks"], again))))
                found.append((f"last_load_waiting_{k}", *(int(x["waiting"][k]) for x in (last["marks"], again))))
            if "silver" in last["marks"]:
                read = self.silver.read([last["batch"]])
                mark = self._mark(incremental.mark(read, "QUANTITY", "NET_PRICE", quality.sales_amount("QUANTITY", "NET_PRICE")))
                found += [(f"last_load_silver_{k}", int(last["marks"]["silver"][k]), int(mark[k])) for k in MARKS]
        found = [(f"silver_vs_fact_{k}", silver[k], fact[k]) for k in MARKS] + found
        rows = [F.struct(F.lit(n).alias("check"), F.lit(str(a)).cast("decimal(38,0)").alias("left_value"),
                         F.lit(str(b)).cast("decimal(38,0)").alias("right_value"), F.lit(a == b).alias("ok")) for n, a, b in found]
        return self.spark.range(1).select(F.inline(F.array(*rows)))

    def repeated_keys(self) -> DataFrame:
        """A9 of the fact, without a shuffle of its keys: one row ``repeats``."""
        return incremental.repeated_keys(self.fact_sales(), "transaction_key")
