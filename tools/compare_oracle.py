"""Run registered Spark queries next to their DuckDB oracle and compare
row count, column names and order-insensitive values.

    python tools/compare_oracle.py [--plain-tz=ZONE] [sf_dir] [name-prefix ...]

``--plain-tz`` runs the Spark side in a plain session (none of the package's
session defaults) with the given session time zone, as a driver might.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

from starloom.plans.catalog import ORACLE, QUERIES  # noqa: E402
from starloom.session import build_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--plain-tz=")]
    plain = [a.split("=", 1)[1] for a in sys.argv[1:] if a.startswith("--plain-tz=")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    prefixes = args[1:]
    if plain:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.sql.session.timeZone", plain[0]).getOrCreate())
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name, fn in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        t1 = time.time()
        sql = ORACLE.get(name)
        if sql is None:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            res = con.execute(sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        msgs = []
        if sorted(cols) != sorted(dcols):
            msgs.append(f"columns spark={sorted(cols)} duck={sorted(dcols)}")
        if len(srows) != len(drows):
            msgs.append(f"rows spark={len(srows)} duck={len(drows)}")
        if not msgs:
            a, b = canon(cols, srows), canon(dcols, drows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                msgs.append(f"values differ e.g. {diff}")
        if msgs:
            bad += 1
            print(f"FAIL {name}: " + "; ".join(msgs)[:600])
        else:
            print(f"ok   {name}: {len(srows)} rows spark {t1 - t0:.1f}s")
    print(f"done, {bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
