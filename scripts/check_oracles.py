"""Run every registered query in Spark and its oracle in DuckDB; compare results.

Usage: python scripts/check_oracles.py [sf_dir] [key ...]

Compares row count, column names and an order-insensitive hash of normalised values,
like the driver's correctness gate. Prints one line per key and a summary.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from adoptlens.catalog import ORACLES, QUERIES, load_all  # noqa: E402
from adoptlens.session import build_session  # noqa: E402
from adoptlens.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


SPARK_KIND = {"IntegerType": "int32", "LongType": "int64", "ShortType": "int16", "ByteType": "int8",
              "DoubleType": "float64", "FloatType": "float32", "StringType": "string", "BooleanType": "bool",
              "DateType": "date", "TimestampNTZType": "timestamp", "TimestampType": "timestamptz"}
DUCK_KIND = {"INTEGER": "int32", "BIGINT": "int64", "SMALLINT": "int16", "TINYINT": "int8", "DOUBLE": "float64",
             "FLOAT": "float32", "VARCHAR": "string", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp",
             "TIMESTAMP WITH TIME ZONE": "timestamptz", "HUGEINT": "int128"}


def spark_kinds(schema):
    return {f.name: SPARK_KIND.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in schema.fields}


def duck_kinds(rel):
    return {d[0]: DUCK_KIND.get(str(d[1]), str(d[1])) for d in rel.description}


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    load_all()
    spark = build_session("local[8]", 8)
    # optional: mimic a driver session configured differently from ours
    if os.environ.get("CHECK_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["CHECK_TZ"])
    if os.environ.get("CHECK_ANSI"):
        spark.conf.set("spark.sql.ansi.enabled", os.environ["CHECK_ANSI"])
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    keys = keys or sorted(QUERIES)
    ok = bad = weak = 0
    for k in keys:
        t0 = time.time()
        try:
            sdf = QUERIES[k](spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in ORACLES:
            print(f"ROWS {k}: {len(srows)} rows (no oracle) {ts:.1f}s")
            weak += 1
            continue
        try:
            rel = con.execute(ORACLES[k])
            dkinds = duck_kinds(rel)
            dcols = [d[0] for d in rel.description]
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        sh, sl = digest(scols, srows)
        dh, dl = digest(dcols, drows)
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {k}: columns spark={scols} duckdb={dcols}")
            bad += 1
        elif len(srows) != len(drows) or sh != dh:
            print(f"FAIL {k}: rows spark={len(srows)} duckdb={len(drows)}")
            ds, dd = set(sl), set(dl)
            for x in list(ds - dd)[:3]:
                print("   spark only:", x[:200])
            for x in list(dd - ds)[:3]:
                print("   duck  only:", x[:200])
            bad += 1
        else:
            skinds = spark_kinds(sdf.schema)
            diff = {c: (skinds[c], dkinds.get(c)) for c in skinds if skinds[c] != dkinds.get(c)}
            note = f"  TYPES {diff}" if diff else ""
            print(f"ok   {k}: {len(srows)} rows {ts:.1f}s{note}")
            ok += 1
    print(f"SUMMARY ok={ok} fail={bad} rows_only={weak} total={len(keys)}")
    spark.stop()


if __name__ == "__main__":
    main()
