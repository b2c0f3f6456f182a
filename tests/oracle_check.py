"""Compare every registered query with its DuckDB oracle (as the driver does).

    python tests/oracle_check.py [sf_dir] [query ...]

Prints one line per query: rows Spark/DuckDB, column names, value match.
Values are compared order-insensitively after normalising both sides to text
(floats to 9 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def rows_of(records, cols):
    return sorted(tuple(_norm(r[c]) for c in sorted(cols)) for r in records)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None):
    from __spark_entry__ import oracle_sql, queries

    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [r.asDict() for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[name] = ("ERROR", str(e)[:300])
            print(name, "SPARK ERROR", str(e)[:300], flush=True)
            continue
        dt = time.time() - t0
        if name not in sqls:
            results[name] = ("NO_ORACLE", len(srows))
            print(f"{name}: rows={len(srows)} (no oracle) {dt:.1f}s", flush=True)
            continue
        cur = con.execute(sqls[name])
        dcols = [c[0] for c in cur.description]
        drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
        same_cols = sorted(scols) == sorted(dcols)
        same_vals = same_cols and rows_of(srows, scols) == rows_of(drows, dcols)
        ok = same_cols and same_vals and len(srows) == len(drows)
        results[name] = ("OK" if ok else "MISMATCH", len(srows), len(drows))
        print(f"{name}: {'OK' if ok else 'MISMATCH'} rows={len(srows)}/{len(drows)} cols={'ok' if same_cols else (sorted(scols), sorted(dcols))} {dt:.1f}s", flush=True)
        if same_cols and not same_vals:
            a, b = rows_of(srows, scols), rows_of(drows, dcols)
            diff_a = [x for x in a if x not in set(b)][:3]
            diff_b = [x for x in b if x not in set(a)][:3]
            print("   spark-only:", diff_a, "\n   duck-only:", diff_b, flush=True)
    return results


if __name__ == "__main__":
    from docflow.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "NO_ORACLE")]
    print("FAILED:", bad)
