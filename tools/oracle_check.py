"""Run registered queries in Spark and their SQL twins in DuckDB; compare results.

usage: python tools/oracle_check.py [--sf-dir DIR] [name-substring ...]

Comparison is strict: same column names, same row count and the same
multiset of rows (values compared exactly after each side's own rounding).
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from opsanalytics.plans import registry  # noqa: E402
from opsanalytics.plans.driver_tables import TABLES  # noqa: E402
from opsanalytics.session import get_session  # noqa: E402


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return float(v)
    return str(v) if not isinstance(v, str) else v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(norm(x) for x in rec))
    out.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return cols, out


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()

    registry.load_all()
    names = [n for n in registry.QUERIES if not args.names or any(s in n for s in args.names)]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf_dir}/{t}.parquet'")

    n_ok = n_bad = n_rows_only = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = registry.QUERIES[name](spark, args.sf_dir)
            spdf = sdf.toPandas()
        except Exception as exc:  # noqa: BLE001
            n_bad += 1
            print(f"FAIL  {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            traceback.print_exc(limit=3)
            continue
        t_spark = time.time() - t0
        sql = registry.ORACLE.get(name)
        if sql is None:
            n_rows_only += 1
            print(f"ROWS  {name}: {len(spdf)} rows (no oracle) spark {t_spark:.2f}s")
            continue
        try:
            dpdf = con.execute(sql).df()
        except Exception as exc:  # noqa: BLE001
            n_bad += 1
            print(f"FAIL  {name}: duckdb error {str(exc)[:600]}")
            continue
        sc, sr = rows_of(spdf)
        dc, dr = rows_of(dpdf)
        if sc != dc:
            n_bad += 1
            print(f"FAIL  {name}: columns differ\n  spark  {sc}\n  duckdb {dc}")
            continue
        if len(sr) != len(dr):
            n_bad += 1
            print(f"FAIL  {name}: rows spark={len(sr)} duckdb={len(dr)}")
            continue
        diffs = [(a, b) for a, b in zip(sr, dr) if a != b]
        if diffs:
            n_bad += 1
            print(f"FAIL  {name}: {len(diffs)} of {len(sr)} rows differ; cols {sc}")
            for a, b in diffs[:3]:
                print("   spark ", a)
                print("   duckdb", b)
            continue
        n_ok += 1
        print(f"OK    {name}: {len(sr)} rows spark {t_spark:.2f}s")
    print(f"\nsummary: ok={n_ok} fail={n_bad} rows-only={n_rows_only} of {len(names)}")
    spark.stop()
    return 1 if n_bad else 0


if __name__ == "__main__":
    sys.exit(main())
