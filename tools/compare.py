"""Run registered queries in Spark and their oracle in DuckDB; compare like the driver does.

usage: python tools/compare.py [--sf DIR] [name-substring ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(norm(x) for x in rec))
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    import duckdb
    import pandas as pd  # noqa: F401

    from faultline.registry import load_all, oracle_texts
    from faultline.session import get_session
    from faultline.sources.tables import TABLES
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "12g"})
    reg = load_all()
    orc = oracle_texts()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    bad = 0
    for name, e in reg.items():
        if a.names and not any(s in name for s in a.names):
            continue
        t0 = time.time()
        try:
            sdf = e.spark(spark, a.sf).toPandas()
        except Exception as ex:  # noqa: BLE001
            print(f"SPARK-ERR {name}: {str(ex)[:600]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in orc:
            print(f"ROWS-ONLY {name}: rows={len(sdf)} spark={t1 - t0:.1f}s")
            continue
        try:
            ddf = con.execute(orc[name]).fetchdf()
        except Exception as ex:  # noqa: BLE001
            print(f"DUCK-ERR {name}: {str(ex)[:600]}")
            bad += 1
            continue
        sc, sr = rows_of(sdf)
        dc, dr = rows_of(ddf)
        if sc != dc:
            print(f"SCHEMA {name}: spark={sc} duck={dc}")
            bad += 1
        elif len(sr) != len(dr):
            print(f"ROWCOUNT {name}: spark={len(sr)} duck={len(dr)}")
            bad += 1
        elif sr != dr:
            diffs = [(x, y) for x, y in zip(sr, dr) if x != y][:3]
            print(f"VALUES {name}: {len(sr)} rows; first diffs:")
            for x, y in diffs:
                print("   spark", x)
                print("   duck ", y)
            bad += 1
        else:
            print(f"OK {name}: rows={len(sr)} spark={t1 - t0:.1f}s")
    print(f"FAILED={bad}")


if __name__ == "__main__":
    main()
