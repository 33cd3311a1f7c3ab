"""Run catalogue queries on Spark and their oracle SQL on DuckDB; compare results.

Used by the tests and runnable by hand:
    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}")
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, sf_dir: str, names=None, verbose=True):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        cols = df.columns
        rows = [tuple(r) for r in df.collect()]
        t_spark = time.time() - t0
        if name not in sqls:
            results[name] = {"rows": len(rows), "oracle": None, "spark_s": round(t_spark, 2)}
            if verbose:
                print(f"{name:28s} rows={len(rows):8d} (no oracle) {t_spark:.2f}s", flush=True)
            continue
        rel = con.sql(sqls[name])
        ocols = rel.columns
        orows = rel.fetchall()
        ok_cols = sorted(cols) == sorted(ocols)
        ok_rows = len(rows) == len(orows)
        ok_vals = ok_cols and ok_rows and canon(rows, cols) == canon(orows, ocols)
        results[name] = {"rows": len(rows), "oracle_rows": len(orows), "cols": ok_cols,
                         "values": ok_vals, "spark_s": round(t_spark, 2)}
        if verbose:
            flag = "OK " if ok_vals else "BAD"
            print(f"{flag} {name:24s} rows={len(rows):8d}/{len(orows):<8d} cols={ok_cols} "
                  f"{t_spark:.2f}s", flush=True)
            if not ok_vals:
                print("   spark cols", cols, "oracle cols", ocols)
                a, b = canon(rows, cols), canon(orows, ocols)
                diff_a = [r for r in a if r not in set(b)][:5]
                diff_b = [r for r in b if r not in set(a)][:5]
                print("   only spark:", diff_a)
                print("   only oracle:", diff_b)
    return results


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from spindle.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    compare(spark, sf, sys.argv[2:] or None)
