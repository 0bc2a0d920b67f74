"""Run registered Spark queries next to their DuckDB oracle and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from quarry.catalog.fixtures import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, qfn, sql, sf_dir):
    t0 = time.time()
    s = qfn(spark, sf_dir).toPandas()
    t1 = time.time()
    d = con.execute(sql).df()
    t2 = time.time()
    msg = []
    if sorted(s.columns) != sorted(d.columns):
        msg.append(f"columns spark={sorted(s.columns)} duck={sorted(d.columns)}")
    elif len(s) != len(d):
        msg.append(f"rows spark={len(s)} duck={len(d)}")
    else:
        rs, rd = rows(s), rows(d)
        bad = [(a, b) for a, b in zip(rs, rd) if a != b]
        if bad:
            msg.append(f"{len(bad)} value mismatches, e.g. spark={bad[0][0]} duck={bad[0][1]}")
    return msg, t1 - t0, t2 - t1, len(s)


def main():
    from quarry.catalog import ORACLES, QUERIES, load_all
    from quarry.session import get_spark
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    load_all()
    spark = get_spark()
    con = duck(sf_dir)
    fails = 0
    for name, q in QUERIES.items():
        if names and name not in names:
            continue
        sql = ORACLES.get(name)
        if sql is None:
            t0 = time.time()
            n = q(spark, sf_dir).count()
            print(f"ROWS  {name:40s} rows={n} spark={time.time() - t0:.1f}s")
            continue
        try:
            msg, ts, td, n = compare(spark, con, name, q, sql, sf_dir)
        except Exception as e:  # noqa: BLE001
            msg, ts, td, n = [f"ERROR {type(e).__name__}: {str(e)[:400]}"], 0, 0, 0
        status = "OK  " if not msg else "FAIL"
        fails += bool(msg)
        print(f"{status} {name:40s} rows={n} spark={ts:.1f}s duck={td:.2f}s {'; '.join(msg)}")
    print(f"failures: {fails}")


if __name__ == "__main__":
    main()
