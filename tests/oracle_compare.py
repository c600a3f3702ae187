"""Run registered Spark queries next to their DuckDB oracle and compare
row count, column names and order-insensitive values.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, pd.Timestamp):
        return str(v)
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)  # int vs float widths differ between engines
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    res = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            s = qs[name](spark, sf_dir).toPandas()
        except Exception as ex:  # noqa: BLE001
            res[name] = ("SPARK_ERROR", str(ex)[:400])
            if verbose:
                print(f"{name:32s} SPARK_ERROR {str(ex)[:300]}")
            continue
        ts = time.time() - t0
        if name not in sqls:
            res[name] = ("NO_ORACLE", len(s))
            if verbose:
                print(f"{name:32s} NO_ORACLE rows={len(s)} {ts:.1f}s")
            continue
        try:
            d = con.execute(sqls[name]).df()
        except Exception as ex:  # noqa: BLE001
            res[name] = ("SQL_ERROR", str(ex)[:400])
            if verbose:
                print(f"{name:32s} SQL_ERROR {str(ex)[:300]}")
            continue
        if sorted(s.columns) != sorted(d.columns):
            res[name] = ("COLUMNS", sorted(set(s.columns) ^ set(d.columns)))
        elif len(s) != len(d):
            res[name] = ("ROWCOUNT", (len(s), len(d)))
        else:
            rs, rd = rows(s), rows(d)
            bad = [(a, b) for a, b in zip(rs, rd) if a != b]
            res[name] = ("OK", len(s)) if not bad else ("VALUES", bad[:2])
        if verbose:
            print(f"{name:32s} {res[name][0]:8s} {str(res[name][1])[:300]} spark={ts:.1f}s")
    return res


if __name__ == "__main__":
    from opslake.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    r = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in r.items() if v[0] not in ("OK", "NO_ORACLE")}
    print(f"\n{len(r) - len(bad)}/{len(r)} ok; failing: {sorted(bad)}")
