"""Run a registered Spark query and its DuckDB oracle side by side.

Usable from pytest and as a script:
    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from riskspark.session import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


_KIND = {"int64": "int", "int32": "int", "Int64": "int", "Int32": "int", "int16": "int", "int8": "int",
         "float64": "float", "Float64": "float", "object": "str", "string": "str", "bool": "bool",
         "boolean": "bool"}


def _type_diffs(s: pd.DataFrame, o: pd.DataFrame) -> dict:
    """Column kinds that differ between the two results (int / float / str / bool)."""
    out = {}
    for c in s.columns:
        if c in o.columns:
            a, b = str(s[c].dtype), str(o[c].dtype)
            if _KIND.get(a, a) != _KIND.get(b, b) and not (s[c].isna().all() or o[c].isna().all()):
                out[c] = (a, b)
    return out


def compare(spark, con, name: str, sf_dir: str, query, sql: str) -> dict:
    t0 = time.time()
    s = query(spark, sf_dir).toPandas()
    t1 = time.time()
    o = con.execute(sql).df()
    res = {"name": name, "spark_rows": len(s), "oracle_rows": len(o), "spark_sec": round(t1 - t0, 2)}
    res["columns_match"] = sorted(s.columns) == sorted(o.columns)
    if not res["columns_match"]:
        res["spark_cols"] = sorted(s.columns)
        res["oracle_cols"] = sorted(o.columns)
        res["match"] = False
        return res
    res["type_diffs"] = _type_diffs(s, o)
    a, b = _rows(s), _rows(o)
    res["match"] = a == b
    if not res["match"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["first_diffs"] = diff
        res["cols"] = sorted(s.columns)
    return res


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from riskspark.session import local_session
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name}: no oracle")
            continue
        try:
            r = compare(spark, con, name, sf_dir, qs[name], sqls[name])
        except Exception as e:  # report and go on
            r = {"name": name, "match": False, "error": repr(e)[:2000]}
        bad += not r["match"]
        print(r, flush=True)
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
