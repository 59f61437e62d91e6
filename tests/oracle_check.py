"""Run registered queries on Spark and their oracle SQL on DuckDB, and compare the results.

Comparison: column names (sorted), row count, and the sorted multiset of rows with every value
rendered exactly (floats by ``repr``), so it is stricter than a tolerance check.

    python tests/oracle_check.py [sf_dir] [query ...] [--pandas]

``--pandas`` compares through each engine's pandas conversion instead (``toPandas()`` against
DuckDB's ``.df()``, every cell rendered with ``str``), as a harness hashing pandas frames would.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _render(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v + 0.0)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item"):
        return _render(v.item())
    return str(v)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_render(r[i]) for i in order) for r in rows)


def pandas_rows(df) -> list[tuple]:
    import pandas as pd
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return str(v)
    return sorted(tuple(cell(v) for v in row) for row in df.itertuples(index=False))


def compare_pandas(spark, sf_dir: str, names: list[str] | None = None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or list(qs):
        if name not in sqls:
            continue
        report[name] = pandas_rows(qs[name](spark, sf_dir).toPandas()) == pandas_rows(con.sql(sqls[name]).df())
        print(name, {"pandas_match": report[name]}, flush=True)
    return report


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or list(qs):
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        s_cols = sdf.columns
        s_rows = [tuple(r) for r in sdf.collect()]
        t1 = time.time()
        entry = {"rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
        if name in sqls:
            rel = con.sql(sqls[name])
            d_cols = rel.columns
            d_rows = rel.fetchall()
            entry["oracle_rows"] = len(d_rows)
            entry["schema_match"] = sorted(s_cols) == sorted(d_cols)
            entry["match"] = entry["schema_match"] and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
            if not entry["match"] and entry["schema_match"]:
                a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
                diff_a = [r for r in a if r not in set(b)][:3]
                diff_b = [r for r in b if r not in set(a)][:3]
                entry["example_spark"] = diff_a
                entry["example_oracle"] = diff_b
                entry["columns"] = sorted(s_cols)
            elif not entry["schema_match"]:
                entry["spark_cols"] = sorted(s_cols)
                entry["oracle_cols"] = sorted(d_cols)
        else:
            # No SQL: brute force in the query's own tests decides; here the rows must come, under one schema.
            entry["schema_match"] = s_cols == [f.name for f in sdf.schema.fields] and len(set(s_cols)) == len(s_cols)
            entry["match"] = None
        report[name] = entry
        if verbose:
            print(name, entry, flush=True)
    return report


if __name__ == "__main__":
    from panelcast.session import get_session
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or None
    spark = get_session("local[8]", shuffle_partitions=8)
    if "--pandas" in sys.argv:
        prep = compare_pandas(spark, sf, names)
        print(f"{sum(prep.values())}/{len(prep)} pandas match")
        sys.exit(0)
    rep = compare(spark, sf, names)
    bad = [k for k, v in rep.items() if v["match"] is False]
    print("MISMATCH:", bad)
    print(f"{sum(1 for v in rep.values() if v['match'])}/{len(rep)} match")
