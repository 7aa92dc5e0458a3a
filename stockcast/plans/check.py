"""Run registered queries next to their DuckDB oracle and compare the results.

Comparison: column names (sorted), row count, and the sorted multiset of
rows (doubles rounded to 6 decimals). Used by pytest and from the command line:

    python -m stockcast.plans.check /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, round(v, 6))
    if isinstance(v, bool):
        return (1, int(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return (1, v) if isinstance(v, (int,)) else (2, str(v))


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, con, name: str, run, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    df = run(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    res = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_sec": round(t1 - t0, 2),
        "oracle_sec": round(t2 - t1, 2),
    }
    res["values_match"] = res["columns_match"] and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    if not res["columns_match"]:
        res["spark_columns"], res["oracle_columns"] = s_cols, d_cols
    elif not res["values_match"]:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        res["first_diff"] = next(((x, y) for x, y in zip(a, b) if x != y), None)
    return res


def main(argv):
    sys.path.insert(0, ".")
    from stockcast.plans.catalog import REGISTRY
    from stockcast.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or [k for k, q in REGISTRY.items() if q.oracle]
    spark = local_session(8)
    con = duckdb_connection(sf_dir)
    bad = 0
    for n in names:
        q = REGISTRY[n]
        if not q.oracle:
            df = q.run(spark, sf_dir)
            print({"name": n, "spark_rows": df.count(), "oracle": None}, flush=True)
            continue
        r = compare(spark, con, n, q.run, q.oracle, sf_dir)
        bad += not r["values_match"]
        print(r, flush=True)
    print("mismatches:", bad)


if __name__ == "__main__":
    main(sys.argv)
