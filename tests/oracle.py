"""Compares registered queries with their SQL in an in-process DuckDB.

``python tests/oracle.py [--sf 0.01] [name ...]`` prints one line per query.
"""
from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}") + 0.0
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in r))


def run_spark(df):
    return df.columns, [tuple(r) for r in df.collect()]


def run_sql(con, sql):
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def compare(spark_out, sql_out) -> str:
    (c1, r1), (c2, r2) = spark_out, sql_out
    if sorted(c1) != sorted(c2):
        return f"columns differ: {sorted(set(c1) ^ set(c2))}"
    if len(r1) != len(r2):
        return f"rows differ: spark {len(r1)} sql {len(r2)}"
    a, b = rows_of(c1, r1), rows_of(c2, r2)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ; cols {sorted(c1)}; first {bad[0]}"
    kinds = []
    for i, c in enumerate(sorted(c1)):
        t1 = {type(r[c1.index(c)]).__name__ for r in r1 if r[c1.index(c)] is not None}
        t2 = {type(r[c2.index(c)]).__name__ for r in r2 if r[c2.index(c)] is not None}
        if t1 != t2:
            kinds.append(f"{c}: {t1} vs {t2}")
    return "ok" + (f" (types: {kinds})" if kinds else "")


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from stayflow.session import get_session

    sf = "0.01"
    if "--sf" in argv:
        at = argv.index("--sf")
        sf = argv[at + 1]
        argv = argv[:at] + argv[at + 2 :]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session(cpus=8)
    con = connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = argv or list(queries)
    failed = 0
    for name in names:
        t = time.time()
        try:
            out = run_spark(queries[name](spark, sf_dir))
            took = time.time() - t
            if name in sqls:
                t = time.time()
                verdict = compare(out, run_sql(con, sqls[name]))
                sql_took = time.time() - t
            else:
                verdict, sql_took = "ok (rows only)" if out[1] else "no rows", 0.0
        except Exception as e:  # noqa: BLE001 - report and go on
            verdict, took, sql_took = f"error: {type(e).__name__} {str(e)[:600]}", time.time() - t, 0.0
            out = ([], [])
        failed += not verdict.startswith("ok")
        print(f"{'PASS' if verdict.startswith('ok') else 'FAIL'} {name:32s} {len(out[1]):7d} rows {took:6.2f}s sql {sql_took:5.2f}s {verdict}", flush=True)
    print(f"{len(names) - failed} of {len(names)} passed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
