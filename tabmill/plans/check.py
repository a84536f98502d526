"""Run registered queries next to their SQL and report differences."""

from __future__ import annotations

import sys
import time

import duckdb

from tabmill.plans import all_queries
from tabmill.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def rows(columns: list[str], values) -> list[tuple]:
    """Rows as text, columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(v[i]) for i in order) for v in values)


def _text(v) -> str:
    return f"{type(v).__name__}:{v!r}"


def compare(spark, con, name: str, sf: str) -> str:
    """Empty text if both engines agree."""
    queries, oracles = all_queries()
    df = queries[name](spark, sf)
    got = rows(df.columns, (tuple(r) for r in df.collect()))
    if name not in oracles:
        return "" if got else "no rows"
    result = con.execute(oracles[name])
    columns = [d[0] for d in result.description]
    want = rows(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}: {got[:2]} / {want[:2]}"
    for g, w in zip(got, want):
        if g != w:
            return f"{sum(a != b for a, b in zip(got, want))} of {len(got)} differ: {g} / {w}"
    return "" if got else "no rows"


if __name__ == "__main__":
    sf = sys.argv[1]
    names = sys.argv[2:] or list(all_queries()[0])
    spark = local_session(8, spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("OFF")
    con, failed = oracle(sf), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf)
        except Exception as e:  # noqa: BLE001 - reported, and the rest still runs
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += bool(problem)
        mark = "ok" if name in all_queries()[1] else "rows"
        print(f"{name:24s} {time.time() - start:6.2f}s  {problem or mark}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
