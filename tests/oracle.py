"""Run registered queries against DuckDB: ``python -m tests.oracle [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return round(float(v), 9) + 0.0
    if type(v).__name__ == "Decimal":
        return round(float(v), 9)
    return str(v)


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = fn(spark, sf_dir)
    mine = df.collect()
    other = con.execute(sql)
    names = [c[0] for c in other.description]
    theirs = other.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    left, right = bag(df.columns, mine), bag(names, theirs)
    if left == right:
        return None
    extra, lack = left - right, right - left
    return (
        f"rows {len(mine)} vs {len(theirs)}; {sum(extra.values())} differ, "
        f"e.g. spark {list(extra)[:2]} sql {list(lack)[:2]} (columns {sorted(names)})"
    )


def main() -> None:
    import __spark_entry__ as e
    from loamline.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    sqls = e.oracle_sql()
    bad = 0
    for name, fn in e.queries().items():
        if len(args) > 1 and name not in args[1:]:
            continue
        t = time.time()
        try:
            problem = compare(spark, con, fn, sqls[name], sf_dir) if name in sqls else None
            if name not in sqls:
                fn(spark, sf_dir).collect()
        except Exception as x:
            problem = f"{type(x).__name__}: {str(x)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - t:.2f}s {problem or ''}", flush=True)
    print("bad:", bad, "of", len(e.queries()))


if __name__ == "__main__":
    main()
