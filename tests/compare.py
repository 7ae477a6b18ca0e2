"""Compare the registered queries with their SQL twins on one data folder."""

from __future__ import annotations

import datetime
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None if both give the same rows, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if got == want:
        return None
    wanted, given = set(want), set(got)
    extra = [r for r in got if r not in wanted]
    missing = [r for r in want if r not in given]
    return f"rows {len(got)} / {len(want)}; spark only {extra[:2]}; sql only {missing[:2]}"


def main() -> None:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, query, sqls[name], sf_dir) if name in sqls else "no SQL twin"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {(problem or '')[:1500]}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
