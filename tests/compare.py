"""Runs registered queries beside their SQL: python -m tests.compare SF_DIR [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}") + 0.0
    return v


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_value(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


def difference(spark_side, sql_side) -> str | None:
    """None when both sides hold the same rows, else what differs."""
    (c1, r1), (c2, r2) = spark_side, sql_side
    if c1 != c2:
        return f"columns {c1} vs {c2}"
    if r1 != r2:
        only1, only2 = list((r1 - r2).items())[:2], list((r2 - r1).items())[:2]
        return f"rows {sum(r1.values())} vs {sum(r2.values())}\n   spark {only1}\n   sql   {only2}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from custgraph.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark, con, bad = local_session(), connect(folder), 0
    sql = entry.oracle_sql()
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = spark_rows(build(spark, folder))
            took = time.time() - start
            problem = difference(got, sql_rows(con, sql[name])) if name in sql else None
            note = "" if name in sql else " (no SQL)"
        except Exception as error:
            took, got, problem, note = time.time() - start, (None, Counter()), f"{type(error).__name__}: {str(error)[:700]}", ""
        spark.catalog.clearCache()
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {took:6.2f}s {sum(got[1].values()):8d} {name}{note}" + (f"\n   {problem}" if problem else ""), flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
