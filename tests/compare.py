"""Run queries next to their SQL counterparts and compare rows, columns and values.

``python -m tests.compare [scale] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from datetime import date, datetime

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and a SQL result; empty when they are equal."""
    spark_columns, spark_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    sql_columns, sql_rows = _rows([c[0] for c in found.description], found.fetchall())
    problems = []
    if spark_columns != sql_columns:
        problems.append(f"columns {spark_columns} != {sql_columns}")
    if len(spark_rows) != len(sql_rows):
        problems.append(f"{len(spark_rows)} rows != {len(sql_rows)}")
    elif spark_rows != sql_rows:
        pairs = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
        problems.append(f"{len(pairs)} rows differ, first {pairs[0]}")
    if not spark_rows:
        problems.append("no rows")
    return problems


def main() -> None:
    import __spark_entry__ as entry
    from demandspark.session import build_session

    scale, *wanted = sys.argv[1:] or ["0.01"]
    folder = f"/root/testdata/sf{scale}"
    spark = build_session("compare", "local[8]", spark__ui__enabled="false", spark__driver__memory="16g",
                          spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, statements = connect(folder), entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            problems = compare(df, con, statements[name]) if name in statements else []
            rows = "" if name in statements else f"{df.count()} rows, no SQL"
        except Exception as error:  # keep going: one line per query
            problems, rows = [f"{type(error).__name__}: {str(error)[:600]}"], ""
        print(f"{'FAIL' if problems else 'ok':5}{name:26}{time.time() - start:6.1f}s {rows}{'; '.join(problems)[:900]}",
              flush=True)


if __name__ == "__main__":
    main()
