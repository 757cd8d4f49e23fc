"""Compare every query with its oracle: ``python -m tests.oracle_check [folder] [name ...]``."""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    return con


def cell(value) -> str:
    if value is None or value != value:
        return "null"
    if isinstance(value, dt.datetime):
        value = value.date()
    return f"{type(value).__name__}:{value!r}"


def table(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str, seconds: dict | None = None) -> str | None:
    """None if equal, otherwise what differs first."""
    ours = spark_df.collect()
    start = time.time()
    result = con.execute(sql)
    theirs_columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    if seconds is not None:
        seconds["oracle"] = time.time() - start
    if sorted(spark_df.columns) != sorted(theirs_columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(theirs_columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    a, b = table(spark_df.columns, ours), table(theirs_columns, theirs)
    if a != b:
        names = sorted(theirs_columns)
        wrong = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
        x, y = wrong[0]
        cells = [(n, p, q) for n, p, q in zip(names, x, y, strict=True) if p != q]
        return f"{len(wrong)} rows differ, first {cells[:4]}"
    return None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from skyledger.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = get_session(
        "oracle-check",
        "local[8]",
        8,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(folder), oracle_sql(), 0
    extra = set(oracle) - set(queries())
    if extra:
        print("oracles without a query:", extra)
    for name, query in queries().items():
        if only and name not in only:
            continue
        start, seconds = time.time(), {}
        try:
            df = query(spark, folder)
            if name in oracle:
                problem = difference(df, con, oracle[name], seconds)
                note = "ok" if problem is None else f"FAIL {problem}"
                rows = f" (oracle {seconds['oracle']:.2f}s)"
            else:
                problem, note, rows = None, "rows only", f" {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem, note, rows = error, f"ERROR {str(error)[:1500]}", ""
        failed += problem is not None
        print(f"{name:36s} {time.time() - start:6.2f}s {note}{rows}", flush=True)
    print("failed:", failed)
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
