"""Runs queries on Spark and their SQL on DuckDB and compares the rows.

    python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, otherwise what differs."""
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    left, right = _rows(df.columns, df.collect()), _rows(names, theirs.fetchall())
    if left == right:
        return None
    return (
        f"{left.total()} rows against {right.total()}; only here {list((left - right).items())[:3]}; "
        f"only there {list((right - left).items())[:3]}"
    )


def main() -> int:
    import __spark_entry__ as entry

    from strandline.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), entry.oracle_sql()
    wrong = 0
    for name, query in entry.queries().items():
        if name not in sql or len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        begun = time.time()
        try:
            found = compare(query(spark, folder), con, sql[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            found = f"{type(error).__name__}: {str(error)[:600]}"
        wrong += found is not None
        print(f"{name:32} {time.time() - begun:6.2f}s {found or 'ok'}", flush=True)
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(main())
