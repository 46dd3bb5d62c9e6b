"""Run registered queries beside their DuckDB oracle and compare whole results.

    python -m tests.oracle_compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{Path(sf_dir) / table}.parquet'")
    return con


def _cell(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, decimal.Decimal):
        return float(f"{float(value):.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def table(names: list[str], rows: list) -> tuple[list[str], list[str]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(repr([_cell(row[i]) for i in order]) for row in rows)


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, str]:
    """(rows, "") when equal, else (rows, what differs)."""
    ours = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    theirs = table([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return len(ours[1]), f"columns {ours[0]} against {theirs[0]}"
    if ours[1] != theirs[1]:
        mine, other = set(ours[1]), set(theirs[1])
        sample = f"ours {sorted(mine - other)[:2]} theirs {sorted(other - mine)[:2]}"
        return len(ours[1]), f"{len(ours[1])} against {len(theirs[1])} rows; {sample}"
    return len(ours[1]), ""


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from ledgerloom.session import build_session

    spark = build_session(
        master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                              "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                rows, problem = compare(df, con, oracle[name])
            else:
                rows, problem = df.count(), ""
        except Exception as failure:  # noqa: BLE001 - report and go on
            rows, problem = -1, str(failure)[:600]
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {name:32} {rows:8} {time.time() - start:6.2f}s {problem}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
