"""Run every registered query and its SQL on one data folder and compare the results."""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from registry.oracles import ORACLES  # noqa: E402
from registry.queries import ORDERED, QUERIES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def rows_by_name(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def in_order(name: str, columns: list[str], rows: list[tuple]) -> list[tuple]:
    """The ordering columns of an ordered query's rows, as they came; nothing for the others."""
    return [tuple(row[columns.index(c)] for c in ORDERED[name]) for row in rows] if name in ORDERED else []


def main(folder: str, names: list[str]) -> int:
    con = connect(folder)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerlake-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            got_columns, got = df.columns, [tuple(r) for r in df.collect()]
        except Exception as problem:  # noqa: BLE001
            print(f"{name:32} FAILED {str(problem)[:600]}")
            bad += 1
            continue
        took = time.time() - start
        result = con.execute(ORACLES[name])
        want_columns, want = [c[0] for c in result.description], result.fetchall()
        same_columns = sorted(got_columns) == sorted(want_columns)
        same = same_columns and rows_by_name(got_columns, got) == rows_by_name(want_columns, want)
        same = same and in_order(name, got_columns, got) == in_order(name, want_columns, want)
        print(f"{name:32} {'ok' if same else 'DIFFERS':8} {len(got):7} rows {took:6.2f}s", flush=True)
        if not same:
            bad += 1
            print("  columns only in one:", set(got_columns) ^ set(want_columns))
            a, b = rows_by_name(got_columns, got), rows_by_name(want_columns, want)
            print("  got ", list((a - b).items())[:2])
            print("  want", list((b - a).items())[:2])
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
