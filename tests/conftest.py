from __future__ import annotations

import json
import sys
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerlake.context import RunContext  # noqa: E402
from ledgerlake.sinks.stage import Stage  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ledgerlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def stage(spark):
    with Stage(spark) as folder:
        yield folder


@pytest.fixture
def ctx():
    return RunContext(date(2002, 1, 1), datetime(2002, 1, 1, 6, 0, 0))


@pytest.fixture
def write_lines(tmp_path):
    """Write records (dicts) or raw text lines as a feed file; returns its path."""

    def write(name: str, records: list) -> str:
        path = tmp_path / f"{name}.json"
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


def values(df, *columns):
    """Rows as sorted tuples of the named columns."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.fixture(name="values")
def values_fixture():
    return values
