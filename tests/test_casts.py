"""Counts of what typed columns lose, on the way and as a stored table."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.context import FULL_LOAD, INCREMENTAL_LOAD, RunContext
from ledgerlake.operators.casts import Cast, cast_counts, cast_rows, feed_casts
from ledgerlake.plans.lake import Lake
from ledgerlake.plans.loads import LoadReport, land_all, land_day, stored_casts

DAY = date(2024, 3, 2)


def _counted(df, feed):
    casts = feed_casts(feed, DAY)
    return {r[1]: r[2:] for r in cast_rows(feed, casts, df.agg(*cast_counts(casts)).first().asDict())}


def test_each_row_is_counted_once(spark):
    amounts = ["1.5", "-1", "0", "", " 7 ", "1e3", "NaN", "9" * 40, "n/a", None, None]
    days = ["2024-03-02T23:59:59", "2024-03-03", "1969-12-31", "2024-13-01", "", None, *["2024-01-01"] * 5]
    rows = [("t", "u", "b", a, "debit", "x", d) for a, d in zip(amounts, days)]
    got = _counted(spark.createDataFrame(rows, schemas.TRANSACTIONS_FEED), "transactions")
    assert got == {"amount": (11, 2, 4, 1), "created_at": (11, 1, 2, 2)}


def test_ratings_and_events(spark):
    ratings = [("1", "b", r, "2024-01-01") for r in ("0", "5", "5.1", "-1", "five", "NaN", None)]
    got = _counted(spark.createDataFrame(ratings, schemas.USERS_FEED), "users")
    assert got["rating"] == (7, 1, 1, 3)
    flat = [(None,) * 11, ("u", "20240302", *[None] * 5, "x", None, None, None), ("u", "20250101 later", *[None] * 5, "-1", None, None, None)]
    got = _counted(spark.createDataFrame(flat, schemas.ANALYTICS_FLAT), "analytics")
    assert got == {"event_date": (3, 1, 0, 1), "operating_system_version": (3, 1, 1, 1)}


def test_no_bounds_and_no_rows(spark):
    cast = Cast("a", F.col("a").try_cast("int"))
    empty = spark.createDataFrame([], "a string")
    assert cast_rows("f", [cast], empty.agg(*cast_counts([cast])).first().asDict()) == [("f", "a", 0, 0, 0, 0)]
    assert cast_rows("f", [cast], spark.createDataFrame([("-9",), ("x",)], "a string").agg(*cast_counts([cast])).first().asDict()) == [
        ("f", "a", 2, 0, 1, 0)
    ]


@pytest.fixture
def inputs(write_lines):
    def make(*amounts):
        sent = [
            {"transaction_id": str(i), "user_id": "u", "amount": a, "created_at": "2024-03-02T10:00:00"} for i, a in enumerate(amounts)
        ]
        return {
            "users": write_lines("users", [{"user_id": "u", "created_at": "2024-03-01", "rating": "9"}]),
            "transactions": write_lines("transactions", [*sent, "{half a li"]),
            "analytics": write_lines("analytics", ["{}"]),
        }

    return make


def test_runs_keep_their_own_counts(spark, inputs, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    full = RunContext(DAY, datetime(2024, 3, 2, 6), FULL_LOAD)
    day = RunContext(DAY, datetime(2024, 3, 2, 18), INCREMENTAL_LOAD)
    land_all(spark, inputs("1", "x"), lake, full, LoadReport())
    for amounts in (("1", "x", "y"), ("1", "x", "-3")):  # the second run of a day replaces the first
        land_day(spark, inputs(*amounts), lake, day, LoadReport())
    got = {tuple(r)[:3]: tuple(r)[3:] for r in stored_casts(lake).collect()}
    assert len(got) == 12
    assert got["full", "transactions", "amount"] == (2, 0, 1, 0)
    assert got["2024-03-02", "transactions", "amount"] == (3, 0, 1, 1)
    assert got["2024-03-02", "users", "rating"] == (1, 0, 0, 1)
    assert got["full", "analytics", "event_date"] == (1, 1, 0, 0)


def test_counting_takes_no_pass_of_its_own(spark):
    """The counts sit in the plan of the rows that are written."""
    casts = feed_casts("users", DAY)
    seen = spark.createDataFrame([("1", "b", "3", "2024")], schemas.USERS_FEED).observe("casts", *cast_counts(casts))
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "CollectMetrics" in plan and "Exchange" not in plan
