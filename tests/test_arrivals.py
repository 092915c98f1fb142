"""Feed files landed as they arrive."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.context import INCREMENTAL_LOAD
from ledgerlake.plans.lake import Lake
from ledgerlake.plans.loads import LoadReport, incremental_load
from ledgerlake.sinks.files import delete_tree
from ledgerlake.streaming import arrivals as module
from ledgerlake.streaming.arrivals import RUN, Arrivals, land_arrivals

COLUMNS = ("transaction_id", "cryear", "crmonth", "crday")


def _trans(i, day, user="1"):
    return {
        "transaction_id": i, "user_id": user, "business_id": "1", "amount": "1.00", "transaction_type": "debit",
        "type": "x", "created_at": f"{day}T01:02:03",
    }


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()

    def arrive(name, records):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        (folder / name).write_text("".join(f"{line}\n" for line in lines))
        return str(folder)

    return arrive


@pytest.fixture
def lake(spark, stage):
    made = Lake(spark, stage.path("lake"))
    made.create_missing()
    return made


def _land(lake, path, ctx, **more):
    report = LoadReport()
    days = Arrivals(lake, "transactions").land(path, ctx, report, **more)
    return days, report


def test_two_arrivals_give_what_one_read_gives(lake, feed, ctx, values):
    first = [_trans("1", "2002-01-01"), _trans("2", "2002-01-02"), _trans("2", "2002-01-02")]
    second = [_trans("3", "2002-01-02"), _trans("4", "1999-12-31")]
    days, report = _land(lake, feed("a.json", first), ctx)
    assert days == [date(2002, 1, 1), date(2002, 1, 2)] and report.rows == {"raw.transactions": 3}
    later = replace(ctx, processed_at=datetime(2002, 1, 3))
    days, report = _land(lake, feed("b.json", second), later)
    assert days == [date(1999, 12, 31), date(2002, 1, 2)] and report.rows == {"raw.transactions": 2}
    stored = lake.stored("raw.transactions")
    assert values(stored, *COLUMNS) == [
        ("1", 2002, 1, 1), ("2", 2002, 1, 2), ("2", 2002, 1, 2), ("3", 2002, 1, 2), ("4", 1999, 12, 31),
    ]
    # Each row keeps the time of the run that brought it.
    assert {r[0] for r in stored.where("transaction_id < 3").select("processed_at").collect()} == {ctx.processed_at}


def test_days_without_arrivals_are_not_written_and_a_repeated_run_reads_nothing(lake, feed, ctx):
    path = feed("a.json", [_trans("1", "2002-01-01"), _trans("2", "2002-01-02")])
    _land(lake, path, ctx)

    def files():
        return {r[0] for r in lake.stored("raw.transactions").select(F.col("_metadata.file_path")).distinct().collect()}

    before = files()
    assert _land(lake, path, ctx)[1].rows == {"raw.transactions": 0} and files() == before
    _land(lake, feed("b.json", [_trans("3", "2002-01-02")]), ctx)
    kept = files() & before
    assert len(kept) == 1 and "crday=1/" in kept.pop()
    assert Arrivals(lake, "transactions").rows().agg(F.max(RUN)).head()[0] == 2


def test_a_failed_run_is_repeated_without_doubles(lake, feed, ctx, values, monkeypatch):
    path = feed("a.json", [_trans("1", "2002-01-01")])
    _land(lake, path, ctx)
    feed("b.json", [_trans("2", "2002-01-01"), _trans("2", "2002-01-01")])
    write = module.write_days

    def torn(*args):
        write(*args)
        raise OSError("executor lost")

    monkeypatch.setattr(module, "write_days", torn)
    with pytest.raises(OSError):
        _land(lake, path, ctx)
    monkeypatch.setattr(module, "write_days", write)
    feed("c.json", [_trans("3", "2002-01-05")])
    days, report = _land(lake, path, ctx)
    assert days == [date(2002, 1, 1), date(2002, 1, 5)] and report.rows == {"raw.transactions": 3}
    assert values(lake.stored("raw.transactions"), "transaction_id") == [("1",), ("2",), ("2",), ("3",)]


def test_a_lost_raw_day_and_its_marker_come_back(lake, spark, feed, ctx, values):
    """What is in the arrivals table but not marked is landed again."""
    path = feed("a.json", [_trans("1", "2002-01-01"), _trans("2", "2002-01-02")])
    _land(lake, path, ctx)
    delete_tree(spark, f"{lake.root}/arrivals/transactions/done/00000001")
    delete_tree(spark, lake.folder("raw.transactions"))
    lake.create_missing()
    _land(lake, path, ctx)
    assert values(lake.stored("raw.transactions"), "transaction_id") == [("1",), ("2",)]


def test_bad_lines_and_undated_rows_are_kept(lake, feed, ctx, values):
    half = '{"transaction_id": "9", "created_at": "2002-01-01T00:00:00", "amount": '
    path = feed("a.json", [_trans("1", "2002-01-01"), half, _trans("8", "2002-13-45"), ""])
    days, report = _land(lake, path, ctx, files_at_once=1)
    assert days == [date(2002, 1, 1)]
    assert report.rejects == {"transactions lines": 1, "transactions undated": 1}
    assert values(lake.stored("raw.transactions"), "transaction_id") == [("1",)]
    lost = Arrivals(lake, "transactions").rows().where("cryear IS NULL")
    assert values(lost, "_corrupt_record") == [(None,), (half,)]


def test_an_empty_folder_and_a_raw_layer_landed_otherwise(spark, lake, tmp_path, feed, ctx):
    (tmp_path / "nothing").mkdir()
    assert _land(lake, str(tmp_path / "nothing"), ctx)[0] == []
    rows = spark.createDataFrame([], lake.stored("raw.transactions").schema)
    one = rows.unionByName(
        spark.range(1).selectExpr("'7' AS transaction_id", "2002 AS cryear", "1 AS crmonth", "1 AS crday"), allowMissingColumns=True
    )
    lake.append("raw.transactions", one)
    with pytest.raises(ValueError, match="landed otherwise"):
        _land(lake, feed("a.json", [_trans("1", "2002-01-01")]), ctx)


def test_an_incremental_load_over_arrivals(spark, stage, tmp_path, ctx, values):
    lake = Lake(spark, stage.path("lake"))
    inputs = {}
    for name in ("users", "transactions", "analytics"):
        (tmp_path / name).mkdir()
        inputs[name] = str(tmp_path / name)
    user = {"user_id": "1", "business_id": "1", "rating": "3", "created_at": "2002-01-01T00:00:00"}
    event = {"user_id": "1", "event_date": "20020101", "device": {"category": "mobile"}, "geo": {"city": "a"}}
    for name, row in (("users", user), ("transactions", _trans("1", "2002-01-01")), ("analytics", event)):
        (tmp_path / name / "a.json").write_text(json.dumps(row) + "\n")
    day = replace(ctx, mode=INCREMENTAL_LOAD)
    incremental_load(spark, inputs, lake, day, land=land_arrivals)
    (tmp_path / "transactions" / "b.json").write_text(json.dumps(_trans("2", "2002-01-01")) + "\n")
    report = incremental_load(spark, inputs, lake, day, land=land_arrivals)
    assert report.rows["raw.transactions"] == 1 and report.rows["consumption.profile_fact"] == 1
    assert values(lake.stored("curated.transactions"), "transaction_id") == [("1",), ("2",)]
    assert lake.stored("consumption.profile_fact").count() == 2
