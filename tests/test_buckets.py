"""Tables by user: a day rewrites the buckets of its users and no others."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators import curate, dims
from ledgerlake.plans.lake import Lake, bucket_of
from ledgerlake.plans.loads import refresh_profile

PROFILE, DIM = "curated.trans_profile", "consumption.analytics_dim"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def _files(lake, table):
    """Data files by bucket."""
    found = {}
    for file in Path(lake.path(table)).rglob("*.parquet"):
        found.setdefault(int(file.parent.name.split("=")[1]), set()).add(file.name)
    return found


def _core(spark, rows):
    feed = spark.createDataFrame(
        [(str(n), u, "b", amount, kind, "t", f"2024-03-{day:02d}T10:00:00") for n, (u, amount, kind, day) in enumerate(rows)], schemas.TRANSACTIONS_FEED
    )
    from ledgerlake.context import RunContext
    from datetime import datetime
    from ledgerlake.functions.dates import with_iso_parts
    from ledgerlake.sinks.partitions import stamp

    return curate.trans_core(stamp(with_iso_parts(feed), RunContext(date(2024, 3, 9), datetime(2024, 3, 9))))


def test_profile_of_a_day(spark, lake, values):
    old = [(f"u{i}", str(i), "debit" if i % 2 else "credit", i % 4 + 1) for i in range(200)] + [(None, "5", "debit", 1)]
    today = [("u3", "10.5", "credit", 7), ("u3", "abc", "debit", 7), ("new", "1", "debit", 7), (None, "2", "debit", 7)]
    before, core = curate.trans_daily(_core(spark, old)), _core(spark, old + today)
    lake.write_version("curated.trans_daily", before)
    lake.write_version(PROFILE, curate.profile_of_daily(before))
    files = _files(lake, PROFILE)
    touched = {r["b"] for r in core.where("crday = 7").select(bucket_of("user_id").alias("b")).collect()}
    day = date(2024, 3, 7)
    for _ in range(2):
        lake.replace_day("curated.trans_daily", curate.trans_daily(core), day)
        assert refresh_profile(lake, day) > 0
        got, want = lake.read(PROFILE), curate.trans_profile(core)
        assert values(got, *got.columns) == values(want, *got.columns)
        now = _files(lake, PROFILE)
        assert {b for b in now if now[b] != files.get(b)} == touched and len(touched) <= 3 < len(files)
        files = now
    # A day without rows touches nothing.
    assert refresh_profile(lake, date(2024, 3, 8)) == 0 and _files(lake, PROFILE) == files


def test_latest_events_of_a_day(spark, lake, stage, values):
    def events(rows):
        columns = schemas.names(schemas.CURATED_ANALYTICS)
        blank = dict.fromkeys(columns)
        made = [tuple((blank | {"user_id": u, "city": city, "cryear": 2024, "crmonth": 3, "crday": day})[c] for c in columns) for u, city, day in rows]
        return stage.keep(spark.createDataFrame(made, schemas.CURATED_ANALYTICS), "events")

    old = [(f"u{i:03d}", f"c{i}", i % 4 + 1) for i in range(150)]
    today = [("u003", "moved", 7), ("u004", "late", 0), ("zz", "fresh", 7)]
    added = F.lit(date(2024, 3, 6)).alias("added_on")
    lake.write_version(DIM, dims.analytics_dim(dims.analytics_latest(events(old)), stage).select("*", added))
    files, keys = _files(lake, DIM), {r.user_id: r.analytics_id_pk for r in lake.read(DIM).collect()}
    latest = dims.analytics_latest(events(today))
    for _ in range(2):
        buckets = lake.buckets_of(DIM, latest)
        merged = dims.merge_analytics(lake.in_buckets(DIM, buckets), latest, date(2024, 3, 7), stage, lake.stored(DIM))
        lake.replace_buckets(DIM, merged)
        rows = {r.user_id: r for r in lake.read(DIM).collect()}
        assert len(rows) == 151 and lake.read(DIM).count() == 151
        assert {u: rows[u].analytics_id_pk for u in keys} == keys and rows["zz"].analytics_id_pk == 151
        assert (rows["u003"].city, rows["u004"].city, rows["zz"].city) == ("moved", "c4", "fresh")
        now = _files(lake, DIM)
        assert {b for b in now if now[b] != files.get(b)} == set(buckets) and len(buckets) <= 3 < len(files)
        files = now


def test_a_bucketed_table_in_the_catalog_and_packed(spark, lake, values):
    core = _core(spark, [(f"u{i}", "1", "debit", 1) for i in range(50)])
    lake.write_version(PROFILE, curate.profile_store(core))
    lake.register("bucketed")
    assert spark.table("bucketed_curated.trans_profile").count() == 50
    before = values(lake.read(PROFILE), "user_id", "debit_count")
    lake.append(PROFILE, lake.stored(PROFILE).limit(0))
    assert lake.compact(PROFILE) == len(_files(lake, PROFILE))
    assert values(lake.read(PROFILE), "user_id", "debit_count") == before
