"""Month filters of keys: they never miss, seldom pass, and say which months are read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators import sketches
from ledgerlake.operators.newrows import new_rows
from ledgerlake.plans.lake import Lake

TABLE, KEY = "curated.transactions", "transaction_id"


def _rows(spark, ids, months=12):
    """Rows whose month follows from their number."""
    core = {f.name: F.lit(None).cast(f.dataType) for f in schemas.TRANS_CORE.fields}
    number = F.col("n")
    core |= {KEY: F.concat(F.lit("t"), number), "cryear": F.lit(2024), "crmonth": (number % months + 1).cast("int"), "crday": F.lit(1)}
    return spark.createDataFrame([(i,) for i in ids], "n long").select(*[c.alias(name) for name, c in core.items()])


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.write_version(TABLE, _rows(spark, range(6000)))
    lake.write_filters(TABLE)
    return lake


def test_every_key_is_found_and_few_others(spark, lake):
    filters = lake.filters(TABLE)
    words = sketches._word(KEY, filters.head()["words"]).alias("word")
    ask = lambda ids: _rows(spark, ids, 1).select(KEY, words, sketches._bits(KEY).alias("wanted"))
    hits = lambda ids: filters.join(ask(ids), "word").where(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    own = hits(range(6000)).where(F.col("crmonth") == F.substring(KEY, 2, 9).cast("int") % 12 + 1)
    assert own.select(KEY).distinct().count() == 6000
    assert hits(range(100_000, 110_000)).count() < 10_000 * 12 * 0.005


def test_only_months_that_may_hold_a_key_are_read(spark, lake, values):
    sent = _rows(spark, [3, 15, 27, *range(90_000, 90_005)])
    months = sketches.months_that_may_hold(sent, lake.filters(TABLE), KEY)
    assert (2024, 4) in months and len(months) <= 2  # of twelve; a filter may let one stray key through
    fresh = sketches.new_rows_by_month(sent, lake.stored(TABLE), lake.filters(TABLE), KEY)
    assert values(fresh, KEY) == values(new_rows(sent, lake.stored(TABLE), [KEY], unique=True), KEY)
    assert [r[0] for r in values(fresh, KEY)] == [f"t{i}" for i in range(90_000, 90_005)]
    plan = sketches.of_months(lake.stored(TABLE), [(2024, 4)])
    assert plan.count() == 500 and "crmonth" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("PushedFilters")[0]


def test_added_keys_are_known_and_a_key_moves_months(spark, lake, values):
    more = _rows(spark, range(6000, 6100), months=7)
    lake.append_filters(TABLE, more)
    lake.append(TABLE, more)
    # The same ids under another month are still the same rows.
    again = _rows(spark, range(5950, 6110), months=5)
    fresh = sketches.new_rows_by_month(again, lake.stored(TABLE), lake.filters(TABLE), KEY)
    assert [r[0] for r in values(fresh, KEY)] == sorted(f"t{i}" for i in range(6100, 6110))


def test_null_keys_empty_tables_and_no_filters(spark, tmp_path, values):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.create_missing()
    sent = _rows(spark, range(5)).unionByName(_rows(spark, [9]).withColumn(KEY, F.lit(None).cast("string")))
    assert sketches.months_that_may_hold(sent, lake.filters(TABLE), KEY) == []
    fresh = sketches.new_rows_by_month(sent, lake.stored(TABLE), lake.filters(TABLE), KEY)
    assert [r[0] for r in values(fresh, KEY)] == [f"t{i}" for i in range(5)]
    lake.append_filters(TABLE, fresh)
    lake.append(TABLE, fresh)
    assert sketches.new_rows_by_month(sent, lake.stored(TABLE), lake.filters(TABLE), KEY).count() == 0
    # A month that is NULL is a month.
    odd = _rows(spark, [77]).withColumn("crmonth", F.lit(None).cast("int"))
    lake.append_filters(TABLE, odd)
    lake.append(TABLE, odd)
    assert sketches.new_rows_by_month(_rows(spark, [77]), lake.stored(TABLE), lake.filters(TABLE), KEY).count() == 0


def test_versions_and_packing_keep_filters(spark, lake):
    for i in range(3):
        lake.append_filters(TABLE, _rows(spark, range(7000 + i, 7003 + i)))
        lake.append(TABLE, _rows(spark, range(7000 + i, 7003 + i)))
    old = lake.path(TABLE)
    lake.compact(TABLE)
    assert lake.path(TABLE) != old
    months = sketches.months_that_may_hold(_rows(spark, [7002]), lake.filters(TABLE), KEY)
    assert (2024, 7002 % 12 + 1) in months
    # A new version without filters has none; the one before keeps its own.
    lake.write_version(TABLE, _rows(spark, range(3)))
    assert lake.filters(TABLE) is None
