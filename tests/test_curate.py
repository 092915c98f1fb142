"""Curation: de-duplication, profile, new rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.context import INCREMENTAL_LOAD, RunContext
from ledgerlake.functions.dates import with_iso_parts
from ledgerlake.operators import curate, newrows, skew
from ledgerlake.operators.newrows import incremental_new_rows, new_records, new_rows, without_key
from ledgerlake.operators.skew import fits, hot_keys, join_unique, key_counts, row_id
from ledgerlake.sinks.partitions import stamp



def columns(schema):
    """Names and types; whether a column can be NULL is not part of a contract."""
    return [(f.name, f.dataType) for f in schema.fields]


def _trans(spark, rows):
    """(transaction_id, user_id, amount, transaction_type)"""
    full = [(t, u, "b", a, k, "t", "2024-03-01T10:00:00") for t, u, a, k in rows]
    return spark.createDataFrame(full, schemas.TRANSACTIONS_FEED)


def test_users_fill_and_age(spark, ctx):
    df = spark.createDataFrame(
        [("1", "b", None, "2001-12-31T09:00:00"), ("2", "b", "4", "junk")], schemas.USERS_FEED
    )
    got = curate.curate_users(stamp(with_iso_parts(df), ctx), ctx)
    assert columns(got.schema) == columns(schemas.CURATED_USERS)
    rows = {r.user_id: r for r in got.collect()}
    assert (rows["1"].rating, rows["1"].signup_since_days) == ("0", 1)
    assert (rows["2"].rating, rows["2"].signup_since_days) == ("4", None)


def test_dedupe_takes_the_latest_and_is_total(spark, values):
    rows = [("1", "b2", "1", "2024-01-01"), ("1", "b1", "2", "2024-01-02"), ("1", "b0", "3", "2024-01-02"), ("2", "b", None, "2023")]
    df = spark.createDataFrame(rows, schemas.USERS_FEED)
    want = [("1", "b0", "3"), ("2", "b", None)]
    assert values(curate.dedupe_users(df), "user_id", "business_id", "rating") == want
    assert values(curate.dedupe_users(df.orderBy(F.desc("business_id"))), "user_id", "business_id", "rating") == want


def test_first_per_key_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([("1", "b", "1", "2024")], schemas.USERS_FEED)
    plan = curate.dedupe_users(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_profile_counts_only_debit_and_credit(spark):
    df = _trans(spark, [("1", "u", "1500000", "debit"), ("2", "u", "2500000", "credit"), ("3", "u", "9000000", "other"), ("4", "v", "1", "other")])
    rows = {r.user_id: tuple(r)[1:] for r in curate.trans_profile(df).collect()}
    assert rows == {"u": (1, 1, 2, 1.5, 2.5, 4.0), "v": (0, 0, 0, 0.0, 0.0, 0.0)}


def test_profile_of_unreadable_amounts(spark):
    """An amount that is not a number counts as a row; the sum is NULL only if there is nothing else."""
    df = _trans(spark, [("1", "u", None, "debit"), ("2", "v", "abc", "debit"), ("3", "v", "x", "other"), ("4", "w", None, "debit"), ("5", "w", None, "credit")])
    rows = {r.user_id: tuple(r)[1:] for r in curate.trans_profile(df).collect()}
    assert rows["u"] == (1, 0, 1, None, 0.0, None)
    assert rows["v"] == (1, 0, 1, 0.0, 0.0, 0.0)
    assert rows["w"] == (1, 1, 2, 0.0, 0.0, None)
    reject = df.agg(curate.amount_rejects().alias("n")).head().n
    assert reject == 2
    core = curate.trans_core(stamp(with_iso_parts(df), RunContext(date(2024, 3, 2), datetime(2024, 3, 2))))
    assert {r.transaction_id: r.amount for r in core.collect()}["2"] is None
    assert {r.trans_date for r in core.collect()} == {"2024-3-1"}


def test_profile_of_daily_equals_profile(spark, values):
    days = ["2024-03-01T10:00:00", "2024-03-02T10:00:00", "2024-04-01T10:00:00"]
    kinds = ["debit", "credit", "other", None]
    rows = [
        (str(i), f"u{i % 7}" if i % 11 else None, "b", None if i % 5 == 0 else f"{i * 1371}.{i % 100:02d}", kinds[i % 4], "t", days[i % 3])
        for i in range(200)
    ]
    feed = spark.createDataFrame(rows, schemas.TRANSACTIONS_FEED)
    core = curate.trans_core(stamp(with_iso_parts(feed), RunContext(date(2024, 4, 2), datetime(2024, 4, 2))))
    split = curate.profile_of_daily(curate.trans_daily(core))
    assert values(split, *split.columns) == values(curate.profile_store(core), *split.columns)
    assert columns(curate.trans_daily(core).schema) == columns(schemas.TRANS_DAILY)
    assert [f.name for f in split.schema.fields] == schemas.names(schemas.PROFILE_STORE)
    for r in split.collect():
        assert r.debit_count + r.credit_count == r.total_trans_count


def test_transaction_without_user_is_kept(spark, stage, ctx):
    df = _trans(spark, [("1", None, "5", "debit"), ("2", "u", "5", "debit")])
    core = curate.trans_core(stamp(with_iso_parts(df), ctx))
    got = curate.curate_transactions(core, stage.keep(curate.profile_store(df), "profile"))
    assert columns(got.schema) == columns(schemas.CURATED_TRANSACTIONS)
    rows = {r.transaction_id: r for r in got.collect()}
    assert rows["1"].debit_count is None and rows["2"].debit_count == 1


# --- joins with heavy keys -------------------------------------------------------------------------------


@pytest.fixture
def skewed(spark, stage):
    """A third of 3,000 rows belong to one key, another third have no key; some keys have no match."""
    def key(i):
        return "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 50}"

    left = spark.createDataFrame([(key(i), "copy" if i % 2 else str(i)) for i in range(3000)], "k string, v string")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 50, 4)], "k string, w int")
    return stage.keep(left, "left"), stage.keep(right, "right")


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_join_of_pieces_equals_plain_join(skewed, how, values, monkeypatch):
    left, right = skewed
    with monkeypatch.context() as patch:
        patch.setattr(skew, "BROADCAST_BYTES", -1)
        got = join_unique(left, right, ["k"], how, key_counts(left, ["k"]), row_id())
    want = left.join(right, "k", how)
    assert values(got, *want.columns) == values(want, *want.columns)
    small = join_unique(left, right, ["k"], how, key_counts(left, ["k"]), row_id())
    assert values(small, *want.columns) == values(want, *want.columns)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_heavy_keys_are_cut_up(spark, skewed):
    left, _ = skewed
    counts = key_counts(left.where("k is not null"), ["k"])
    hot = {r.k: r["_pieces"] for r in hot_keys(counts, ["k"], pieces=10).collect()}
    assert hot == {"hot": 5}  # half of 2,000 rows in tenths
    many = hot_keys(counts, ["k"], pieces=100).collect()
    assert len(many) <= 100 and sum(r["_pieces"] for r in many) <= 200


def test_no_task_gets_the_heavy_key(spark, skewed, monkeypatch):
    """Rows per shuffle partition of the joined result stay near an even share."""
    left, right = skewed
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = join_unique(left, right, ["k"], "left", key_counts(left, ["k"]), row_id())
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 3000 and max(sizes) < 1000


def test_fits(spark, stage):
    df = stage.keep(spark.range(10), "ten")
    size = skew.stored_bytes(df)
    assert 0 < size < 100_000 and fits(df, size) and not fits(df, size - 1)
    # Columns joined on add the files they come from; a source of unknown size never fits.
    assert skew.stored_bytes(df.join(df.withColumnRenamed("id", "other"), F.col("id") == F.col("other"))) == 2 * size
    assert not fits(spark.createDataFrame([(1,)], "k int").rdd.toDF())


def test_sizes_cost_no_job(spark, stage):
    """A join on a table of 400 files looks at no file but those it joins."""
    many = stage.keep(spark.range(400).repartition(400).withColumnRenamed("id", "k"), "many")
    few = stage.keep(spark.range(5).withColumnRenamed("id", "k"), "few")
    counts = key_counts(few, ["k"])
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("sizes", "sizes")
    try:
        joined = join_unique(few, many, ["k"], "left", counts, row_id())
        fresh = new_rows(few, many, ["k"], unique=True)
        assert list(tracker.getJobIdsForGroup("sizes")) == []
    finally:
        context._jsc.clearJobGroup()
    assert joined.count() == 5 and fresh.count() == 0


# --- new rows --------------------------------------------------------------------------------------------


def test_new_rows_and_null_keys(spark, stage, values):
    source = spark.createDataFrame([("1",), ("2",), (None,)], "user_id string")
    existing = spark.createDataFrame([("1",), ("1",)], "user_id string")
    assert values(new_rows(source, existing, ["user_id"]), "user_id") == [("2",)]
    assert values(without_key(source, ["user_id"]), "user_id") == [(None,)]


@pytest.mark.parametrize("unique", [True, False])
def test_new_rows_of_a_large_source(spark, stage, values, monkeypatch, unique):
    """The shuffled path, with one key on a third of the source rows."""
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    source = stage.keep(spark.createDataFrame([("hot" if i % 3 == 0 else f"k{i}", i) for i in range(600)], "k string, v int"), "s")
    known = ["hot"] + [f"k{i}" for i in range(0, 600, 7)]
    existing = stage.keep(spark.createDataFrame([(k,) for k in (known if unique else known * 3)], "k string"), "e")
    want = source.where(~F.col("k").isin(known))
    assert values(new_rows(source, existing, ["k"], unique), "k", "v") == values(want, "k", "v")
    assert values(new_rows(source, existing.where("k != 'hot'"), ["k"], unique), "k", "v") == values(want.union(source.where("k = 'hot'")), "k", "v")


def test_new_records_compare_nulls(spark, values):
    columns = "user_id string, city string"
    source = spark.createDataFrame([("1", None), ("1", "x"), (None, None), ("2", None), ("2", None)], columns)
    existing = spark.createDataFrame([("1", None), (None, None)], columns)
    got = sorted(map(tuple, new_records(source, existing, ["user_id", "city"]).collect()), key=str)
    assert got == [("1", "x"), ("2", None), ("2", None)]


def test_new_records_of_a_large_source(spark, stage, values, monkeypatch):
    """The shuffled path on whole records: a third are exact copies, some fields are NULL."""
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    columns = "user_id string, city string"
    rows = [("copy", None) if i % 3 == 0 else (f"u{i}", None if i % 2 else "x") for i in range(600)]
    source = stage.keep(spark.createDataFrame(rows, columns), "s")
    some = [("copy", None)] * 40 + [r for r in rows if r[0][-1] in "14"]
    keep = [r for r in rows if r not in some]
    existing = stage.keep(spark.createDataFrame(some, columns), "e")
    key = lambda r: (r[0], str(r[1]))
    got = new_records(source, existing, ["user_id", "city"])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(keep, key=key)
    none = new_records(source, existing.limit(0), ["user_id", "city"])
    assert sorted(map(tuple, none.collect()), key=key) == sorted(rows, key=key)


def test_incremental_rows_of_the_day(spark, values):
    columns = "transaction_id string, amount string, cryear int, crmonth int, crday int"
    source = spark.createDataFrame([("1", "5", 2024, 3, 1), ("2", "5", 2024, 3, 2), ("3", "7", 2024, 3, 2)], columns)
    curated = spark.createDataFrame([("1", "5", 2024, 3, 1), ("2", "4", 2024, 3, 2)], columns)
    today = RunContext(date(2024, 3, 2), datetime(2024, 3, 2, 9), INCREMENTAL_LOAD)
    night = RunContext(date(2024, 3, 2), datetime(2024, 3, 2, 0, 5), INCREMENTAL_LOAD, True)
    key = ["transaction_id"]
    assert values(incremental_new_rows(source, curated, today, key, True), "transaction_id") == [("3",)]
    assert values(incremental_new_rows(source, curated, night, key, True), "transaction_id") == []
    first = incremental_new_rows(source, curated.limit(0), today, key, True)
    assert values(first, "transaction_id") == [("2",), ("3",)]
