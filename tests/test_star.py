"""Keys, dimensions, fact, report, audit."""

from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions.dates import with_iso_parts
from ledgerlake.operators import audit, curate, dims, fact, report
from ledgerlake.operators.skew import key_counts
from ledgerlake.operators.keys import dense_key, extend_keys
from ledgerlake.sinks.partitions import stamp


@pytest.fixture
def many_partitions(spark):
    """Keep small range partitions apart, so several of them take part."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _global_key(df, order, name):
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None, "hot", "hot", "hot"]), st.integers(0, 10**6)), unique=True, max_size=120))
def test_dense_key_equals_global_row_number(spark, stage, many_partitions, rows):
    df = stage.keep(spark.createDataFrame(rows, "u string, t bigint"), "in")
    got = {(r.u, r.t): r.k for r in dense_key(df, ["u", "t"], "k", stage).collect()}
    assert got == {(r.u, r.t): r.k for r in _global_key(df, ["u", "t"], "k").collect()}


def test_dense_key_splits_copies(spark, stage, many_partitions):
    """A third of the rows are copies of one row; they still spread over partitions, keys stay dense."""
    rows = [("same", 1)] * 1000 + [(f"u{i}", i) for i in range(2000)]
    df = stage.keep(spark.createDataFrame(rows, "u string, t bigint").repartition(6), "in")
    keyed = dense_key(df, ["u", "t"], "k", stage)
    assert sorted(r.k for r in keyed.collect()) == list(range(1, 3001))
    copies = spark.read.parquet(f"{stage.folder}/k-*").where(F.col("u") == "same")
    tasks = copies.groupBy(F.shiftright("_position", 33).alias("task")).count().collect()
    assert len(tasks) >= 2 and max(r["count"] for r in tasks) < 700


def test_dense_key_never_sorts_all_rows_in_one_task(spark, stage):
    df = stage.keep(spark.range(1000).toDF("t"), "in")
    plan = dense_key(df, ["t"], "k", stage)._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step works on the row counts of the partitions.
    above = plan[: plan.index("SinglePartition")]
    assert plan.count("SinglePartition") == 1 and "BroadcastExchange" in above


def test_extended_keys_continue(spark, stage):
    old = spark.createDataFrame([(1, "b"), (2, "c")], "k bigint, u string")
    new = stage.keep(spark.createDataFrame([("d",), ("a",)], "u string"), "in")
    assert {r.u: r.k for r in extend_keys(new, old, ["u"], "k", stage).collect()} == {"a": 3, "d": 4}
    first = extend_keys(new, old.limit(0), ["u"], "k", stage)
    assert {r.u: r.k for r in first.collect()} == {"a": 1, "d": 2}


# --- calendar --------------------------------------------------------------------------------------------


def _created(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "created_at string")


def test_calendar_has_the_last_day(spark):
    days = dims.date_dim(_created(spark, "2024-03-01T23:00:00", "2024-03-03T01:00:00", "junk"))
    assert [f.dataType for f in days.schema.fields] == [f.dataType for f in schemas.DATE_DIM.fields]
    rows = days.orderBy("trans_date").collect()
    assert [tuple(r) for r in rows] == [
        (1, date(2024, 3, 1), 2024, 3, 1, 1, 4, "Friday", 1, "Weekday"),
        (2, date(2024, 3, 2), 2024, 3, 1, 2, 5, "Saturday", 2, "Weekend"),
        (3, date(2024, 3, 3), 2024, 3, 1, 3, 6, "Sunday", 3, "Weekend"),
    ]
    assert dims.date_dim(_created(spark, "junk")).count() == 0


def test_calendar_grows_at_both_ends(spark, values):
    have = dims.date_dim(_created(spark, "2024-03-03", "2024-03-04"))
    more = dims.new_dates(spark, have, date(2024, 3, 1), date(2024, 3, 6))
    assert values(more, "date_id_pk", "trans_date") == [
        (3, date(2024, 3, 1)), (4, date(2024, 3, 2)), (5, date(2024, 3, 5)), (6, date(2024, 3, 6)),
    ]
    assert dims.new_dates(spark, have, date(2024, 3, 3), date(2024, 3, 4)).count() == 0
    assert values(dims.new_dates(spark, have.limit(0), date(2024, 3, 3), date(2024, 3, 3)), "date_id_pk") == [(1,)]


# --- analytics -------------------------------------------------------------------------------------------


def _event(user, day, **more):
    row = dict.fromkeys(schemas.names(schemas.CURATED_ANALYTICS))
    row.update(user_id=user, event_date=f"202403{day:02d}", cryear=2024, crmonth=3, crday=day, **more)
    return tuple(row[n] for n in schemas.names(schemas.CURATED_ANALYTICS))


def test_latest_event_looks_at_the_day(spark, values):
    df = spark.createDataFrame([_event("1", 3), _event("1", 17), _event("2", 5, city="a"), _event("2", 5, city="b")], schemas.CURATED_ANALYTICS)
    got = dims.analytics_latest(df)
    assert values(got, "user_id", "crday", "city") == [("1", 17, None), ("2", 5, "b")]


def test_merge_keeps_keys_and_takes_later_events(spark, stage, values):
    first = spark.createDataFrame([_event("b", 3, city="old"), _event("c", 9, city="kept")], schemas.CURATED_ANALYTICS)
    old = dims.analytics_dim(first, stage).withColumn("added_on", F.lit(date(2024, 3, 9)))
    new = spark.createDataFrame([_event("b", 5, city="new"), _event("c", 4, city="late"), _event("a", 5, city="x")], schemas.CURATED_ANALYTICS)
    got = dims.merge_analytics(old, new, date(2024, 3, 10), stage)
    assert values(got, "analytics_id_pk", "user_id", "city", "added_on", "isActive") == [
        (1, "b", "new", date(2024, 3, 9), "Y"),
        (2, "c", "kept", date(2024, 3, 9), "Y"),
        (3, "a", "x", date(2024, 3, 10), "Y"),
    ]


# --- fact, report, audit ---------------------------------------------------------------------------------


@pytest.fixture
def star(spark, stage, ctx):
    trans = spark.createDataFrame(
        [
            ("10", "u1", "b", "10", "debit", "t", "2024-03-01T10:00:00"),
            ("11", "u1", "b", "30", "credit", "t", "2024-03-05T10:00:00"),
            ("12", "u2", "b", "7", "debit", "t", "2024-04-05T10:00:00"),
            ("13", "quiet", "b", "99", "debit", "t", "2024-03-02T10:00:00"),
            ("14", "stranger", "b", "99", "debit", "t", "2024-03-02T10:00:00"),
            ("15", None, "b", "99", "debit", "t", "2024-03-02T10:00:00"),
            ("16", "u2", "b", "abc", "debit", "t", "2024-05-05T10:00:00"),
        ],
        schemas.TRANSACTIONS_FEED,
    )
    users = spark.createDataFrame([(u, "b", None, "2024-01-01") for u in ("u1", "u2", "quiet")], schemas.USERS_FEED)
    events = spark.createDataFrame([_event("u1", 3), _event("u2", 4), _event("stranger", 5)], schemas.CURATED_ANALYTICS)
    core = stage.keep(curate.trans_core(stamp(with_iso_parts(trans), ctx)), "core")
    profile = stage.keep(curate.profile_store(core), "profile")
    tables = {
        "user_dim": dims.user_dim(curate.curate_users(stamp(with_iso_parts(users), ctx), ctx), stage),
        "trans_store": dims.trans_dim_store(core, stage),
        "analytics_dim": dims.analytics_dim(dims.analytics_latest(events), stage),
        "date_dim": stage.keep(dims.date_dim(core), "date_dim"),
    }
    rows = fact.star_rows(tables["trans_store"], tables["user_dim"], tables["analytics_dim"], tables["date_dim"], key_counts(core, ["user_id"]))
    tables["store"] = fact.number_fact(stage.keep(rows, "rows"), stage)
    tables["gmv"] = stage.keep(fact.gmv_per_month(tables["store"]), "gmv")
    tables["fact"] = fact.profile_fact(tables["store"], tables["gmv"])
    wide = curate.curate_transactions(tables["trans_store"], profile, ("trans_id_pk", "isActive"))
    tables["profile"] = profile
    tables["trans_dim"] = wide.select(*schemas.names(schemas.TRANS_DIM))
    return tables


def test_fact_and_monthly_measures(star, values):
    assert schemas.names(star["fact"].schema) == schemas.names(schemas.PROFILE_FACT)
    assert values(star["fact"], "profile_id_pk", "gmv_per_month", "avgtranspermonth") == [
        (1, 40.0, 20.0), (2, 40.0, 20.0), (3, 7.0, 7.0), (4, None, None),
    ]
    assert values(star["gmv"], *star["gmv"].columns) == [(2024, 3, 40.0, 20.0), (2024, 4, 7.0, 7.0), (2024, 5, None, None)]
    total = star["store"].agg(F.sum("amount")).head()[0]
    assert float(total) == sum(r.gmv_per_month or 0 for r in star["gmv"].collect())


def _report_tables(star):
    return star["fact"], star["user_dim"], star["trans_dim"], star["date_dim"], star["analytics_dim"], star["profile"]


def test_report(star):
    df = report.star_report(*_report_tables(star))
    assert df.columns == ["profile_id_pk", *report.REPORT_COLUMNS]
    got = {(r.user_id, r.trans_date, r.amount, r.total_trans_count) for r in df.collect()}
    assert got == {
        ("u1", date(2024, 3, 1), "10", 2), ("u1", date(2024, 3, 5), "30", 2), ("u2", date(2024, 4, 5), "7", 2),
        ("u2", date(2024, 5, 5), None, 2),
    }
    top = report.star_report_top(*_report_tables(star), rows=2)
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])[:2]
    assert [tuple(r) for r in top.collect()] == want
    # Facts whose user is gone are no part of the report, nor of its first rows.
    broken = list(_report_tables(star))
    broken[1] = broken[1].where("user_id != 'u1'")
    assert [r.profile_id_pk for r in report.star_report_top(*broken, rows=2).collect()] == [3, 4]


def test_report_shuffles_transactions_once(spark, star, monkeypatch):
    """On the path of large dimensions: the transactions in one exchange, the fact in two."""
    import re

    from ledgerlake.operators import skew

    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = report.star_report(star["fact"], star["user_dim"], star["trans_store"], star["date_dim"], star["analytics_dim"], star["profile"])
        plan = df._jdf.queryExecution().executedPlan().toString()
        keyed = [re.sub(r"#[0-9]+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)]
        assert sum(x.startswith("trans_id_fk") for x in keyed) == 2  # the fact, and the transactions
        assert sum("_piece" in x for x in keyed) == 2  # the fact, and the users
        assert df.count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_audit_of_a_sound_star(star):
    got = {r.check_name: r.violations for r in audit.key_audit(star["store"], star["user_dim"], star["trans_store"], star["analytics_dim"], star["date_dim"]).collect()}
    assert got.pop("transactions without user") == 2  # the stranger's and the one without a user
    assert got.pop("transactions without events") == 2
    assert len(got) == 13 and set(got.values()) == {0}


def test_audit_finds_faults(star):
    broken = star["user_dim"].where(F.col("user_id") != "u1")
    twice = star["trans_store"].unionByName(star["trans_store"].where("transaction_id = '10'"))
    got = {r.check_name: r.violations for r in audit.key_audit(star["store"], broken, twice, star["analytics_dim"], star["date_dim"]).collect()}
    assert got["profile_fact rows without user_dim"] == 2
    assert got["trans_dim repeated keys"] == 1
    assert got["trans_dim repeated transactions"] == 1
    undated = star["trans_store"].withColumn("cryear", F.when(F.col("transaction_id") != "11", F.col("cryear")))
    users = star["user_dim"].unionByName(star["user_dim"].limit(1))
    events = star["analytics_dim"].unionByName(star["analytics_dim"].limit(1))
    got = {r.check_name: r.violations for r in audit.key_audit(star["store"], users, undated, events, star["date_dim"]).collect()}
    assert got["transactions without day"] == 1
    assert got["user_dim repeated users"] == 1 and got["analytics_dim repeated users"] == 1


def test_a_junk_year_does_not_stretch_the_broadcast(spark, star, monkeypatch):
    """With a calendar from year 1 on, only the days that occur are sent to the tasks."""
    from ledgerlake.operators import skew

    days = dims.calendar(spark.createDataFrame([(date(1, 1, 1), date(2024, 6, 1))], "min_trans_date date, max_trans_date date"))
    assert not skew.fits(days)
    rows = fact.star_rows(star["trans_store"], star["user_dim"], star["analytics_dim"], days, key_counts(star["trans_store"], ["user_id"]))
    assert sorted(r.transaction_id for r in rows.collect()) == ["10", "11", "12", "16"]
    sent = fact.calendar_of(days, star["trans_store"].select(fact.parts_date().alias("trans_date")), "trans_date")
    assert sent.count() == 5


def test_row_counts(spark):
    got = audit.row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()
    assert {r.table_name: r.row_count for r in got} == {"a": 3, "b": 0}
