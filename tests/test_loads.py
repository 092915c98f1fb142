"""Whole loads: full, incremental, repeated, refreshed."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.context import FULL_LOAD, INCREMENTAL_LOAD, RunContext
from ledgerlake.operators import audit
from ledgerlake.plans.lake import Lake
from ledgerlake.plans.loads import load


def _user(u, day, rating=None):
    return {"user_id": u, "business_id": "b", "rating": rating, "created_at": f"2024-03-{day:02d}T08:00:00Z"}


def _trans(t, u, amount, kind, day, month=3):
    return {"transaction_id": t, "user_id": u, "business_id": "b", "amount": amount, "transaction_type": kind,
            "type": "cash", "created_at": f"2024-{month:02d}-{day:02d}T09:30:00Z"}


def _event(u, day, city, version="1"):
    return {"user_id": u, "event_date": f"202403{day:02d}", "device": {"category": "mobile"}, "geo": {"city": city},
            "app_info": {"version": version}}


USERS = {
    1: [_user("u1", 1, "3"), _user("u1", 1, "4"), _user("u2", 1), _user(None, 1)],
    2: [_user("u3", 2)],
    3: [_user("u4", 3)],
}
TRANS = {
    1: [_trans("10", "u1", "100.10", "debit", 1), _trans("11", "u3", "7", "credit", 1)],
    2: [_trans("12", "u1", "200", "credit", 2), _trans("13", "u2", "abc", "debit", 2), _trans("14", None, "5", "other", 2)],
    3: [_trans("15", "u3", "1000000", "debit", 3), _trans("16", "nobody", "9", "debit", 3)],
}
EVENTS = {
    1: [_event("u1", 1, "a"), _event("u1", 1, "b")],
    2: [_event("u3", 2, "c"), _event("u1", 2, "d"), _event("u1", 2, "d")],
    3: [_event("u2", 3, "e")],
}


def _through(feed, day):
    return [r for d, rows in feed.items() if d <= day for r in rows]


def _inputs(write_lines, day):
    return {
        "users": write_lines(f"users{day}", _through(USERS, day)),
        "transactions": write_lines(f"transactions{day}", _through(TRANS, day)),
        "analytics": write_lines(f"analytics{day}", _through(EVENTS, day)),
    }


def _run(day, mode, hour=12, minute=0):
    return RunContext.at(datetime(2024, 3, day, hour, minute), mode)


def _content(lake, values):
    """Every table by natural keys; surrogate keys and load times may differ between ways of loading."""
    star = lake.read("consumption.profile_fact").alias("f")
    fact = (
        star.join(lake.read("consumption.trans_dim"), F.col("f.trans_id_fk") == F.col("trans_id_pk"))
        .join(lake.read("consumption.date_dim").select("date_id_pk", F.col("trans_date").alias("day")), F.col("f.date_id_fk") == F.col("date_id_pk"))
        .join(lake.read("consumption.user_dim").select("user_id_pk", F.col("user_id").alias("u")), F.col("f.user_id_fk") == F.col("user_id_pk"))
        .join(lake.read("consumption.analytics_dim").select("analytics_id_pk", F.col("user_id").alias("a")), F.col("f.analytics_id_fk") == F.col("analytics_id_pk"))
        .select("transaction_id", "u", "a", "day", "gmv_per_month", "avgtranspermonth")
    )
    content = {"fact": values(fact, *fact.columns)}
    volatile = {"processed_at", "signup_since_days", "date_id_pk", "user_id_pk", "trans_id_pk", "analytics_id_pk"}
    for table in schemas.STORED:
        if table != "consumption.profile_fact":
            df = lake.read(table)
            content[table] = values(df, *[c for c in df.columns if c not in volatile])
    return content


@pytest.fixture
def lake_of(spark, tmp_path):
    return lambda name: Lake(spark, str(tmp_path / name))


def test_full_equals_day_by_day(spark, write_lines, lake_of, values):
    full, daily = lake_of("full"), lake_of("daily")
    report = load(spark, _inputs(write_lines, 3), full, _run(3, FULL_LOAD))
    for day in (1, 2, 3):
        load(spark, _inputs(write_lines, day), daily, _run(day, INCREMENTAL_LOAD))
    want = _content(full, values)
    assert _content(daily, values) == want
    assert [r[0] for r in want["fact"]] == ["10", "11", "12", "13", "15"]
    assert report.rows["raw.users"] == 6 and report.rows["curated.users"] == 4
    assert report.rejects == {
        "users lines": 0, "transactions lines": 0, "analytics lines": 0, "users without key": 1,
        "transactions without key": 0, "transactions amounts": 1, "users undated": 0, "transactions undated": 0,
        "analytics undated": 0,
    }

    # Running a day again changes nothing, keys included.
    keys = lambda: values(daily.read("consumption.profile_fact"), "profile_id_pk", "trans_id_fk", "user_id_fk", "analytics_id_fk", "date_id_fk")
    before = keys()
    again = load(spark, _inputs(write_lines, 3), daily, _run(3, INCREMENTAL_LOAD, 18))
    assert _content(daily, values) == want and keys() == before
    assert again.rows["consumption.profile_fact"] == 0 and again.rows["curated.transactions"] == 0
    # So does the late look at yesterday.
    load(spark, _inputs(write_lines, 3), daily, _run(4, INCREMENTAL_LOAD, 0, 5))
    assert _content(daily, values) == want and keys() == before

    checks = audit.key_audit(
        daily.stored("consumption.profile_fact"), daily.stored("consumption.user_dim"), daily.stored("consumption.trans_dim"),
        daily.stored("consumption.analytics_dim"), daily.stored("consumption.date_dim"),
    ).collect()
    assert {r.check_name for r in checks if r.violations} == {"transactions without user", "transactions without events"}


def test_full_load_twice_and_a_new_user(spark, write_lines, lake_of, values):
    lake = lake_of("lake")
    keys = lambda: {r.user_id: r.user_id_pk for r in lake.read("consumption.user_dim").collect()}
    load(spark, _inputs(write_lines, 2), lake, _run(2, FULL_LOAD))
    first = _content(lake, values)
    load(spark, _inputs(write_lines, 2), lake, _run(2, FULL_LOAD))
    assert _content(lake, values) == first
    assert keys() == {"u1": 1, "u2": 2, "u3": 3}
    load(spark, _inputs(write_lines, 3), lake, _run(3, INCREMENTAL_LOAD))
    assert keys() == {"u1": 1, "u2": 2, "u3": 3, "u4": 4}
    # The user of a second day is in the table once.
    days = {"users": write_lines("u", [_user("u1", 4)]), "transactions": write_lines("t", []), "analytics": write_lines("a", [])}
    load(spark, days, lake, _run(4, INCREMENTAL_LOAD))
    assert keys() == {"u1": 1, "u2": 2, "u3": 3, "u4": 4}
    assert lake.read("curated.users").where("user_id = 'u1'").count() == 1


def test_resent_transaction(spark, write_lines, lake_of):
    """The append path keeps the first amount; replacing the day brings the new one."""
    lake = lake_of("lake")
    amount = lambda t: lake.read("curated.transactions").where(F.col("transaction_id") == t).head().amount
    load(spark, _inputs(write_lines, 1), lake, _run(1, FULL_LOAD))
    inputs = _inputs(write_lines, 1)
    inputs["transactions"] = write_lines("resent", [_trans("10", "u1", "555", "debit", 1)])
    load(spark, inputs, lake, _run(1, INCREMENTAL_LOAD, 20))
    assert amount("10") == "100.10"
    fresh = lake.stored("raw.transactions").withColumn("trans_date", F.concat_ws("-", *schemas.DAY_PARTS))
    lake.replace_day("curated.transactions", fresh, date(2024, 3, 1))
    assert amount("10") == "555"


def test_bad_lines_are_kept(spark, write_lines, lake_of):
    lake = lake_of("lake")
    inputs = _inputs(write_lines, 1)
    inputs["users"] = write_lines("bad", [_user("u1", 1), "{broken", _user("u2", 1)])
    report = load(spark, inputs, lake, _run(1, FULL_LOAD))
    assert report.rejects["users lines"] == 1 and report.rows["raw.users"] == 2
    kept = spark.read.parquet(f"{lake.root}/quarantine/users_lines/full").collect()
    assert [r[0] for r in kept] == ["{broken"]


def test_contracts_and_catalog(spark, write_lines, lake_of):
    lake = lake_of("lake")
    load(spark, _inputs(write_lines, 3), lake, _run(3, FULL_LOAD))
    contracts = {
        "raw.users": schemas.SOURCE_USERS, "raw.transactions": schemas.SOURCE_TRANSACTIONS,
        "raw.analytics": schemas.SOURCE_ANALYTICS, "curated.users": schemas.CURATED_USERS,
        "curated.transactions": schemas.CURATED_TRANSACTIONS, "curated.trans_profile": schemas.TRANS_PROFILE,
        "curated.analytics": schemas.CURATED_ANALYTICS, "consumption.date_dim": schemas.DATE_DIM,
        "consumption.user_dim": schemas.USER_DIM, "consumption.trans_dim": schemas.TRANS_DIM,
        "consumption.analytics_dim": schemas.ANALYTICS_DIM, "consumption.profile_fact": schemas.PROFILE_FACT,
        "consumption.gmv_per_month": schemas.GMV,
    }
    for table, schema in contracts.items():
        got = lake.read(table).schema
        assert [(f.name, f.dataType) for f in got.fields] == [(f.name, f.dataType) for f in schema.fields], table
    for _ in range(2):
        names = lake.register("loadtest")
        assert len(names) == len(schemas.STORED)
    assert spark.table("loadtest_raw.transactions").count() == 7
    assert spark.sql("SELECT count(*) FROM loadtest_consumption.profile_fact WHERE trans_month = 3").head()[0] == 5


def _odd_feeds(write_lines, day):
    """Feeds with lines of the wrong type, bad dates, and ids and events sent again in later polls."""
    users = _through(USERS, day) + [dict(_user("lost", 1), created_at="soon"), dict(_user("never", 1), created_at="2024-13-01T00:00:00Z")]
    trans = _through(TRANS, day) + [_trans("10", "u1", "100.10", "debit", 1), dict(_trans("17", "u1", "3", "debit", 1), created_at=None), '{"transaction_id": ']
    events = _through(EVENTS, day) + [{"user_id": "u9", "event_date": "20241340"}, '{"event_date": "20240301", "user_id": "u8", "device": "oops"}']
    if day > 1:
        trans += [_trans("10", "u1", "555", "debit", 2), _trans("11", "u3", "8", "credit", 2)]
        events += [_event("u1", 1, "a"), _event("u3", 2, "c")]
    return {"users": write_lines(f"ou{day}", users), "transactions": write_lines(f"ot{day}", trans), "analytics": write_lines(f"oa{day}", events)}


def test_odd_feeds_load_alike(spark, write_lines, lake_of, values):
    """Nothing is lost, and two polls of a day, or a full load, agree."""
    full, daily = lake_of("full"), lake_of("daily")
    inputs = _odd_feeds(write_lines, 3)
    report = load(spark, inputs, full, _run(3, FULL_LOAD))
    for day, hour in ((1, 9), (1, 18), (2, 9), (2, 18), (3, 9)):
        polled = load(spark, _odd_feeds(write_lines, day), daily, _run(day, INCREMENTAL_LOAD, hour))
    want, got = _content(full, values), _content(daily, values)
    # The raw layer holds what was sent: the copy of an event of day 1 that came on day 2 is in the full dump alone.
    assert {k: v for k, v in got.items() if k != "raw.analytics"} == {k: v for k, v in want.items() if k != "raw.analytics"}
    ids = [r.transaction_id for r in full.read("curated.transactions").collect()]
    assert len(ids) == len(set(ids)) and full.read("curated.transactions").where("transaction_id = '10'").head().amount == "100.10"
    for feed, path in inputs.items():
        lines = spark.read.text(path).count()
        assert report.rows[f"raw.{feed}"] + report.rejects[f"{feed} lines"] + report.rejects[f"{feed} undated"] == lines
        for kind in ("lines", "undated"):
            assert polled.rejects[f"{feed} {kind}"] == report.rejects[f"{feed} {kind}"]
            for lake, run in ((full, "full"), (daily, "2024-03-03")):
                if report.rejects[f"{feed} {kind}"]:
                    kept = spark.read.parquet(f"{lake.root}/quarantine/{feed}_{kind}/{run}")
                    assert len(kept.collect()) == report.rejects[f"{feed} {kind}"]
    assert report.rejects["users undated"] == 2 and report.rejects["transactions undated"] == 1
    assert report.rejects["analytics undated"] == 1 and report.rejects["analytics lines"] == 1


def test_versions_are_numbers(spark, lake_of):
    lake = lake_of("lake")
    table = "curated.trans_profile"
    rows = lambda n: spark.createDataFrame([(str(n), *[None] * 7)], schemas.PROFILE_STORE)
    rows(0).write.parquet(f"{lake.folder(table)}/v9999")
    for n in (10000, 10001):
        lake.write_version(table, rows(n))
        assert lake.path(table).endswith(f"/v{n}")
        assert lake.read(table).head().user_id == str(n)
    assert lake._taken(table) == [10000, 10001]


def test_a_user_who_is_heavy_only_today(spark, write_lines, lake_of, values, monkeypatch):
    """The shuffled joins of an incremental load, with most of the day on one user who was quiet before."""
    from ledgerlake.operators import skew

    trans = {1: [_trans(f"a{i}", f"u{i % 3 + 1}", "1", "debit", 1) for i in range(60)], 2: [_trans(f"b{i}", "u1", "2", "credit", 2) for i in range(40)]}
    inputs = lambda day: {"users": write_lines(f"hu{day}", _through(USERS, 3)), "transactions": write_lines(f"ht{day}", _through(trans, day)), "analytics": write_lines(f"ha{day}", _through(EVENTS, 3))}
    full, daily = lake_of("full"), lake_of("daily")
    load(spark, inputs(2), full, _run(2, FULL_LOAD))
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    load(spark, inputs(1), daily, _run(3, FULL_LOAD))
    load(spark, inputs(2), daily, _run(2, INCREMENTAL_LOAD))
    got, want = _content(daily, values), _content(full, values)
    assert got["fact"] == want["fact"] and len(want["fact"]) == 100
    assert got["curated.trans_profile"] == want["curated.trans_profile"]


def test_the_fact_is_read_by_month(spark, write_lines, lake_of):
    """Of the fact, a run reads the month folders of its rows only."""
    from ledgerlake.plans.loads import _of_months

    lake = lake_of("lake")
    inputs = _inputs(write_lines, 3)
    trans = [*_through(TRANS, 3), _trans("20", "u1", "4", "debit", 1, month=1), _trans("21", "u1", "4", "debit", 1, month=2)]
    load(spark, inputs | {"transactions": write_lines("months", trans)}, lake, _run(3, FULL_LOAD))
    stored = lake.stored("consumption.profile_fact")
    day = spark.createDataFrame([(2024, 2)], "trans_year int, trans_month int")
    picked = _of_months(stored, day)
    plan = picked._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("], PushedFilters")[0]
    assert "isnotnull(trans_month" in filters and "= 2024)" in filters
    assert stored.count() == 7 and picked.count() == 1
    assert _of_months(stored, day.limit(0)).count() == 0


def test_staged_folders_do_not_add_up(spark):
    from pathlib import Path

    from registry.queries import QUERIES

    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    names = lambda: {p.name for p in folder.glob("ledgerlake-*")}
    QUERIES["star_report"](spark, "/root/testdata/sf0.001")
    once = names()
    QUERIES["star_report"](spark, "/root/testdata/sf0.001")
    assert len(names()) == len(once) and names() != once
    QUERIES["register_partitions"](spark, "/root/testdata/sf0.001")
    tables = lambda: [t.name for t in spark.catalog.listTables() if t.name.startswith("ledgerlake_register")]
    first = tables()
    QUERIES["register_partitions"](spark, "/root/testdata/sf0.001")
    assert len(tables()) == 1 and tables() != first


def test_mode_is_checked():
    with pytest.raises(ValueError):
        RunContext(date(2024, 1, 1), datetime(2024, 1, 1), "Sometimes")


def test_incremental_load_fact_writes_each_dump_once(spark, monkeypatch):
    from registry import queries

    written = []
    as_json = queries._as_json

    def counted(df, stage, name):
        written.append(name)
        return as_json(df, stage, name)

    monkeypatch.setattr(queries, "_as_json", counted)
    rows = queries.QUERIES["incremental_load_fact"](spark, "/root/testdata/sf0.001").count()
    # Users once, transactions and events cut at two days each; before, all three feeds were written three times.
    assert sorted(written) == ["analytics", "analytics", "transactions", "transactions", "users"]
    assert rows > 0
