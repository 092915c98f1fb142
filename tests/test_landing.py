"""Feeds, date parts, day slices and day partitions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.context import INCREMENTAL_LOAD, RunContext, load_clock, save_clock
from ledgerlake.functions.dates import with_compact_parts, with_iso_parts
from ledgerlake.operators.flatten import flatten_analytics
from ledgerlake.operators.slices import incremental_slice
from ledgerlake.sinks import partitions, tables
from ledgerlake.sources import feeds
from ledgerlake.sources.layers import day_slice, scan_table


def test_bad_line_is_set_aside(spark, write_lines):
    path = write_lines("users", [{"user_id": "1"}, '{"user_id": ', {"user_id": "2", "rating": 4}])
    scan = feeds.scan_feed(spark, "users", path)
    assert [tuple(r) for r in feeds.good_rows(scan).select("user_id", "rating").collect()] == [("1", None), ("2", "4")]
    assert feeds.bad_lines(scan).collect()[0][0] == '{"user_id": '


def test_a_wrong_type_is_set_aside(spark, write_lines):
    """A line of which some fields could be read is not landed, and not lost."""
    good = {"event_date": "20240301", "user_id": "1", "device": {"category": "a"}}
    bad = '{"event_date": "20240301", "user_id": "2", "device": "oops"}'
    for contract in (None, feeds.LANDED["analytics"]):
        scan = feeds.scan_feed(spark, "analytics", write_lines("a", [good, bad]), contract)
        assert [r.user_id for r in feeds.good_rows(scan).collect()] == ["1"]
        assert [r[0] for r in feeds.bad_lines(scan).collect()] == [bad]
    # Of fields that are not landed nothing is asked.
    extra = '{"event_date": "20240301", "user_id": "3", "items": "no list"}'
    scan = feeds.scan_feed(spark, "analytics", write_lines("b", [extra]), feeds.LANDED["analytics"])
    assert len(feeds.good_rows(scan).collect()) == 1 and feeds.bad_lines(scan).collect() == []


def test_map_values_become_text(spark, write_lines):
    event = {"user_id": "1", "event_params": [{"key": "n", "value": {"int_value": 3}}], "items": ["a"]}
    row = feeds.analytics_feed(spark, write_lines("a", [event])).head()
    assert row["event_params"][0]["value"] == {"int_value": "3"}
    assert row["items"] == ["a"]


def test_flatten_keeps_commas_and_nulls(spark, write_lines):
    event = {
        "user_id": "1",
        "event_date": "20240115",
        "device": {"category": "mobile", "mobile_os_hardware_model": "iPhone12,1", "operating_system": "IOS"},
        "geo": {"city": "Lahore, Punjab", "country": "Pakistan"},
        "app_info": {"id": "x", "version": "1.2"},
    }
    row = flatten_analytics(feeds.analytics_feed(spark, write_lines("a", [event]))).head().asDict()
    assert row == {
        "user_id": "1", "event_date": "20240115", "category": "mobile", "mobile_brand_name": None,
        "mobile_model_name": None, "mobile_os_hardware_model": "iPhone12,1", "operating_system": "IOS",
        "operating_system_version": None, "city": "Lahore, Punjab", "country": "Pakistan", "appversion": "1.2",
    }


def test_flatten_reads_only_the_fields_in_use(spark, write_lines):
    path = write_lines("a", [{"user_id": "1"}])
    plan = feeds.flat_analytics_feed(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "advertising_id" not in plan and "traffic_source" not in plan


def test_iso_parts(spark):
    texts = ["2023-01-05T23:30:00Z", "2023-01-05 23:30:00", "2023-1-5T01:00:00", "junk", None, "99999-01-01", "2023-02-30T00", "2023", "2023-05", "2023-05T10:00:00", ""]
    df = with_iso_parts(spark.createDataFrame([(t,) for t in texts], "created_at string"))
    got = [tuple(r) for r in df.select(*schemas.DAY_PARTS).collect()]
    assert got == [(2023, 1, 5)] * 3 + [(None, None, None)] * 8


def test_compact_parts(spark):
    df = with_compact_parts(spark.createDataFrame([("20240109",), ("x",), (None,), ("20241301",), ("20230229",), ("2024 1 9",), ("20240109T10",)], "event_date string"))
    assert [tuple(r) for r in df.select(*schemas.DAY_PARTS).collect()] == [(2024, 1, 9), *[(None, None, None)] * 5, (2024, 1, 9)]


def test_slices_cross_month_ends(spark):
    df = spark.createDataFrame([("a", "2024-02-29T10:00:00"), ("b", "2024-03-01T00:05:00")], "id string, created_at string")
    night = RunContext.at(datetime(2024, 3, 1, 0, 10), INCREMENTAL_LOAD)
    later = RunContext.at(datetime(2024, 3, 1, 0, 29), INCREMENTAL_LOAD)
    assert night.first_run_of_day and not later.first_run_of_day
    assert [r.id for r in incremental_slice(df, night).collect()] == ["a"]
    assert [r.id for r in incremental_slice(df, later).collect()] == ["b"]


def test_clock_round_trip(spark, tmp_path):
    path = str(tmp_path / "clock")
    save_clock(spark, path, RunContext(date(2024, 5, 5), datetime(2024, 5, 5)))
    save_clock(spark, path, RunContext(date(2024, 1, 1), datetime(2024, 1, 1)))
    row = spark.read.parquet(path).head()
    assert (row.todayday, row.todaymonth, row.todayyear) == ("1", "1", "2024")
    assert (row.yesterdayDay, row.yesterDayMonth, row.yesterDayYear) == ("31", "12", "2023")
    assert load_clock(spark, path) == (date(2024, 1, 1), date(2023, 12, 31))


def _users(spark, rows, ctx):
    df = spark.createDataFrame(rows, schemas.USERS_FEED)
    return partitions.stamp(with_iso_parts(df), ctx)


def test_replace_day(spark, tmp_path, ctx, values):
    path = str(tmp_path / "users")
    read = lambda: values(scan_table(spark, path, schemas.SOURCE_USERS), "user_id", "business_id", "crday")
    first = _users(spark, [("1", "x", None, "2024-03-01T00:00:00"), ("2", "x", None, "2024-03-02T00:00:00")], ctx)
    assert partitions.write_partitioned(first, path) == 2
    second = _users(spark, [("3", "y", None, "2024-03-02T00:00:00"), ("9", "y", None, "2024-03-09T00:00:00")], ctx)
    for _ in range(2):
        assert partitions.replace_day(second, path, date(2024, 3, 2)) == 1
        assert read() == [("1", "x", 1), ("3", "y", 2)]
    assert partitions.replace_day(second, path, date(2024, 3, 1)) == 0
    assert read() == [("3", "y", 2)]
    # An empty day that was never there.
    assert partitions.replace_day(second, path, date(2024, 3, 5)) == 0
    assert read() == [("3", "y", 2)]


def test_day_slice_prunes_folders(spark, tmp_path, ctx):
    path = str(tmp_path / "users")
    rows = [(str(i), "x", None, f"2024-03-{i:02d}T00:00:00") for i in range(1, 6)]
    partitions.write_partitioned(_users(spark, rows, ctx), path)
    df = day_slice(scan_table(spark, path, schemas.SOURCE_USERS), date(2024, 3, 4))
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert all(p in filters for p in schemas.DAY_PARTS)
    assert len(df.inputFiles()) >= 1 and [r.user_id for r in df.collect()] == ["4"]


def test_write_brings_days_together(spark, tmp_path, ctx):
    path = tmp_path / "users"
    rows = [(str(i), "x", None, f"2024-03-{i % 3 + 1:02d}T00:00:00") for i in range(300)]
    partitions.write_partitioned(_users(spark, rows, ctx).repartition(8), str(path))
    assert len(list(path.rglob("*.snappy.parquet"))) == 3
    other = tmp_path / "by_user"
    assert partitions.write_partitioned(_users(spark, rows, ctx), str(other), by=["user_id"]) == 300


def test_register_and_swap_partitions(spark, tmp_path, ctx):
    path = str(tmp_path / "users")
    rows = [("1", "x", None, "2024-03-01T00:00:00"), ("2", "x", None, "2024-03-02T00:00:00")]
    partitions.write_partitioned(_users(spark, rows, ctx), path)
    tables.create_table(spark, "reg_users", schemas.SOURCE_USERS, schemas.DAY_PARTS, path)
    for _ in range(2):
        tables.register_partitions(spark, "reg_users")
        assert spark.sql("SHOW PARTITIONS reg_users").count() == 2
    day = date(2024, 3, 2)
    partitions.replace_day(_users(spark, [("3", "x", None, "2024-03-02T00:00:00")], ctx), path, day)
    for _ in range(2):
        tables.swap_day_partition(spark, "reg_users", path, day)
        assert sorted(r.user_id for r in spark.table("reg_users").collect()) == ["1", "3"]
    tables.drop_tables(spark, ["reg_users"])
    assert not spark.catalog.tableExists("reg_users")


def test_table_definitions_match_contracts(spark):
    for name, (schema, parts) in schemas.STORED.items():
        table = "ddl_" + name.replace(".", "_")
        tables.create_table(spark, table, schema, parts)
        columns = {f.name: f.dataType for f in spark.table(table).schema.fields}
        assert columns == {f.name: f.dataType for f in schema.fields}
        tables.drop_tables(spark, [table])


def test_append_matches_columns_by_name(spark):
    a = spark.createDataFrame([("1", "x")], "user_id string, business_id string")
    tables.append_rows(a, "append_users")
    tables.append_rows(a.select("business_id", "user_id"), "append_users")
    assert [tuple(r) for r in spark.table("append_users").collect()] == [("1", "x")] * 2
    tables.drop_tables(spark, ["append_users"])


def test_a_day_of_a_month_touches_few_row_groups(spark, tmp_path, monkeypatch):
    """Month folders in day order: footers alone tell which row groups may hold a day."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(partitions, "ROW_GROUP_BYTES", 1 << 14)
    rows = spark.range(60_000).select(
        F.lit(2024).alias("cryear"), (F.col("id") % 2 + 1).cast("int").alias("crmonth"),
        (F.xxhash64("id") % 14 + 15).cast("int").alias("crday"), F.md5(F.col("id").cast("string")).alias("text"),
    )
    path = str(tmp_path / "months")
    assert partitions.write_partitioned(rows, path, schemas.DAY_MONTHS) == 60_000
    groups, touched = 0, 0
    for file in (tmp_path / "months" / "cryear=2024" / "crmonth=1").glob("*.parquet"):
        footer = pq.read_metadata(file)
        place = footer.schema.names.index("crday")
        for g in range(footer.num_row_groups):
            stats = footer.row_group(g).column(place).statistics
            groups, touched = groups + 1, touched + (stats.min <= 9 <= stats.max)
    assert groups >= 20 and 1 <= touched <= groups / 5
    schema = rows.schema
    day = day_slice(scan_table(spark, path, schema), date(2024, 1, 9))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(crday,9)" in plan and "crmonth" in plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert day.count() == rows.where("crmonth = 1 and crday = 9").count() > 0


def test_replace_a_day_within_its_month(spark, tmp_path):
    schema = "text string, cryear int, crmonth int, crday int"
    path = str(tmp_path / "t")
    day = date(2024, 2, 3)
    make = lambda *rows: spark.createDataFrame([(t, 2024, m, d) for t, m, d in rows], schema)
    stored = lambda: scan_table(spark, path, make(("x", 1, 1)).schema)
    kept = lambda: sorted((r.text, r.crmonth, r.crday) for r in stored().collect())
    partitions.write_partitioned(make(("a", 1, 3), ("b", 2, 3), ("c", 2, 3), ("d", 2, 4)), path, schemas.DAY_MONTHS)
    other = sorted((tmp_path / "t" / "cryear=2024" / "crmonth=1").glob("*.parquet"))
    for _ in range(2):
        assert partitions.replace_day_in_month(make(("e", 2, 3), ("f", 2, 9)), stored(), path, day) == 1
        assert kept() == [("a", 1, 3), ("d", 2, 4), ("e", 2, 3)]
    assert sorted((tmp_path / "t" / "cryear=2024" / "crmonth=1").glob("*.parquet")) == other
    assert partitions.replace_day_in_month(make(("z", 5, 5)), stored(), path, day) == 0
    assert kept() == [("a", 1, 3), ("d", 2, 4)]
    assert partitions.replace_day_in_month(make(("z", 5, 5)), stored(), path, date(2024, 2, 4)) == 0
    assert kept() == [("a", 1, 3)]
