"""One query per operator.  Each reads whole shared tables; queries of the write path write to a folder of
their own and read back what they wrote."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import partial, reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas
from ledgerlake.context import FULL_LOAD, INCREMENTAL_LOAD, RunContext, load_clock, save_clock
from ledgerlake.functions.dates import with_compact_parts, with_iso_parts
from ledgerlake.operators import audit, curate, dims, fact, report
from ledgerlake.operators.flatten import flatten_analytics
from ledgerlake.operators.keys import dense_key
from ledgerlake.operators.newrows import incremental_new_rows, new_rows
from ledgerlake.operators.sketches import new_rows_by_month
from ledgerlake.operators.skew import key_counts
from ledgerlake.operators.slices import compact_day_slice, incremental_slice
from ledgerlake.plans.lake import Lake
from ledgerlake.plans.loads import LoadReport, land_all, load, refresh_profile, stored_casts
from ledgerlake.plans.together import together
from ledgerlake.sinks import partitions, tables
from ledgerlake.sinks.files import exists
from ledgerlake.sinks.stage import Stage, created_stages
from ledgerlake.sources import feeds, sample_tables
from ledgerlake.sources.layers import day_slice, scan_table
from ledgerlake.streaming.arrivals import RUN, Arrivals

# Fixed run clocks, so results do not depend on the wall clock.
CTX = RunContext(date(2002, 1, 1), datetime(2002, 1, 1, 6, 0, 0))
AFTER = RunContext(date(2024, 2, 1), datetime(2024, 2, 1, 6, 0, 0))
TRADE_CTX = RunContext(date(1998, 5, 14), datetime(1998, 5, 14, 6, 0, 0), INCREMENTAL_LOAD)
TRADE_NIGHT = RunContext(date(1998, 5, 14), datetime(1998, 5, 14, 0, 10, 0), INCREMENTAL_LOAD, True)
EVENT_CTX = RunContext(date(2024, 1, 15), datetime(2024, 1, 15, 18, 0, 0), INCREMENTAL_LOAD)
LAST_NIGHT = RunContext(date(2024, 1, 30), datetime(2024, 1, 30, 0, 10, 0), INCREMENTAL_LOAD, True)
LAST_DAY = RunContext(date(2024, 1, 30), datetime(2024, 1, 30, 18, 0, 0), INCREMENTAL_LOAD)
EMPTIED_DAY = date(2024, 1, 16)


# --- shared inputs ---------------------------------------------------------------------------------------


def _users(spark: SparkSession, folder: str) -> DataFrame:
    return partitions.stamp(with_iso_parts(sample_tables.users(spark, folder)), CTX)


def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    return partitions.stamp(with_iso_parts(sample_tables.transactions(spark, folder)), CTX)


def _core(spark: SparkSession, folder: str) -> DataFrame:
    return curate.trans_core(_transactions(spark, folder))


def _timed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Flat source-layer events with the finer clock of the shared table."""
    nested = sample_tables.nested_events(spark, folder)
    flat = flatten_analytics(nested, "event_ts", "event_id")
    return partitions.stamp(with_compact_parts(flat), CTX)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    flat = flatten_analytics(sample_tables.nested_events(spark, folder))
    return curate.to_contract(partitions.stamp(with_compact_parts(flat), CTX), schemas.SOURCE_ANALYTICS)


def _curated_users(spark: SparkSession, folder: str) -> DataFrame:
    return curate.curate_users(curate.dedupe_users(_users(spark, folder)), CTX)


def _latest(spark: SparkSession, folder: str) -> DataFrame:
    latest = dims.analytics_latest(_timed_events(spark, folder), ("event_ts", "event_id"))
    return latest.select(*schemas.names(schemas.CURATED_ANALYTICS))


# --- ingest ----------------------------------------------------------------------------------------------


def _as_json(df: DataFrame, stage: Stage, name: str) -> str:
    path = stage.path(name)
    df.write.json(path)
    return path


def ingest_users(spark: SparkSession, folder: str) -> DataFrame:
    path = _as_json(sample_tables.users(spark, folder), Stage(spark), "users")
    return feeds.users_feed(spark, path)


def ingest_transactions(spark: SparkSession, folder: str) -> DataFrame:
    path = _as_json(sample_tables.transactions(spark, folder), Stage(spark), "transactions")
    return feeds.transactions_feed(spark, path)


def ingest_analytics(spark: SparkSession, folder: str) -> DataFrame:
    nested = sample_tables.nested_events(spark, folder).select(*schemas.names(schemas.ANALYTICS_FEED))
    read = feeds.analytics_feed(spark, _as_json(nested, Stage(spark), "analytics"))
    return read.select(*_leaves(schemas.ANALYTICS_FEED))


def _leaves(feed: T.StructType) -> list[Column]:
    """Every leaf field of the feed; parameters as ``key.kind=value`` texts, joined by commas."""
    columns = []
    for field in feed.fields:
        if isinstance(field.dataType, T.StructType):
            columns += [F.col(f"{field.name}.{n}").alias(f"{field.name}_{n}") for n in field.dataType.names]
        elif field.dataType == schemas.PARAMS:
            columns.append(F.array_join(F.flatten(F.transform(field.name, _param_texts)), ",").alias(field.name))
        elif isinstance(field.dataType, T.ArrayType):
            columns.append(F.array_join(field.name, ",").alias(field.name))
        else:
            columns.append(F.col(field.name))
    return columns


def _param_texts(param: Column) -> Column:
    entries = F.map_entries(param["value"])
    return F.transform(entries, lambda e: F.concat(param["key"], F.lit("."), e["key"], F.lit("="), e["value"]))


# Every tenth transaction arrives as half a line, every tenth under no day, and so with the other feeds.
def _hex_of(key: str, first: int) -> Column:
    """Four hexadecimal digits of a key's digest as a number."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), first, 4), 16, 10).cast("int")


def _spoiled(df: DataFrame, key: str, day: str) -> DataFrame:
    """Feed lines, some cut short and some with an impossible date."""
    kind = _hex_of(key, 1) % 10
    undated = df.withColumn(day, F.when(kind == 1, F.lit("2024-13-45")).otherwise(F.col(day)))
    line = F.to_json(F.struct(*[c for c in undated.columns if c != "_key"]))
    return undated.select(F.when(kind == 0, F.substring(line, 1, 12)).otherwise(line).alias("value"))


def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows landed and set aside per feed; together they are the lines of the feed."""
    stage = Stage(spark)
    events = sample_tables.nested_events(spark, folder)
    feeds_of = {
        "users": _spoiled(sample_tables.users(spark, folder).withColumn("_key", F.col("user_id")), "_key", "created_at"),
        "transactions": _spoiled(
            sample_tables.transactions(spark, folder).withColumn("_key", F.col("transaction_id")), "_key", "created_at"
        ),
        "analytics": _spoiled(
            events.select(*schemas.names(schemas.ANALYTICS_FEED), F.col("event_id").alias("_key")), "_key", "event_date"
        ),
    }
    inputs = {name: stage.path(name) for name in feeds_of}
    for name, lines in feeds_of.items():
        lines.write.text(inputs[name])
    lake = Lake(spark, stage.path("lake"))
    land_all(spark, inputs, lake, CTX, LoadReport())
    parts = {f"{name} landed": lake.stored(f"raw.{name}") for name in feeds_of}
    for name in feeds_of:
        for kind in ("lines", "undated"):
            path = f"{lake.root}/quarantine/{name}_{kind}/full"
            if exists(spark, path):
                parts[f"{name} {kind}"] = spark.read.parquet(path)
    return audit.row_counts(parts)


def _mistyped(df: DataFrame, key: str, texts: dict[str, tuple[str, str]], day: str, late: str) -> DataFrame:
    """Feed rows some of whose typed columns are no value, a value out of range, of a later day, or missing."""
    kind = _hex_of(key, 1) % 10
    wrong = {
        c: F.when(kind == 1, F.lit(junk)).when(kind == 2, F.lit(beyond)).when(kind == 3, F.lit(None)).otherwise(F.col(c))
        for c, (junk, beyond) in texts.items()
    }
    wrong[day] = F.when(kind == 4, F.lit(late)).when(kind == 5, F.lit("")).otherwise(F.col(day))
    return df.withColumns(wrong)


def cast_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What is missing, no value or out of range in each typed column of feeds with spoiled texts."""
    stage = Stage(spark)
    events = sample_tables.nested_events(spark, folder)
    late, text = "2999-01-01T00:00:00", {"rating": ("good", "6"), "amount": ("n/a", "-1.50")}
    users = _mistyped(sample_tables.users(spark, folder), "user_id", {"rating": text["rating"]}, "created_at", late)
    sent = sample_tables.transactions(spark, folder)
    sent = _mistyped(sent, "transaction_id", {"amount": text["amount"]}, "created_at", late)
    events = _mistyped(events, "event_id", {}, "event_date", "29990101").select(*schemas.names(schemas.ANALYTICS_FEED))
    inputs = {
        "users": _as_json(users, stage, "users"),
        "transactions": _as_json(sent, stage, "transactions"),
        "analytics": _as_json(events, stage, "analytics"),
    }
    lake = Lake(spark, stage.path("lake"))
    land_all(spark, inputs, lake, AFTER, LoadReport())
    return stored_casts(lake)


# --- landing ---------------------------------------------------------------------------------------------


def _land_events(spark: SparkSession, folder: str, name: str, stage: Stage | None = None) -> str:
    path = (stage or Stage(spark)).path(name)
    partitions.write_partitioned(_events(spark, folder), path)
    return path


def _read_events(spark: SparkSession, path: str) -> DataFrame:
    return scan_table(spark, path, schemas.SOURCE_ANALYTICS)


def day_slice_scan(spark: SparkSession, folder: str) -> DataFrame:
    landed = _read_events(spark, _land_events(spark, folder, "slice"))
    return day_slice(landed, EVENT_CTX.as_of)


def partitioned_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return _read_events(spark, _land_events(spark, folder, "roundtrip"))


def day_partition_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Two rounds over a landed day (corrected rows, then an untouched re-run) and one emptied day."""
    path = _land_events(spark, folder, "refresh")
    corrected = _events(spark, folder).withColumn("category", F.upper("category"))
    for _ in range(2):
        partitions.replace_day(corrected, path, EVENT_CTX.as_of)
    partitions.replace_day(corrected.limit(0), path, EMPTIED_DAY)
    return _read_events(spark, path)


def _register(spark: SparkSession, stage: Stage, path: str, name: str) -> str:
    table = f"ledgerlake_{name}_{path.rsplit('-', 1)[-1]}"
    stage.at_end(lambda: tables.drop_tables(spark, [table]))
    tables.create_table(spark, table, schemas.SOURCE_ANALYTICS, schemas.DAY_PARTS, path)
    return table


def register_partitions(spark: SparkSession, folder: str) -> DataFrame:
    stage = Stage(spark)
    table = _register(spark, stage, _land_events(spark, folder, "register", stage), "register")
    for _ in range(2):
        tables.register_partitions(spark, table)
    return spark.table(table).groupBy(*schemas.DAY_PARTS).agg(F.count(F.lit(1)).alias("row_count"))


def swap_day_partition(spark: SparkSession, folder: str) -> DataFrame:
    stage = Stage(spark)
    path = _land_events(spark, folder, "swap", stage)
    table = _register(spark, stage, path, "swap")
    tables.register_partitions(spark, table)
    corrected = _events(spark, folder).withColumn("category", F.upper("category"))
    partitions.replace_day(corrected, path, EVENT_CTX.as_of)
    tables.swap_day_partition(spark, table, path, EVENT_CTX.as_of)
    return spark.table(table).select(*schemas.names(schemas.SOURCE_ANALYTICS))


def late_day_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The last two days: what the polls before noon of the 29th saw, the late look at the 29th just after
    midnight, and a poll of the 30th."""
    seen = _timed_events(spark, folder).where(F.col("event_ts") < F.lit("2024-01-29 12:00:00").cast("timestamp_ntz"))
    path = Stage(spark).path("late")
    partitions.write_partitioned(curate.to_contract(seen, schemas.SOURCE_ANALYTICS), path)
    for ctx in (LAST_NIGHT, LAST_DAY):
        partitions.late_day_refresh(_events(spark, folder), path, ctx)
    return _read_events(spark, path)


def landed_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Events, some of their lines spoiled, that arrive in three lots; a run after each and one with nothing new: rows
    in the raw layer by day, how many runs brought them, and what could not be landed."""
    stage = Stage(spark)
    events = sample_tables.nested_events(spark, folder)
    keyed = events.select(*schemas.names(schemas.ANALYTICS_FEED), F.col("event_id").alias("_key"))
    lake, feed, path = Lake(spark, stage.path("lake")), "analytics", stage.path("feed")
    lake.create_missing()
    arrivals = Arrivals(lake, feed)
    for lot in range(3):
        _spoiled(keyed.where(_hex_of("_key", 5) % 3 == lot), "_key", "event_date").write.mode("append").text(path)
        arrivals.land(path, CTX, LoadReport())
    arrivals.land(path, CTX, LoadReport())
    parts, brought = list(schemas.DAY_PARTS), arrivals.rows()
    runs = brought.groupBy(*parts).agg(F.count_distinct(RUN).cast("long").alias("runs"))
    landed = lake.stored("raw.analytics").groupBy(*parts).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("user_id").alias("users"), F.lit(0).cast("long").alias("bad_lines")
    )
    # A row per calendar day.
    by_day = landed.join(F.broadcast(runs), parts)
    lost = brought.where(F.col("cryear").isNull()).groupBy(*parts).agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(0).cast("long").alias("users"), F.count(feeds.CORRUPT).alias("bad_lines"),
        F.count_distinct(RUN).cast("long").alias("runs"),
    )
    return by_day.unionByName(lost)


def compacted_months(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions that came in three appends, packed: rows and files of each month."""
    lake, table = Lake(spark, Stage(spark).path("lake")), "curated.transactions"
    core = _core(spark, folder)
    slices = [core.where(F.crc32("transaction_id") % 3 == i) for i in range(3)]
    lake.write_version(table, slices[0])
    for rows in slices[1:]:
        lake.append(table, rows)
    lake.compact(table)
    stored = spark.read.schema(schemas.TRANS_CORE).parquet(lake.path(table)).select("*", F.col("_metadata.file_path").alias("_file"))
    return stored.groupBy(*schemas.DAY_MONTHS).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("transaction_id").alias("first_id"),
        F.max("transaction_id").alias("last_id"),
        F.count_distinct("transaction_id").alias("ids"),
        F.count_distinct("_file").alias("files"),
    )


def new_transactions_by_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A poll that brings every third transaction, against a table that holds every second: what is new, found by way
    of the month filters."""
    stage = Stage(spark)
    lake, table = Lake(spark, stage.path("lake")), "curated.transactions"
    core = _core(spark, folder)
    digit = F.conv(F.substring(F.md5("transaction_id"), 1, 4), 16, 10).cast("int")
    lake.write_version(table, core.where(digit % 2 == 0))
    lake.write_filters(table)
    sent = stage.keep(core.where(digit % 3 == 0), "sent")
    fresh = stage.keep(new_rows_by_month(sent, lake.stored(table), lake.filters(table), "transaction_id"), "fresh")
    lake.append_filters(table, fresh)
    lake.append(table, fresh)
    # Now the table holds both; the same poll again brings nothing.
    again = new_rows_by_month(sent, lake.stored(table), lake.filters(table), "transaction_id")
    return fresh.select("transaction_id", "user_id", *schemas.DAY_PARTS).unionByName(
        again.select("transaction_id", "user_id", *schemas.DAY_PARTS)
    )


def rows_by_user(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions brought together by user before the write: of a month, a user's rows are in one file."""
    path = Stage(spark).path("by_user")
    partitions.write_partitioned(_core(spark, folder), path, schemas.DAY_MONTHS, by=["user_id"])
    stored = spark.read.schema(schemas.TRANS_CORE).parquet(path)
    of_month = stored.groupBy("user_id", *schemas.DAY_MONTHS).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("_metadata.file_path").alias("files")
    )
    return of_month.groupBy("user_id").agg(F.sum("n").alias("row_count"), F.max("files").alias("most_files"))


def run_clock_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The control table written for the day after the last transaction, and the days read back from it."""
    last = dims.trans_date_bounds(sample_tables.transactions(spark, folder)).head()["max_trans_date"]
    today = last + timedelta(days=1)
    path = Stage(spark).path("clock")
    save_clock(spark, path, RunContext(today, datetime(today.year, today.month, today.day, 0, 10)))
    read = load_clock(spark, path)
    stored = spark.read.schema(schemas.RUN_CLOCK).parquet(path)
    return stored.select("*", F.lit(read[0]).alias("today"), F.lit(read[1]).alias("yesterday"))


def table_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """Tables defined over landed rows: each column with its type, its place in the layout and its values; then the
    tables are dropped, and how many of them are left is told."""
    stage = Stage(spark)
    rows = {
        "users": (_users(spark, folder), schemas.SOURCE_USERS, schemas.DAY_MONTHS),
        "transactions": (_transactions(spark, folder), schemas.SOURCE_TRANSACTIONS, schemas.DAY_MONTHS),
        "analytics": (_events(spark, folder), schemas.SOURCE_ANALYTICS, schemas.DAY_PARTS),
    }
    names, counted = [], []
    for feed, (df, schema, parts) in rows.items():
        path = stage.path(feed)
        name = f"ledgerlake_{feed}_{path.rsplit('-', 1)[-1]}"
        names.append(name)
        stage.at_end(lambda: tables.drop_tables(spark, names))
        partitions.write_partitioned(df.select(*schemas.names(schema)), path, parts)
        tables.create_table(spark, name, schema, parts, path)
        tables.register_partitions(spark, name)
        columns = spark.catalog.listColumns(name)
        told = [F.struct(F.lit(c.name).alias("column_name"), F.lit(c.dataType).alias("data_type"), F.lit(c.isPartition).alias("is_partition"), F.count(c.name).alias("values")) for c in columns]
        counted.append(spark.table(name).agg(F.array(*told).alias("_c")).select(F.lit(feed).alias("table_name"), F.inline("_c")))
    kept = stage.keep(reduce(DataFrame.unionByName, counted), "contracts")
    tables.drop_tables(spark, names)
    left = sum(spark.catalog.tableExists(n) for n in names)
    return kept.withColumn("tables_left", F.lit(left))


def date_parts_iso(spark: SparkSession, folder: str) -> DataFrame:
    return with_iso_parts(sample_tables.transactions(spark, folder)).select(
        "transaction_id", "created_at", *schemas.DAY_PARTS
    )


def date_parts_compact(spark: SparkSession, folder: str) -> DataFrame:
    events = sample_tables.nested_events(spark, folder).select("event_id", "event_date")
    return with_compact_parts(events)


def incremental_slice_today(spark: SparkSession, folder: str) -> DataFrame:
    return incremental_slice(sample_tables.transactions(spark, folder), TRADE_CTX)


def incremental_slice_yesterday(spark: SparkSession, folder: str) -> DataFrame:
    return incremental_slice(sample_tables.transactions(spark, folder), TRADE_NIGHT)


def incremental_slice_events(spark: SparkSession, folder: str) -> DataFrame:
    events = flatten_analytics(sample_tables.nested_events(spark, folder))
    return compact_day_slice(events, EVENT_CTX.slice_day)


def flatten_events(spark: SparkSession, folder: str) -> DataFrame:
    return flatten_analytics(sample_tables.nested_events(spark, folder))


# --- curate ----------------------------------------------------------------------------------------------


def curate_analytics(spark: SparkSession, folder: str) -> DataFrame:
    return curate.curate_analytics(_events(spark, folder))


def anti_join_new_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users not curated yet, where the users seen in the app have been."""
    source = sample_tables.users(spark, folder)
    return new_rows(source, sample_tables.nested_events(spark, folder), ["user_id"]).select("user_id")


def incremental_new_rows_of_day(spark: SparkSession, folder: str) -> DataFrame:
    """Events of the day that the poll at noon had not curated."""
    events = _timed_events(spark, folder)
    at_noon = events.where(F.col("event_ts") < F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    record = [c for c in schemas.names(schemas.CURATED_ANALYTICS) if c != "processed_at"]
    return incremental_new_rows(events, at_noon, EVENT_CTX, record, False).drop("event_ts", "processed_at")


def append_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Users seen in the app are in the table; the others are appended, and a second run adds nothing."""
    stage = Stage(spark)
    path = stage.path("append")
    table = f"ledgerlake_append_{path.rsplit('-', 1)[-1]}"
    stage.at_end(lambda: tables.drop_tables(spark, [table]))
    users = sample_tables.users(spark, folder)
    seen = sample_tables.nested_events(spark, folder).select("user_id").distinct()
    tables.append_rows(users.join(seen, "user_id", "left_semi"), table, location=path)
    for _ in range(2):
        tables.append_rows(new_rows(users, spark.table(table), ["user_id"]), table)
    return spark.table(table)


def curate_users(spark: SparkSession, folder: str) -> DataFrame:
    return _curated_users(spark, folder)


def dedupe_users(spark: SparkSession, folder: str) -> DataFrame:
    return curate.dedupe_users(sample_tables.user_sightings(spark, folder))


def dedupe_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per id of a feed that sends open orders again a day later and repeats every line of failed ones."""
    sent = sample_tables.transactions(spark, folder)
    later = F.concat(F.date_add(F.substring("created_at", 1, 10).cast("date"), 1).cast("string"), F.lit("T00:00:00"))
    again = sent.where("transaction_type = 'debit'").withColumns({"created_at": later, "amount": F.lit("0.00")})
    copies = sent.where("transaction_type = 'credit'")
    return curate.dedupe_transactions(sent.unionByName(again).unionByName(copies))


def trans_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return curate.trans_type_counts(sample_tables.transactions(spark, folder))


def trans_profile(spark: SparkSession, folder: str) -> DataFrame:
    return curate.trans_profile(sample_tables.transactions(spark, folder))


def trans_profile_by_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The profile of all days but the last, then the last day merged in: the buckets of its users are written anew."""
    lake = Lake(spark, Stage(spark).path("lake"))
    daily = curate.trans_daily(_core(spark, folder))
    last = F.make_date(*schemas.DAY_PARTS) >= F.lit(LAST_ORDERS)
    lake.write_version("curated.trans_daily", daily.where(~last))
    lake.write_version("curated.trans_profile", curate.profile_of_daily(lake.stored("curated.trans_daily")))
    for after in range(2):
        day = LAST_ORDERS + timedelta(days=after)
        lake.replace_day("curated.trans_daily", daily, day)
        refresh_profile(lake, day)
    return lake.read("curated.trans_profile")


def _profile(spark: SparkSession, folder: str, stage: Stage) -> DataFrame:
    return stage.keep(curate.profile_store(sample_tables.transactions(spark, folder)), "profile")


def curate_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return curate.curate_transactions(_core(spark, folder), _profile(spark, folder, Stage(spark)))


# --- consumption -----------------------------------------------------------------------------------------


def surrogate_key_dense(spark: SparkSession, folder: str) -> DataFrame:
    rows = sample_tables.transactions(spark, folder).select("user_id", "transaction_id")
    return dense_key(rows, ["user_id", "transaction_id"], "trans_id_pk", Stage(spark))


def analytics_latest(spark: SparkSession, folder: str) -> DataFrame:
    return _latest(spark, folder).drop("processed_at")


def trans_date_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return dims.trans_date_bounds(sample_tables.transactions(spark, folder))


def date_dim(spark: SparkSession, folder: str) -> DataFrame:
    return dims.date_dim(sample_tables.transactions(spark, folder))


def user_dim(spark: SparkSession, folder: str) -> DataFrame:
    return dims.user_dim(_curated_users(spark, folder), Stage(spark))


def _wide_trans_dim(store: DataFrame, profile: DataFrame) -> DataFrame:
    wide = curate.curate_transactions(store, profile, ("trans_id_pk", "isActive"))
    return wide.select(*schemas.names(schemas.TRANS_DIM))


def trans_dim(spark: SparkSession, folder: str) -> DataFrame:
    stage = Stage(spark)
    store, profile = together(
        lambda: dims.trans_dim_store(_core(spark, folder), stage), lambda: _profile(spark, folder, stage)
    )
    return _wide_trans_dim(store, profile)


def analytics_dim(spark: SparkSession, folder: str) -> DataFrame:
    return dims.analytics_dim(_latest(spark, folder), Stage(spark))


def gmv_per_month(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly measures over the transactions of known users with events; natural keys will do here."""
    stage = Stage(spark)
    same = F.col("user_id")
    core = _core(spark, folder)
    active = sample_tables.nested_events(spark, folder).select("user_id").distinct()
    active, days = together(
        lambda: stage.keep(active.withColumn("analytics_id_pk", same), "active"),
        lambda: stage.keep(dims.date_dim(sample_tables.transactions(spark, folder)).coalesce(1), "days"),
    )
    rows = fact.star_rows(
        core.withColumn("trans_id_pk", F.col("transaction_id")),
        sample_tables.users(spark, folder).withColumn("user_id_pk", same),
        active,
        days,
        key_counts(core, ["user_id"]),
    )
    return fact.gmv_per_month(rows).orderBy("trans_year", "trans_month")


class _Star:
    """The star tables of one data folder.

    A dimension is a scan of its staged rows plus the broadcast key offsets, so it is not written again.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        stage = Stage(spark)
        core = _core(spark, folder)
        self.profile, self.user_dim, self.trans_store, self.analytics_dim, self.date_dim = together(
            lambda: _profile(spark, folder, stage),
            lambda: user_dim(spark, folder),
            lambda: dims.trans_dim_store(core, stage),
            lambda: analytics_dim(spark, folder),
            lambda: stage.keep(dims.date_dim(core).coalesce(1), "date_dim"),
        )
        per_user = self.profile.select("user_id", F.col("trans_rows").alias("rows"))
        star = fact.star_rows(self.trans_store, self.user_dim, self.analytics_dim, self.date_dim, per_user)
        self.fact_store = fact.number_fact(stage.keep(star, "rows"), stage)
        self.gmv = stage.keep(fact.gmv_per_month(self.fact_store).coalesce(1), "gmv")

    @property
    def fact(self) -> DataFrame:
        return fact.profile_fact(self.fact_store, self.gmv)

    @property
    def tables(self) -> tuple[DataFrame, ...]:
        """What the report is made of."""
        return self.fact, self.user_dim, self.trans_store, self.date_dim, self.analytics_dim, self.profile


def profile_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _Star(spark, folder).fact


def star_report(spark: SparkSession, folder: str) -> DataFrame:
    star = _Star(spark, folder)
    rows = report.star_report(*star.tables)
    return rows.drop("profile_id_pk").withColumn("amount", F.col("amount").cast("double"))


def star_report_top20(spark: SparkSession, folder: str) -> DataFrame:
    star = _Star(spark, folder)
    rows = report.star_report_top(*star.tables)
    return rows.withColumn("amount", F.col("amount").cast("double"))


def key_audit(spark: SparkSession, folder: str) -> DataFrame:
    star = _Star(spark, folder)
    return audit.key_audit(star.fact_store, star.user_dim, star.trans_store, star.analytics_dim, star.date_dim)


def layer_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    star = _Star(spark, folder)
    return audit.row_counts(
        {
            "raw.users": sample_tables.users(spark, folder),
            "raw.transactions": sample_tables.transactions(spark, folder),
            "raw.analytics": _events(spark, folder),
            "curated.users": _curated_users(spark, folder),
            "curated.transactions": _core(spark, folder),
            "curated.trans_profile": star.profile,
            "curated.analytics": curate_analytics(spark, folder),
            "consumption.date_dim": star.date_dim,
            "consumption.user_dim": star.user_dim,
            "consumption.trans_dim": star.trans_store,
            "consumption.analytics_dim": star.analytics_dim,
            "consumption.profile_fact": star.fact_store,
            "consumption.gmv_per_month": star.gmv,
        }
    )


# --- whole loads -----------------------------------------------------------------------------------------

# The last day with orders and the last day with events; both are loaded incrementally, the latter twice.
LAST_ORDERS, LAST_EVENTS = date(2001, 8, 1), date(2024, 1, 30)


def _feeds_before(spark: SparkSession, folder: str, stage: Stage, orders: date, events: date) -> dict[str, str]:
    """Feeds as full dumps of what has happened before two days."""
    sent = sample_tables.transactions(spark, folder).where(F.substring("created_at", 1, 10) < orders.isoformat())
    seen = sample_tables.nested_events(spark, folder).where(F.col("event_date") < events.strftime("%Y%m%d"))
    return {
        "users": _as_json(sample_tables.users(spark, folder), stage, "users"),
        "transactions": _as_json(sent, stage, "transactions"),
        "analytics": _as_json(seen.select(*schemas.names(schemas.ANALYTICS_FEED)), stage, "analytics"),
    }


def _loaded_fact(lake: Lake) -> DataFrame:
    """The fact by natural keys; surrogate keys depend on the order of the loads."""
    stored = lake.read("consumption.profile_fact")
    trans = lake.stored("consumption.trans_dim").select(F.col("trans_id_pk").alias("trans_id_fk"), "transaction_id")
    users = lake.stored("consumption.user_dim").select(F.col("user_id_pk").alias("user_id_fk"), "user_id")
    seen = lake.stored("consumption.analytics_dim").select(
        F.col("analytics_id_pk").alias("analytics_id_fk"), F.col("user_id").alias("event_user_id")
    )
    days = lake.stored("consumption.date_dim").select(F.col("date_id_pk").alias("date_id_fk"), "trans_date")
    rows = stored.join(trans, "trans_id_fk").join(users, "user_id_fk").join(seen, "analytics_id_fk")
    return rows.join(days, "date_id_fk").select(
        "transaction_id", "user_id", "event_user_id", "trans_date", "gmv_per_month", "avgtranspermonth"
    )


def full_load_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Feeds as JSON through every layer in one load."""
    stage = Stage(spark)
    lake = Lake(spark, stage.path("lake"))
    ever = date(9999, 12, 31)
    load(spark, _feeds_before(spark, folder, stage, ever, ever), lake, RunContext(CTX.as_of, CTX.processed_at, FULL_LOAD))
    return _loaded_fact(lake)


def _dumps_by_day(spark: SparkSession, folder: str, stage: Stage) -> list[dict[str, str]]:
    """Feeds of the full load and of the two incremental days.

    Equal dumps are written once and shared: users never change, the transactions of both days are cut at the
    same day, and the first day's events are those of the full load.
    """
    sent, seen = sample_tables.transactions(spark, folder), sample_tables.nested_events(spark, folder)

    def trans_before(day: date) -> str:
        return _as_json(sent.where(F.substring("created_at", 1, 10) < day.isoformat()), stage, "transactions")

    def events_before(day: date) -> str:
        rows = seen.where(F.col("event_date") < day.strftime("%Y%m%d"))
        return _as_json(rows.select(*schemas.names(schemas.ANALYTICS_FEED)), stage, "analytics")

    users, *dumps = together(
        lambda: _as_json(sample_tables.users(spark, folder), stage, "users"),
        *[partial(trans_before, LAST_ORDERS + timedelta(days=n)) for n in (0, 1)],
        *[partial(events_before, LAST_EVENTS + timedelta(days=n)) for n in (0, 1)],
    )
    trans, analytics = dumps[:2], dumps[2:]
    return [
        {"users": users, "transactions": trans[0], "analytics": analytics[0]},
        {"users": users, "transactions": trans[1], "analytics": analytics[0]},
        {"users": users, "transactions": trans[1], "analytics": analytics[1]},
    ]


def incremental_load_fact(spark: SparkSession, folder: str) -> DataFrame:
    """A full load of all but the last days, then those days one by one, the last of them twice."""
    stage = Stage(spark)
    lake = Lake(spark, stage.path("lake"))
    before, *feeds_by_day = _dumps_by_day(spark, folder, stage)
    load(spark, before, lake, RunContext(CTX.as_of, CTX.processed_at, FULL_LOAD))
    for inputs, day in ((feeds_by_day[0], LAST_ORDERS), (feeds_by_day[1], LAST_EVENTS), (feeds_by_day[1], LAST_EVENTS)):
        load(spark, inputs, lake, RunContext(day, datetime(day.year, day.month, day.day, 18), INCREMENTAL_LOAD))
    return _loaded_fact(lake)


Query = Callable[[SparkSession, str], DataFrame]

# Stages of each query's last call: a result reads them until the query is called again.
_OPEN: dict[tuple[str, str], list[Stage]] = {}


def _tidy(name: str, query: Query) -> Query:
    """The query, removing what its last call has staged."""

    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, name)
        for stage in _OPEN.pop(key, []):
            stage.close()
        with created_stages() as made:
            result = query(spark, folder)
        _OPEN[key] = made
        return result

    return run


# Queries whose rows come in an order, and the columns that order them.
ORDERED = {"gmv_per_month": ["trans_year", "trans_month"], "star_report_top20": ["profile_id_pk"]}

_ALL: dict[str, Query] = {
    "ingest_users": ingest_users,
    "ingest_transactions": ingest_transactions,
    "ingest_analytics": ingest_analytics,
    "day_slice_scan": day_slice_scan,
    "partitioned_roundtrip": partitioned_roundtrip,
    "day_partition_refresh": day_partition_refresh,
    "register_partitions": register_partitions,
    "swap_day_partition": swap_day_partition,
    "append_new_rows": append_new_rows,
    "landed_arrivals": landed_arrivals,
    "compacted_months": compacted_months,
    "new_transactions_by_filter": new_transactions_by_filter,
    "rows_by_user": rows_by_user,
    "run_clock_roundtrip": run_clock_roundtrip,
    "table_contracts": table_contracts,
    "date_parts_iso": date_parts_iso,
    "date_parts_compact": date_parts_compact,
    "incremental_slice_today": incremental_slice_today,
    "incremental_slice_yesterday": incremental_slice_yesterday,
    "incremental_slice_events": incremental_slice_events,
    "flatten_analytics": flatten_events,
    "curate_analytics": curate_analytics,
    "anti_join_new_users": anti_join_new_users,
    "incremental_new_rows": incremental_new_rows_of_day,
    "curate_users": curate_users,
    "dedupe_users": dedupe_users,
    "trans_type_counts": trans_type_counts,
    "trans_profile": trans_profile,
    "trans_profile_by_merge": trans_profile_by_merge,
    "curate_transactions": curate_transactions,
    "gmv_per_month": gmv_per_month,
    "trans_date_bounds": trans_date_bounds,
    "layer_row_counts": layer_row_counts,
    "key_audit": key_audit,
    "surrogate_key_dense": surrogate_key_dense,
    "analytics_latest": analytics_latest,
    "date_dim": date_dim,
    "user_dim": user_dim,
    "trans_dim": trans_dim,
    "analytics_dim": analytics_dim,
    "profile_fact": profile_fact,
    "star_report": star_report,
    "star_report_top20": star_report_top20,
    "late_day_refresh": late_day_refresh,
    "rejected_rows": rejected_rows,
    "cast_rejects": cast_rejects,
    "dedupe_transactions": dedupe_transactions,
    "full_load_fact": full_load_fact,
    "incremental_load_fact": incremental_load_fact,
}

QUERIES = {name: _tidy(name, query) for name, query in _ALL.items()}
