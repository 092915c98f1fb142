"""Full and incremental loads through the layers.

``inputs`` maps users, transactions and analytics to the folders or files their JSON lines lie in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas
from ledgerlake.context import FULL_LOAD, RunContext
from ledgerlake.functions.dates import on_day, with_compact_parts, with_iso_parts
from ledgerlake.operators import curate, dims, fact
from ledgerlake.operators.casts import cast_counts, cast_report, cast_rows, feed_casts
from ledgerlake.operators.flatten import flatten_analytics
from ledgerlake.operators.newrows import incremental_new_rows, new_rows, with_key, without_key
from ledgerlake.operators.sketches import new_rows_by_month
from ledgerlake.operators.skew import join_unique, key_counts
from ledgerlake.plans.lake import Lake, bucket_of
from ledgerlake.plans.together import together
from ledgerlake.sinks.files import delete_tree
from ledgerlake.sinks.partitions import late_day_refresh, many_folders, stamp
from ledgerlake.sinks.stage import Stage
from ledgerlake.sources.feeds import LANDED, bad_line_count, bad_lines, good_rows, scan_feed

FEED_NAMES = ("users", "transactions", "analytics")
CASTS, RUN, FEED = "casts", "run", "feed"  # folder and partition columns of the counts of typed columns


@dataclass
class LoadReport:
    """Rows written per table, and lines or rows that could not be used."""

    rows: dict[str, int] = field(default_factory=dict)
    rejects: dict[str, int] = field(default_factory=dict)


def load(spark: SparkSession, inputs: Mapping[str, str], lake: Lake, ctx: RunContext) -> LoadReport:
    """Run the load that the context's mode names."""
    run = full_load if ctx.mode == FULL_LOAD else incremental_load
    return run(spark, inputs, lake, ctx)


# --- landing ---------------------------------------------------------------------------------------------


def shape_feed(feed: str, rows: DataFrame, ctx: RunContext, *extra: str) -> DataFrame:
    """Feed rows as the source layer stores them, with ``extra`` columns of the feed kept."""
    dated = with_compact_parts(flatten_analytics(rows, *extra)) if feed == "analytics" else with_iso_parts(rows)
    return stamp(dated, ctx).select(*schemas.names(schemas.STORED[f"raw.{feed}"][0]), *extra)


class _Landing:
    """One feed on its way in: every line is landed, set aside as unreadable, or set aside as undated.

    What its typed columns hold is counted on the way.
    """

    def __init__(self, spark: SparkSession, feed: str, path: str, ctx: RunContext) -> None:
        self._lines, self._undated = Observation(), Observation()
        self.feed, self.ctx = feed, ctx
        self._scan = scan_feed(spark, feed, path, LANDED[feed])
        counted = self._scan.observe(self._lines, bad_line_count().alias("n"))
        shaped = shape_feed(feed, good_rows(counted), ctx)
        # A row without a day is in no day's folder, so no run could ever come back to it.
        without_day = F.count(F.when(F.col("cryear").isNull(), 1))
        self._casts = feed_casts(feed, ctx.as_of)
        seen = shaped.observe(self._undated, without_day.alias("n"), *cast_counts(self._casts))
        self.rows = seen.where(F.col("cryear").isNotNull())

    def set_aside(self, lake: Lake, report: LoadReport) -> None:
        """Keep what was not landed, once ``rows`` has been written."""
        lost = {
            "lines": (self._lines, lambda: bad_lines(self._scan)),
            "undated": (
                self._undated,
                lambda: shape_feed(self.feed, good_rows(self._scan), self.ctx).where(F.col("cryear").isNull()),
            ),
        }
        for name, (seen, rows) in lost.items():
            report.rejects[f"{self.feed} {name}"] = seen.get["n"]
            if seen.get["n"]:
                rows().write.mode("overwrite").parquet(_set_aside(lake, f"{self.feed}_{name}", self.ctx))

    def report_casts(self, lake: Lake) -> None:
        """Store the counts of the typed columns, once ``rows`` has been written; a repeated run replaces its own."""
        rows = cast_rows(self.feed, self._casts, self._undated.get)
        path = f"{lake.root}/{CASTS}/{RUN}={_run_name(self.ctx)}/{FEED}={self.feed}"
        # A row per typed column.
        cast_report(lake.spark, rows).drop(FEED).coalesce(1).write.mode("overwrite").parquet(path)


def stored_casts(lake: Lake) -> DataFrame:
    """The counts of all runs: ``run`` (a day, or "full") and the report's columns."""
    stored = lake.spark.read.schema(T.StructType([T.StructField(RUN, T.StringType()), *schemas.CAST_REPORT.fields]))
    return stored.parquet(f"{lake.root}/{CASTS}").select(RUN, *schemas.names(schemas.CAST_REPORT))


def land_all(spark: SparkSession, inputs: Mapping[str, str], lake: Lake, ctx: RunContext, report: LoadReport) -> None:
    """Land whole feeds."""

    def land(feed: str) -> None:
        landing = _Landing(spark, feed, inputs[feed], ctx)
        _rewrite(lake, f"raw.{feed}", landing.rows, report)
        landing.set_aside(lake, report)
        landing.report_casts(lake)

    with many_folders(spark):
        together(*[partial(land, feed) for feed in FEED_NAMES])


def land_day(spark: SparkSession, inputs: Mapping[str, str], lake: Lake, ctx: RunContext, report: LoadReport) -> None:
    """Replace the run's day of every feed."""

    def land(feed: str) -> None:
        landing = _Landing(spark, feed, inputs[feed], ctx)
        # A feed that is empty or all of another day still has to be read to the end to be counted.
        report.rows[f"raw.{feed}"] = late_day_refresh(landing.rows, lake.path(f"raw.{feed}"), ctx)
        landing.set_aside(lake, report)
        landing.report_casts(lake)

    together(*[partial(land, feed) for feed in FEED_NAMES])


# --- full load -------------------------------------------------------------------------------------------


def _set_aside(lake: Lake, name: str, ctx: RunContext) -> str:
    """Folder for what a run cannot use; a repeated run replaces its own."""
    return f"{lake.root}/quarantine/{name}/{_run_name(ctx)}"


def _run_name(ctx: RunContext) -> str:
    return "full" if ctx.mode == FULL_LOAD else ctx.slice_day.isoformat()


class _Keyed:
    """Source rows with a natural key; those without one are counted on the way and set aside afterwards."""

    def __init__(self, feed: str, source: DataFrame, keys: list[str]) -> None:
        self._feed, self._source, self._keys, self._lost = feed, source, keys, Observation()
        missing = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
        self.rows = with_key(source.observe(self._lost, F.count(F.when(missing, 1)).alias("n")), keys)

    def set_aside(self, lake: Lake, ctx: RunContext, report: LoadReport) -> None:
        """Keep the rows without a key, once ``rows`` has been read to the end. Most often there are none to read."""
        lost, path = self._lost.get["n"], _set_aside(lake, f"{self._feed}_without_key", ctx)
        report.rejects[f"{self._feed} without key"] = lost
        if lost:
            without_key(self._source, self._keys).write.mode("overwrite").parquet(path)
        else:
            delete_tree(lake.spark, path)


def _curate_trans(valid: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return curate.trans_core(valid.observe(seen, curate.amount_rejects().alias("amounts"))), seen


def full_load(spark: SparkSession, inputs: Mapping[str, str], lake: Lake, ctx: RunContext) -> LoadReport:
    """Rebuild every layer from whole feeds."""
    report = LoadReport()
    land_all(spark, inputs, lake, ctx, report)
    together(
        lambda: _curate_all_users(lake, ctx, report),
        lambda: _curate_all_transactions(lake, ctx, report),
        lambda: _rewrite(
            lake, "curated.analytics", _curated_events(lake.stored("raw.analytics")), report
        ),
    )
    with Stage(spark) as stage:
        added = F.lit(ctx.as_of).alias("added_on")
        core = lake.stored("curated.transactions")
        users, events = lake.stored("curated.users"), lake.stored("curated.analytics")
        together(
            lambda: _rewrite(
                lake, "consumption.date_dim", dims.calendar(dims.day_bounds(core)).coalesce(1), report
            ),
            lambda: _rewrite(
                lake, "consumption.user_dim", dims.user_dim(users, stage).select("*", added), report
            ),
            lambda: _rewrite(lake, "consumption.trans_dim", dims.trans_dim_store(core, stage), report),
            lambda: _rewrite(
                lake,
                "consumption.analytics_dim",
                dims.analytics_dim(dims.analytics_latest(events), stage).select("*", added),
                report,
            ),
        )
        # The lifetime profile holds the rows per user of a whole load.
        per_user = lake.stored("curated.trans_profile").select("user_id", F.col("trans_rows").alias("rows"))
        rows = stage.keep(_star_rows(lake, lake.stored("consumption.trans_dim"), per_user), "star")
        _rewrite(lake, "consumption.profile_fact", fact.number_fact(rows, stage), report)
    gmv = fact.gmv_per_month(lake.stored("consumption.profile_fact"))
    _rewrite(lake, "consumption.gmv_per_month", _in_month_order(gmv), report)
    return report


def _curated_events(events: DataFrame) -> DataFrame:
    return curate.dedupe_events(curate.curate_analytics(events))


def _rewrite(lake: Lake, table: str, df: DataFrame, report: LoadReport) -> None:
    report.rows[table] = lake.write_version(table, df)


def _curate_all_users(lake: Lake, ctx: RunContext, report: LoadReport) -> None:
    keyed = _Keyed("users", lake.stored("raw.users"), ["user_id"])
    _rewrite(lake, "curated.users", curate.curate_users(curate.dedupe_users(keyed.rows), ctx), report)
    keyed.set_aside(lake, ctx, report)


def _curate_all_transactions(lake: Lake, ctx: RunContext, report: LoadReport) -> None:
    keyed = _Keyed("transactions", lake.stored("raw.transactions"), ["transaction_id"])
    core, seen = _curate_trans(curate.dedupe_transactions(keyed.rows))
    _rewrite(lake, "curated.transactions", core, report)
    lake.write_filters("curated.transactions")
    keyed.set_aside(lake, ctx, report)
    report.rejects["transactions amounts"] = seen.get["amounts"]
    daily = curate.trans_daily(lake.stored("curated.transactions"))
    _rewrite(lake, "curated.trans_daily", daily, report)
    _rewrite_profile(lake, report)


def refresh_profile(lake: Lake, day: date) -> int:
    """Sum the users of ``day`` and of their buckets anew from the daily sums; returns the rows written.

    It follows from what is stored, so a repeated run gives the same.
    """
    table = "curated.trans_profile"
    buckets = lake.buckets_of(table, lake.day("curated.trans_daily", day))
    if not buckets:
        return 0
    daily = lake.stored("curated.trans_daily").where(bucket_of("user_id").isin(buckets))
    return lake.replace_buckets(table, curate.profile_of_daily(daily))


def _rewrite_profile(lake: Lake, report: LoadReport) -> None:
    profile = curate.profile_of_daily(lake.stored("curated.trans_daily"))
    _rewrite(lake, "curated.trans_profile", profile, report)


def _star_rows(lake: Lake, trans: DataFrame, per_user: DataFrame) -> DataFrame:
    return fact.star_rows(
        trans,
        lake.stored("consumption.user_dim"),
        lake.stored("consumption.analytics_dim"),
        lake.stored("consumption.date_dim"),
        per_user,
    )


# --- incremental load ------------------------------------------------------------------------------------


def incremental_load(
    spark: SparkSession,
    inputs: Mapping[str, str],
    lake: Lake,
    ctx: RunContext,
    land: Callable[[SparkSession, Mapping[str, str], Lake, RunContext, LoadReport], object] = land_day,
) -> LoadReport:
    """Add one day to every layer; ``land`` brings it into the raw layer.

    Old transactions and fact rows are not rewritten.  What a step adds is decided by comparing the day with
    what is stored, so a run can be repeated, also after it failed half-way.  What grows with the history is
    read narrowly: the key filters of the transactions, the daily sums per user, the last surrogate keys.
    """
    report = LoadReport()
    day = ctx.slice_day
    lake.create_missing()
    land(spark, inputs, lake, ctx, report)
    with Stage(spark) as stage:
        _curate_day(lake, ctx, stage, report)
        _extend_dims(spark, lake, day, stage, report)
        _extend_fact(lake, day, stage, report)
    return report


def _curate_day(lake: Lake, ctx: RunContext, stage: Stage, report: LoadReport) -> None:
    together(
        lambda: _curate_users_of_day(lake, ctx, stage, report),
        lambda: _curate_transactions_of_day(lake, ctx, stage, report),
        lambda: _curate_events_of_day(lake, ctx, report),
    )


def _add(lake: Lake, table: str, df: DataFrame, report: LoadReport) -> None:
    report.rows[table] = lake.append(table, df)


def _curate_users_of_day(lake: Lake, ctx: RunContext, stage: Stage, report: LoadReport) -> None:
    keyed = _Keyed("users", lake.day("raw.users", ctx.slice_day), ["user_id"])
    users = stage.keep(curate.dedupe_users(keyed.rows), "users")
    keyed.set_aside(lake, ctx, report)
    # All curated users, not one day of them: a user sent again on a later day stays one row.
    users = new_rows(users, lake.stored("curated.users"), ["user_id"], unique=True)
    _add(lake, "curated.users", curate.curate_users(users, ctx), report)


def _curate_transactions_of_day(lake: Lake, ctx: RunContext, stage: Stage, report: LoadReport) -> None:
    day, key = ctx.slice_day, ["transaction_id"]
    keyed = _Keyed("transactions", lake.day("raw.transactions", day), key)
    core, seen = _curate_trans(curate.dedupe_transactions(keyed.rows))
    core = stage.keep(core, "core")
    keyed.set_aside(lake, ctx, report)
    report.rejects["transactions amounts"] = seen.get["amounts"]
    # All days and not this one only: an id that is sent again under another day stays one row.  Ids are read of
    # those months alone whose filters may hold one of the day's.
    stored, filters = lake.stored("curated.transactions"), lake.filters("curated.transactions")
    if filters is None:
        core = new_rows(core, stored, key, unique=True)
    else:
        core = new_rows_by_month(core, stored, filters, *key)
    core = stage.keep(core, "new_core")
    lake.append_filters("curated.transactions", core)
    _add(lake, "curated.transactions", core, report)
    daily = curate.trans_daily(lake.day("curated.transactions", day))
    report.rows["curated.trans_daily"] = lake.replace_day("curated.trans_daily", daily, day)
    report.rows["curated.trans_profile"] = refresh_profile(lake, day)


def _curate_events_of_day(lake: Lake, ctx: RunContext, report: LoadReport) -> None:
    events = _curated_events(lake.day("raw.analytics", ctx.slice_day))
    record = [c for c in schemas.names(schemas.CURATED_ANALYTICS) if c != "processed_at"]
    events = incremental_new_rows(events, lake.stored("curated.analytics"), ctx, record, False)
    _add(lake, "curated.analytics", events, report)


def _extend_dims(spark: SparkSession, lake: Lake, day: date, stage: Stage, report: LoadReport) -> None:
    core = lake.day("curated.transactions", day)

    def dates() -> None:
        if not core.isEmpty():
            more = dims.new_dates(spark, lake.stored("consumption.date_dim"), day, day)
            _add(lake, "consumption.date_dim", more.coalesce(1), report)

    def users() -> None:
        known = lake.stored("consumption.user_dim")
        fresh = stage.keep(new_rows(lake.day("curated.users", day), known, ["user_id"], unique=True), "new_users")
        keyed = dims.new_users(fresh, known, stage).withColumn("added_on", F.lit(day))
        _add(lake, "consumption.user_dim", keyed, report)

    def transactions() -> None:
        known = lake.stored("consumption.trans_dim")
        fresh = stage.keep(new_rows(core, known.where(on_day(day)), ["transaction_id"]), "new_trans")
        _add(lake, "consumption.trans_dim", dims.new_trans(fresh, known, stage), report)

    def events() -> None:
        table = "consumption.analytics_dim"
        latest = stage.keep(dims.analytics_latest(lake.day("curated.analytics", day)), "latest")
        buckets = lake.buckets_of(table, latest)
        report.rows[table] = 0
        if buckets:
            known = lake.in_buckets(table, buckets)
            merged = dims.merge_analytics(known, latest, day, stage, lake.stored(table))
            report.rows[table] = lake.replace_buckets(table, merged)

    together(dates, users, transactions, events)


def _extend_fact(lake: Lake, day: date, stage: Stage, report: LoadReport) -> None:
    """Fact rows for the day's transactions, and for older transactions of users who became known."""
    table = "consumption.profile_fact"
    candidates = lake.day("consumption.trans_dim", day)
    waiting = stage.keep(_users_with_older_rows(lake, day), "waiting")
    if not waiting.isEmpty():
        candidates = candidates.unionByName(_older_rows(lake, waiting, day))
    # Who is heavy is a matter of these rows, not of the history.
    rows = stage.keep(_star_rows(lake, candidates, key_counts(candidates, ["user_id"])), "star")
    stored = lake.stored(table)
    # Only the months at hand are read of the fact.
    have = _of_months(stored, rows).withColumnRenamed("trans_id_fk", "trans_id_pk")
    rows = stage.keep(new_rows(rows, have, ["trans_id_pk"], unique=True), "fresh")
    start = dims.highest_key(stored, "profile_id_pk")
    report.rows[table] = lake.append(table, fact.number_fact(rows, stage, start))
    _refresh_gmv(lake, rows, day, stage, report)


def _of_months(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """The month folders of a table that some rows fall into: one per calendar month at most, most often one."""
    found = rows.select(*schemas.MONTH_PARTS).distinct().collect()
    picked = [(F.col("trans_year") == m["trans_year"]) & (F.col("trans_month") == m["trans_month"]) for m in found]
    return stored.where(reduce(lambda a, b: a | b, picked, F.lit(False)))


def _users_with_older_rows(lake: Lake, day: date) -> DataFrame:
    """Users who became known on ``day`` and have transactions on other days, by comparing their lifetime
    row count with that of the day; transactions themselves are not read."""
    added = F.col("added_on") == F.lit(day)
    known_now = (
        lake.stored("consumption.user_dim").where(added).select("user_id")
        .union(lake.stored("consumption.analytics_dim").where(added).select("user_id"))
        .distinct()
    )
    lifetime = lake.stored("curated.trans_profile").select("user_id", F.col("trans_rows").alias("all_rows"))
    today = lake.day("curated.trans_daily", day).select("user_id", "trans_rows")
    both = known_now.join(lifetime, "user_id").join(today, "user_id", "left")
    return both.where(F.col("all_rows") > F.coalesce("trans_rows", F.lit(0))).select("user_id")


def _older_rows(lake: Lake, users: DataFrame, day: date) -> DataFrame:
    """Transactions of ``users`` on other days, read from the months they occur in."""
    other = ~F.coalesce(on_day(day), F.lit(False))
    parts = list(schemas.DAY_PARTS)
    daily = lake.stored("curated.trans_daily").where(other)
    # At most one row per calendar day.
    days = F.broadcast(daily.join(users, "user_id", "left_semi").select(*parts).distinct())
    trans = lake.stored("consumption.trans_dim").where(other)
    counts = daily.join(users, "user_id", "left_semi").groupBy("user_id").agg(F.sum("trans_rows").alias("rows"))
    there = trans.join(days, parts, "left_semi")
    return join_unique(there, users, ["user_id"], "inner", counts, F.col("trans_id_pk")).select(*trans.columns)


def _refresh_gmv(lake: Lake, fresh: DataFrame, day: date, stage: Stage, report: LoadReport) -> None:
    """Recompute the months this run touched from their fact partitions; keep the others."""
    table, parts = "consumption.gmv_per_month", list(schemas.MONTH_PARTS)
    this = fresh.sparkSession.createDataFrame([(day.year, day.month)], "trans_year int, trans_month int")
    # At most one row per calendar month.
    months = F.broadcast(stage.keep(fresh.select(*parts).union(this).distinct().coalesce(1), "months"))
    touched = _of_months(lake.stored("consumption.profile_fact"), months)
    others = lake.stored(table).join(months, parts, "left_anti")
    gmv = fact.gmv_per_month(touched).unionByName(others)
    _rewrite(lake, table, _in_month_order(gmv), report)


def _in_month_order(gmv: DataFrame) -> DataFrame:
    """The monthly table is one small file, by year and month."""
    return gmv.coalesce(1).sortWithinPartitions(*schemas.MONTH_PARTS)
