"""The four dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions.dates import calendar_columns, iso_day, parts_date
from ledgerlake.operators.curate import first_per_key
from ledgerlake.operators.keys import dense_key, extend_keys, highest_key
from ledgerlake.sinks.stage import Stage

ACTIVE = "Y"
USER_ORDER = ("user_id",)
TRANS_ORDER = ("user_id", "transaction_id")


def _active(df: DataFrame) -> DataFrame:
    return df.withColumn("isActive", F.lit(ACTIVE))


# --- calendar --------------------------------------------------------------------------------------------


def trans_date_bounds(transactions: DataFrame, column: str = "created_at") -> DataFrame:
    """First and last timestamp text and calendar day, in one pass."""
    day = iso_day(column)
    return transactions.agg(
        F.min(column).alias("min_trans_dt"),
        F.max(column).alias("max_trans_dt"),
        F.min(day).alias("min_trans_date"),
        F.max(day).alias("max_trans_date"),
    )


def calendar(bounds: DataFrame, first_key: int = 1) -> DataFrame:
    """Every day from min_trans_date to max_trans_date with its attributes.

    The key is the day's distance from the first day.  Years have four digits, so there are at most 3.7
    million rows whatever the feed holds.
    """
    days = F.sequence("min_trans_date", "max_trans_date", F.expr("interval 1 day"))
    key = F.datediff(F.col("trans_date"), F.col("min_trans_date")) + F.lit(first_key)
    return (
        bounds.select("min_trans_date", F.explode(days).alias("trans_date"))
        .select(key.cast("int").alias("date_id_pk"), "trans_date")
        .withColumns(calendar_columns())
        .select(*schemas.names(schemas.DATE_DIM))
    )


def day_bounds(table: DataFrame) -> DataFrame:
    """First and last day of a table, from its date columns alone."""
    days = table.select(*schemas.DAY_PARTS).distinct().select(parts_date().alias("_day"))
    return days.agg(F.min("_day").alias("min_trans_date"), F.max("_day").alias("max_trans_date"))


def date_dim(transactions: DataFrame) -> DataFrame:
    return calendar(trans_date_bounds(transactions))


def new_dates(spark: SparkSession, existing: DataFrame, first: date, last: date) -> DataFrame:
    """Days from ``first`` to ``last``, and any gap up to them, that the calendar lacks.

    Keys continue after the last key, in date order.  Works on the calendar alone, which is small.
    """
    have = existing.agg(F.min("trans_date").alias("lo"), F.max("trans_date").alias("hi")).head()
    gaps = []
    if have["lo"] is None:
        gaps.append((first, last))
    else:
        if first < have["lo"]:
            gaps.append((first, date.fromordinal(have["lo"].toordinal() - 1)))
        if last > have["hi"]:
            gaps.append((date.fromordinal(have["hi"].toordinal() + 1), last))
    next_key = highest_key(existing, "date_id_pk") + 1
    frames = []
    for lo, hi in gaps:
        bounds = spark.createDataFrame([(lo, hi)], "min_trans_date date, max_trans_date date")
        frames.append(calendar(bounds, next_key))
        next_key += (hi - lo).days + 1
    if not frames:
        return existing.limit(0)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


# --- users, transactions, analytics -----------------------------------------------------------------------


def user_dim(users: DataFrame, stage: Stage) -> DataFrame:
    """Curated users with keys in user order."""
    keyed = dense_key(users, USER_ORDER, "user_id_pk", stage)
    return _active(keyed).select(*schemas.names(schemas.USER_DIM))


def new_users(users: DataFrame, existing: DataFrame, stage: Stage) -> DataFrame:
    keyed = extend_keys(users, existing, USER_ORDER, "user_id_pk", stage)
    return _active(keyed).select(*schemas.names(schemas.USER_DIM))


def trans_dim_store(core: DataFrame, stage: Stage) -> DataFrame:
    """Curated transactions with keys in (user, transaction) order, without the profile columns."""
    keyed = dense_key(core, TRANS_ORDER, "trans_id_pk", stage)
    return _active(keyed).select(*schemas.names(schemas.TRANS_DIM_STORE))


def new_trans(core: DataFrame, existing: DataFrame, stage: Stage) -> DataFrame:
    keyed = extend_keys(core, existing, TRANS_ORDER, "trans_id_pk", stage)
    return _active(keyed).select(*schemas.names(schemas.TRANS_DIM_STORE))


def _latest_first(tie_break: Sequence[str]) -> list[Column]:
    columns = [*schemas.DAY_PARTS, *tie_break]
    return [F.col(c).desc_nulls_last() for c in columns]


_PAYLOAD = [c for c in schemas.names(schemas.CURATED_ANALYTICS) if c not in ("user_id", *schemas.DAY_PARTS)]


def analytics_latest(events: DataFrame, tie_break: Sequence[str] = _PAYLOAD) -> DataFrame:
    """The latest event of each user: by day, then by ``tie_break`` (the event's own columns unless a
    finer clock is at hand)."""
    return first_per_key(events, ["user_id"], _latest_first(tie_break))


def analytics_dim(latest: DataFrame, stage: Stage) -> DataFrame:
    """Latest events with keys in user order."""
    keyed = dense_key(latest, USER_ORDER, "analytics_id_pk", stage)
    return _active(keyed).select(*schemas.names(schemas.ANALYTICS_DIM))


def merge_analytics(
    existing: DataFrame, latest: DataFrame, added_on: date, stage: Stage, whole: DataFrame | None = None
) -> DataFrame:
    """``existing`` rows of the analytics dimension as they are after a day: known users keep their key and take the
    later event, new users get keys after the last one of the ``whole`` dimension (``existing`` unless given)."""
    columns = [*schemas.names(schemas.CURATED_ANALYTICS)]
    key, since = "analytics_id_pk", "added_on"
    old = existing.select(key, since, *columns)
    new = latest.select(
        F.lit(None).cast("bigint").alias(key), F.lit(None).cast("date").alias(since), *columns
    )
    both = old.unionByName(new)
    # At most two rows per user: the stored one and the day's latest.
    order = F.struct(*schemas.DAY_PARTS, *_PAYLOAD)
    kept = both.groupBy("user_id").agg(
        F.max(key).alias(key),
        F.max(since).alias(since),
        F.max_by(F.struct(*[c for c in columns if c != "user_id"]), order).alias("_event"),
    )
    merged = stage.keep(kept.select(key, since, "user_id", "_event.*"), "analytics_merge")
    fresh = merged.where(F.col(key).isNull()).drop(key, since)
    keyed = extend_keys(fresh, existing if whole is None else whole, USER_ORDER, key, stage).withColumn(since, F.lit(added_on))
    every = merged.where(F.col(key).isNotNull()).unionByName(keyed)
    return _active(every).select(*schemas.names(schemas.ANALYTICS_DIM_STORE))
