"""Partitioned Parquet: append, replace a day, late-day refresh.

Two layouts: a folder per day (the raw layer, where days are registered and replaced), and a folder per month with
rows in day order (all else).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.functions.dates import on_day, without_parts
from ledgerlake.schemas import DAY_MONTHS, DAY_PARTS, order_within

# Row groups of a month in day order: small ones leave more to skip when a day is read.
ROW_GROUP_BYTES = 32 << 20

# Adaptive planning joins shuffle partitions up to this size, whatever the number of folders they are written to.
_LEAST_PARTITION = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
_LEAST_BYTES = "4k"


def stamp(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Add the load time."""
    text = ctx.processed_at.strftime("%Y-%m-%d %H:%M:%S")
    return df.withColumn("processed_at", F.to_timestamp(F.lit(text), "yyyy-MM-dd HH:mm:ss"))


def rebalance(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition folder together before a write.

    A rebalance and not a plain repartition: the adaptive planner cuts an oversized day into several
    tasks and joins small days, so neither a hot day nor many small files result.  Without columns rows
    are dealt out evenly, which suits a write into one folder.
    """
    return df.hint("rebalance", *[F.col(c) for c in by])


@contextmanager
def many_folders(spark: SparkSession) -> Iterator[None]:
    """For writes into far more folders than their bytes suggest: few rows of many days are written by all cores.

    Opening a file costs some milliseconds. Without this, up to a megabyte is written by one task, which may be years
    of days. Large writes are not affected, as each of their tasks is beyond either size.
    """
    before = spark.conf.get(_LEAST_PARTITION)
    spark.conf.set(_LEAST_PARTITION, _LEAST_BYTES)
    try:
        yield
    finally:
        spark.conf.set(_LEAST_PARTITION, before)


def in_folder_order(df: DataFrame, parts: Sequence[str], by: Sequence[str] | None = None) -> DataFrame:
    """Rows brought together by folder, and in the order they have within one."""
    together, within = rebalance(df, by or parts), order_within(tuple(parts))
    return together.sortWithinPartitions(*parts, *within) if within else together


def write_partitioned(
    df: DataFrame,
    path: str,
    parts: Sequence[str] = DAY_PARTS,
    mode: str = "append",
    by: Sequence[str] | None = None,
) -> int:
    """Write Snappy Parquet into partition folders; returns the number of rows written.

    ``by`` names the columns that bring rows together before the write (the partition columns unless
    given).  The count comes from the write job itself, not from a second pass.
    """
    seen = Observation()
    (
        in_folder_order(df, parts, by)
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .option("compression", "snappy")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("partitionOverwriteMode", "static")
        .partitionBy(*parts)
        .parquet(path)
    )
    return seen.get["rows"]


def replace_day(df: DataFrame, path: str, day: date) -> int:
    """Make ``df``'s rows of ``day`` the only content of that day's folder; returns their number.

    The new files are committed before the old ones go (dynamic overwrite).  Dynamic overwrite leaves a
    folder alone when there is nothing to write, so an empty slice is written into the folder directly.
    """
    rows = df.where(on_day(day))
    seen = Observation()
    (
        rebalance(rows, ())
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY_PARTS)
        .parquet(path)
    )
    written = seen.get["rows"]
    if written == 0:
        empty = without_parts(df).limit(0)
        empty.write.mode("overwrite").option("compression", "snappy").parquet(day_folder(path, day))
    return written


def write_days(df: DataFrame, path: str, days: Sequence[date]) -> None:
    """``replace_day`` for several days in one job, each of which must have rows; other days' folders stay.

    The days are one set of numbers, looked up per folder when the files are listed.
    """
    number = F.col("cryear") * 10000 + F.col("crmonth") * 100 + F.col("crday")
    (
        in_folder_order(df.where(number.isin([d.year * 10000 + d.month * 100 + d.day for d in days])), DAY_PARTS)
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY_PARTS)
        .parquet(path)
    )


def replace_day_in_month(df: DataFrame, stored: DataFrame, path: str, day: date) -> int:
    """``replace_day`` for a table with month folders; returns the number of ``df``'s rows of ``day``.

    The month is written again, with the other days' rows of ``stored``, and no other month is read or written. The
    new files are complete before the old ones go; a repeated run gives the same.
    """
    fresh, seen = df.where(on_day(day)), Observation()
    month = (F.col("cryear") == day.year) & (F.col("crmonth") == day.month)
    others = stored.where(month & ~F.coalesce(F.col("crday") == day.day, F.lit(False)))
    both = fresh.select(*stored.columns).unionByName(others)
    of_day = F.count(F.when(F.col("crday") == day.day, 1))
    (
        in_folder_order(both, DAY_MONTHS)
        .observe(seen, of_day.alias("rows"), F.count(F.lit(1)).alias("all"))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY_MONTHS)
        .parquet(path)
    )
    if seen.get["all"] == 0:
        # Dynamic overwrite leaves a folder alone when there is nothing to write into it.
        empty = stored.drop(*DAY_MONTHS).limit(0)
        empty.write.mode("overwrite").option("compression", "snappy").parquet(month_folder(path, day))
    return seen.get["rows"]


def month_folder(path: str, day: date) -> str:
    return f"{path}/cryear={day.year}/crmonth={day.month}"


def day_folder(path: str, day: date) -> str:
    return f"{month_folder(path, day)}/crday={day.day}"


def late_day_refresh(feed: DataFrame, path: str, ctx: RunContext) -> int:
    """Replace the day this run is for: yesterday on the first run of a day, today afterwards."""
    return replace_day(feed, path, ctx.slice_day)
