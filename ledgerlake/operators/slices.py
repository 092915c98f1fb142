"""One calendar day out of a feed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.functions.dates import iso_day


def iso_day_slice(feed: DataFrame, day: date, column: str = "created_at") -> DataFrame:
    """Rows whose ISO timestamp text falls on ``day``."""
    return feed.where(iso_day(column) == F.lit(day))


def compact_day_slice(feed: DataFrame, day: date, column: str = "event_date") -> DataFrame:
    """Rows whose yyyyMMdd text is ``day``; a plain comparison, so it reaches the scan."""
    return feed.where(F.col(column) == F.lit(day.strftime("%Y%m%d")))


def incremental_slice(feed: DataFrame, ctx: RunContext, column: str = "created_at") -> DataFrame:
    """The rows an incremental run takes: yesterday's on the first run of a day, else today's."""
    return iso_day_slice(feed, ctx.slice_day, column)
