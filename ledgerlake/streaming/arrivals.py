"""Landing by arrival: a run reads only the feed files that no earlier run has read.

Feed folders get new files and no file is changed.  A stream over the folder, run until nothing is left, keeps in its
checkpoint which files were read; its file sink counts a file's rows once, also when a run fails half-way and is
repeated.  Every line goes to the arrivals table ``<root>/arrivals/<feed>/rows``: by day, and by the number of the run;
lines that are not JSON and rows without a day are in the folder without a day.  Then the days that got rows are
replaced in the raw layer by all their arrivals, so that a run that failed in between is repeated without doubles.

The lists of files read and written grow with the number of files, not with their rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas
from ledgerlake.context import RunContext
from ledgerlake.plans.lake import Lake
from ledgerlake.plans.loads import FEED_NAMES, LoadReport, shape_feed
from ledgerlake.plans.together import together
from ledgerlake.sinks.files import child_folders, exists
from ledgerlake.sinks.partitions import many_folders, write_days
from ledgerlake.sources.feeds import CORRUPT, LANDED, stream_feed

RUN = "arrival"

# A file that comes late with an old time stamp is new all the same.
_ANY_AGE = "36500d"


class Arrivals:
    """What has arrived of one feed."""

    def __init__(self, lake: Lake, feed: str) -> None:
        self._lake, self._feed, self._table = lake, feed, f"raw.{feed}"
        self._folder = f"{lake.root}/arrivals/{feed}"

    def _finished(self) -> int:
        """The number of the last run whose days are in the raw layer."""
        done = f"{self._folder}/done"
        names = [n for n in child_folders(self._lake.spark, done) if exists(self._lake.spark, f"{done}/{n}/_SUCCESS")]
        return max((int(n) for n in names), default=0)

    def rows(self) -> DataFrame:
        """Every line that has arrived; what was not landed has no day, and the text of a bad line its ``_corrupt_record``."""
        fields = [*schemas.STORED[self._table][0].fields, T.StructField(CORRUPT, T.StringType()), T.StructField(RUN, T.IntegerType())]
        return self._lake.spark.read.schema(T.StructType(fields)).parquet(f"{self._folder}/rows")

    def _read_new(self, path: str, ctx: RunContext, number: int, files_at_once: int | None) -> None:
        scan = stream_feed(self._lake.spark, self._feed, path, LANDED[self._feed], _ANY_AGE, files_at_once)
        shaped = shape_feed(self._feed, scan, ctx, CORRUPT)
        # Of a bad line some fields may have been read, and so a day.
        days = {p: F.when(F.col(CORRUPT).isNull(), F.col(p)) for p in schemas.DAY_PARTS}
        query = (
            shaped.withColumns(days | {RUN: F.lit(number)})
            .writeStream.format("parquet")
            .partitionBy(*schemas.DAY_PARTS, RUN)
            .option("checkpointLocation", f"{self._folder}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{self._folder}/rows")
        )
        query.awaitTermination()

    def land(self, path: str, ctx: RunContext, report: LoadReport, files_at_once: int | None = None) -> list[date]:
        """Read what is new under ``path`` and replace the days it belongs to; returns these days."""
        last = self._finished()
        if not last and not self._lake.stored(self._table).isEmpty():
            raise ValueError(f"{self._table} was landed otherwise: its days would be replaced by what arrives")
        self._read_new(path, ctx, last + 1, files_at_once)
        found = (
            self.rows().where(F.col(RUN) > last)
            .groupBy(*schemas.DAY_PARTS)
            .agg(F.count(F.lit(1)).alias("rows"), F.count(CORRUPT).alias("lines"))
        )
        per_day = found.collect()  # a row per calendar day at most
        lines = sum(r["lines"] for r in per_day)
        days = [date(r["cryear"], r["crmonth"], r["crday"]) for r in per_day if r["cryear"] is not None]
        report.rejects[f"{self._feed} lines"] = lines
        report.rejects[f"{self._feed} undated"] = sum(r["rows"] for r in per_day if r["cryear"] is None) - lines
        report.rows[self._table] = sum(r["rows"] for r in per_day if r["cryear"] is not None)
        if days:
            write_days(self.rows().drop(CORRUPT, RUN), self._lake.path(self._table), days)
        if per_day:
            found.coalesce(1).write.mode("overwrite").parquet(f"{self._folder}/done/{last + 1:08d}")
        return sorted(days)


def land_arrivals(
    spark: SparkSession,
    inputs: Mapping[str, str],
    lake: Lake,
    ctx: RunContext,
    report: LoadReport,
    files_at_once: int | None = None,
) -> list[date]:
    """Land the files of all feeds that arrived since the last run; returns the days that got rows.

    It can stand in for the landing of an incremental load (``land=land_arrivals``).  Late rows of other days than the
    load's are in the raw layer then, and their days are among those returned.
    """
    lake.create_missing()
    days: set[date] = set()

    def land(feed: str) -> None:
        days.update(Arrivals(lake, feed).land(inputs[feed], ctx, report, files_at_once))

    with many_folders(spark):
        together(*[partial(land, feed) for feed in FEED_NAMES])
    return sorted(days)
