"""The run clock: which day a load is for, and the stamp its rows carry."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from ledgerlake import schemas

# The two load modes and the length of the first-run window after midnight.
FULL_LOAD = "FullLoad"
INCREMENTAL_LOAD = "IncrementalLoad"
FIRST_RUN_LAST_MINUTE = 28


@dataclass(frozen=True)
class RunContext:
    """Everything a load needs to know about time; nothing below reads the wall clock."""

    as_of: date
    processed_at: datetime
    mode: str = FULL_LOAD
    first_run_of_day: bool = False

    def __post_init__(self) -> None:
        if self.mode not in (FULL_LOAD, INCREMENTAL_LOAD):
            raise ValueError(f"mode must be {FULL_LOAD} or {INCREMENTAL_LOAD}, got {self.mode!r}")

    @classmethod
    def at(cls, moment: datetime, mode: str = FULL_LOAD) -> "RunContext":
        """Context of a run that starts at ``moment`` (seconds precision)."""
        first = moment.hour == 0 and moment.minute <= FIRST_RUN_LAST_MINUTE
        return cls(moment.date(), moment.replace(microsecond=0), mode, first)

    @property
    def yesterday(self) -> date:
        return self.as_of - timedelta(days=1)

    @property
    def slice_day(self) -> date:
        """The day an incremental run loads: yesterday on the first run of a day, else today."""
        return self.yesterday if self.first_run_of_day else self.as_of


def clock_frame(spark: SparkSession, ctx: RunContext) -> DataFrame:
    """The one-row control table: today and yesterday as text parts."""
    t, y = ctx.as_of, ctx.yesterday
    row = (1, str(t.day), str(t.month), str(t.year), str(y.day), str(y.month), str(y.year))
    return spark.createDataFrame([row], schemas.RUN_CLOCK)


def save_clock(spark: SparkSession, path: str, ctx: RunContext) -> None:
    clock_frame(spark, ctx).coalesce(1).write.mode("overwrite").parquet(path)


def load_clock(spark: SparkSession, path: str) -> tuple[date, date]:
    """(today, yesterday) from the control table, in one action."""
    row = spark.read.schema(schemas.RUN_CLOCK).parquet(path).head()
    if row is None:
        raise ValueError(f"run clock at {path} is empty")
    today = date(int(row["todayyear"]), int(row["todaymonth"]), int(row["todayday"]))
    yesterday = date(int(row["yesterDayYear"]), int(row["yesterDayMonth"]), int(row["yesterdayDay"]))
    return today, yesterday
