"""What the typed reading of text columns loses, counted per column while the rows pass by.

Feeds are text.  A column that a later step reads as a number or a day has a ``Cast``: the value it is read as, and the
range that value should lie in.  The counts are plain aggregates, so they ride along with a write (``observe``) and
cost no pass of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions.dates import compact_day, iso_day
from ledgerlake.functions.money import money

# Parameters: the range of a rating, and the day before which no row can have been made.
RATINGS = (0, 5)
FIRST_DAY = date(1970, 1, 1)

_KINDS = ("rows_read", "missing", "not_cast", "out_of_range")


@dataclass(frozen=True)
class Cast:
    """A text column, the value it is read as, and the lowest and highest value; None is no bound."""

    column: str
    value: Column
    low: Any = None
    high: Any = None

    def counts(self) -> dict[str, Column]:
        """Aggregates: rows, those without a text, those whose text is no such value, and values out of range.

        An empty text is a text: it is not missing, but no value either.  A row is in one of the last three at most.
        """
        text = F.col(self.column)
        beyond = F.lit(False)
        if self.low is not None:
            beyond = beyond | (self.value < F.lit(self.low))
        if self.high is not None:
            beyond = beyond | (self.value > F.lit(self.high))
        found = (F.lit(1), F.when(text.isNull(), 1), F.when(text.isNotNull() & self.value.isNull(), 1), F.when(beyond, 1))
        return {kind: F.count(what) for kind, what in zip(_KINDS, found)}


def feed_casts(feed: str, as_of: date) -> list[Cast]:
    """The typed columns of a feed; no row can be of a day after ``as_of``."""
    if feed == "users":
        return [
            Cast("rating", F.col("rating").try_cast("double"), *RATINGS),
            Cast("created_at", iso_day("created_at"), FIRST_DAY, as_of),
        ]
    if feed == "transactions":
        return [Cast("amount", money(), 0), Cast("created_at", iso_day("created_at"), FIRST_DAY, as_of)]
    return [
        Cast("event_date", compact_day("event_date"), FIRST_DAY, as_of),
        Cast("operating_system_version", F.col("operating_system_version").try_cast("double"), 0),
    ]


def cast_counts(casts: Sequence[Cast]) -> list[Column]:
    """The aggregates of some columns, named by column and count."""
    return [count.alias(f"{cast.column}.{kind}") for cast in casts for kind, count in cast.counts().items()]


def cast_rows(feed: str, casts: Sequence[Cast], counted: Mapping[str, int]) -> list[tuple]:
    """Rows of the report out of what was counted."""
    return [(feed, c.column, *[counted[f"{c.column}.{kind}"] for kind in _KINDS]) for c in casts]


def cast_report(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """One row per feed and typed column."""
    return spark.createDataFrame(list(rows), schemas.CAST_REPORT)
