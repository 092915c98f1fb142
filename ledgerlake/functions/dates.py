"""Dates out of feed text, and the calendar attributes of a date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.schemas import DAY_PARTS

# Fixed value: the length of the shortest text with a year, a month and a day (2023-1-5).
_SHORTEST_DAY = 8


def iso_day(column: str | Column) -> Column:
    """Calendar day of an ISO text such as 2023-01-05T23:30:00Z; NULL when it is not one.

    The cast alone would take longer years and texts without a day; a dash in fifth place and the length
    rule those out, at a fraction of what a pattern costs.
    """
    text = F.col(column) if isinstance(column, str) else column
    has_day = (F.substring(text, 5, 1) == "-") & (F.length(text) >= _SHORTEST_DAY)
    return F.when(has_day, text.try_cast("date"))


def with_iso_parts(df: DataFrame, column: str = "created_at") -> DataFrame:
    """Add cryear, crmonth, crday of an ISO timestamp text."""
    # A column of its own, so that the text is parsed once and not once per part.
    day = "_day"
    parts = {"cryear": F.year(day), "crmonth": F.month(day), "crday": F.dayofmonth(day)}
    return df.withColumn(day, iso_day(column)).withColumns(parts).drop(day)


def compact_day(column: str | Column) -> Column:
    """Calendar day of a text that begins with yyyyMMdd; NULL when it does not, or names no day."""
    text = F.col(column) if isinstance(column, str) else column
    dashed = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(text.rlike("^[0-9]{8}"), dashed.try_cast("date"))


def with_compact_parts(df: DataFrame, column: str = "event_date") -> DataFrame:
    """Add cryear, crmonth, crday of a yyyyMMdd text."""
    day = "_day"
    parts = {"cryear": F.year(day), "crmonth": F.month(day), "crday": F.dayofmonth(day)}
    return df.withColumn(day, compact_day(column)).withColumns(parts).drop(day)


def parts_date() -> Column:
    """The date of cryear, crmonth, crday; NULL when a part is missing or out of range."""
    dash = F.lit("-")
    text = F.concat(F.col("cryear"), dash, F.col("crmonth"), dash, F.col("crday"))
    return text.try_cast("date")


def on_day(day: date) -> Column:
    """Equality on the three part columns, in the form that prunes partition folders."""
    return (F.col("cryear") == day.year) & (F.col("crmonth") == day.month) & (F.col("crday") == day.day)


def without_parts(df: DataFrame) -> DataFrame:
    return df.drop(*DAY_PARTS)


def calendar_columns(day: str = "trans_date") -> dict[str, Column]:
    """Attributes of the calendar dimension; Monday is day 0 of the week."""
    d = F.col(day)
    weekday = F.weekday(d)
    return {
        "trans_year": F.year(d),
        "trans_month": F.month(d),
        "trans_quarter": F.quarter(d),
        "trans_day": F.dayofmonth(d),
        "trans_dayofweek": weekday,
        "trans_dayname": F.date_format(d, "EEEE"),
        "trans_dayofmonth": F.dayofmonth(d),
        "trans_weekday": F.when(weekday >= 5, F.lit("Weekend")).otherwise(F.lit("Weekday")),
    }
