"""Amounts arrive as text; these turn them into exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.schemas import MONEY


def money(column: str = "amount") -> Column:
    """The text as an exact decimal, NULL when it is not a number."""
    return F.col(column).try_cast(MONEY)


def in_millions(total: Column) -> Column:
    """A decimal total in millions, as a double rounded to two places."""
    return F.round(total.cast("double") / F.lit(1000000), 2)
