"""Which rows of a source are not in a table yet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.operators.skew import fits, join_unique, key_counts, row_id
from ledgerlake.sources.layers import day_slice


def with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a complete natural key."""
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def without_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to quarantine: a NULL key matches nothing, so such a row would enter again on every run."""
    return df.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def new_rows(source: DataFrame, existing: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Source rows whose complete key does not occur in ``existing``.

    Only key columns of ``existing`` are read.  For a small source, its keys are broadcast to the existing
    table, which is then scanned but not shuffled; what it finds is no larger than the source and is
    broadcast back.  Otherwise both sides are shuffled, and a key that fills much of the source is cut into
    pieces.  ``source`` is a table scan or a staged table; ``unique`` says that ``existing`` holds each key
    once, which saves reducing it to that.
    """
    valid = with_key(source, keys)
    if fits(source):
        wanted = F.broadcast(valid.select(*keys).distinct())
        found = existing.select(*keys).join(wanted, list(keys), "left_semi").distinct()
        return valid.join(F.broadcast(found), list(keys), "left_anti").select(*source.columns)
    known = existing.select(*keys)
    if not unique:
        known = known.distinct()
    rows = join_unique(valid, known, keys, "left_anti", key_counts(valid, keys), row_id())
    return rows.select(*source.columns)


def new_records(source: DataFrame, existing: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Source rows that do not occur in ``existing``, compared on all ``columns`` with NULL equal to NULL.

    For feeds without an identifier: the record itself is the key, and fields of a struct compare equal
    when both are NULL.
    """
    record = F.struct(*columns).alias("_record")
    keyed = source.select("*", record)
    return new_rows(keyed, existing.select(record), ["_record"]).select(*source.columns)


def incremental_new_rows(
    source: DataFrame, curated: DataFrame, ctx: RunContext, columns: Sequence[str], unique_key: bool
) -> DataFrame:
    """What an incremental run adds to a curated table from the source table of the same feed.

    The run's day is cut out of both by their partition columns.  One anti-join covers the three cases:
    the late look at yesterday, the first load of today (nothing curated yet) and the later polls of
    today.
    """
    day = day_slice(source, ctx.slice_day)
    known = day_slice(curated, ctx.slice_day)
    return new_rows(day, known, columns) if unique_key else new_records(day, known, columns)
