"""Joins onto a unique side when one key may hold a large share of the rows.

Hash partitioning sends all rows of a key to one task.  Keys with more than a task's fair share are cut
into pieces: rows on the many side get a piece number each, and the one matching row on the unique side is
repeated once per piece.  Results are the same as those of the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side whose files hold at most this much is broadcast; Parquet grows some four times in memory.
BROADCAST_BYTES = 16 << 20

_PIECES = "_pieces"
_PIECE = "_piece"


def key_counts(df: DataFrame, keys: Sequence[str], rows: str = "rows") -> DataFrame:
    """Rows per key; partial counts are formed before the shuffle, so a hot key costs nothing extra."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows))


def row_id() -> Column:
    """A number that tells the rows of a table scan apart, exact copies included.

    Only for frames that are a scan with filters and projections: there a task that is run again numbers
    its rows the same way.
    """
    return F.monotonically_increasing_id()


def hot_keys(counts: DataFrame, keys: Sequence[str], rows: str = "rows", pieces: int | None = None) -> DataFrame:
    """Keys with more than 1/``pieces`` of all rows, and how many pieces each is cut into.

    ``pieces`` defaults to the number of shuffle partitions.  At most ``pieces`` keys can pass, which is
    what bounds the broadcast of this frame; the pieces of all hot keys together number at most twice
    that.
    """
    if pieces is None:
        pieces = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(rows)).scalar()
    scaled = F.col(rows) * F.lit(pieces)
    return counts.where(scaled > total).select(
        *keys, F.ceil(scaled / total).cast("int").alias(_PIECES)
    )


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files a frame is made of, from the file listing: no job is run.

    For frames that filter, project or aggregate stored tables, or add columns to them by joins that keep
    their rows, this bounds the frame up to compression.  Files are counted whole, whatever columns are
    read.  A source without known size counts as endless.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def fits(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether a frame is small enough to be broadcast."""
    return stored_bytes(df) <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def join_unique(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    counts: DataFrame,
    spread: Column,
    rows: str = "rows",
) -> DataFrame:
    """``left`` joined to ``right``, where ``right`` has at most one row per key.

    A ``right`` of few stored bytes is broadcast: then nothing is shuffled and no key is hot.  Otherwise
    both sides are shuffled by key and piece.  ``counts`` holds the left rows per key in ``rows``; ``spread`` tells the left rows of one key apart: a unique column, or ``row_id()``.  Rows with a NULL
    key match nothing but survive a left or anti join, so they are spread out too.  ``how`` is inner, left
    or left_anti.
    """
    keys = list(keys)
    if fits(right):
        return left.join(F.broadcast(right), keys, how)
    hot = F.broadcast(hot_keys(counts, keys, rows))
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_hash = F.xxhash64(spread)
    no_key: Column = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    piece = (
        F.when(F.col(_PIECES).isNotNull(), F.pmod(row_hash, F.col(_PIECES)))
        .when(no_key, F.pmod(row_hash, F.lit(partitions)))
        .otherwise(F.lit(0))
        .cast("int")
    )
    many = left.join(hot, keys, "left").withColumn(_PIECE, piece).drop(_PIECES)
    copies = F.sequence(F.lit(0), F.coalesce(F.col(_PIECES), F.lit(1)) - 1)
    one = right.join(hot, keys, "left").withColumn(_PIECE, F.explode(copies)).drop(_PIECES)
    return many.join(one, [*keys, _PIECE], how).drop(_PIECE)
