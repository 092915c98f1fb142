"""Dense surrogate keys 1..n in a given order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.skew import row_id
from ledgerlake.sinks.stage import Stage

_ROW = "_row"
_POSITION = "_position"
# Fixed value: monotonically_increasing_id keeps the row's place within its partition in the low 33 bits.
_PLACE_BITS = 33


def dense_key(df: DataFrame, order: Sequence[str | Column], name: str, stage: Stage, start: int = 0) -> DataFrame:
    """Add ``name``: start+1, start+2, ... in ``order``, equal to a global row_number.

    1. Range-partition by the whole order and sort inside the partitions, so partition 0 holds the lowest
       rows, and so on.  A row number of the scan closes the order, so neither a hot leading value nor
       many copies of one row end in one partition.
    2. Stage the rows with (partition, place in partition): from here on positions cannot change.
    3. Count rows per partition: one row per shuffle partition.  Running totals over those few rows are
       the offsets, which are broadcast back.

    The last stage of ``df`` runs twice (range sampling, then the shuffle), shuffles before it once: pass a
    stored table or a plan that ends shortly after a shuffle.
    """
    total_order = [*order, _ROW]
    placed = (
        df.withColumn(_ROW, row_id())
        .repartitionByRange(*total_order)
        .sortWithinPartitions(*total_order)
        .drop(_ROW)
        .withColumn(_POSITION, F.monotonically_increasing_id())
    )
    rows = stage.keep(placed, name)

    bucket = F.shiftright(F.col(_POSITION), _PLACE_BITS)
    place = F.col(_POSITION).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    sizes = rows.groupBy(bucket.alias("_bucket")).agg((F.max(place) + 1).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    # At most spark.sql.shuffle.partitions rows of two numbers.
    keyed = rows.withColumn("_bucket", bucket).join(F.broadcast(offsets), "_bucket")
    key = (F.col("_offset") + place + F.lit(start + 1)).cast("bigint")
    return keyed.select(key.alias(name), *df.columns)


def highest_key(table: DataFrame, name: str) -> int:
    """The last key given out; 0 for an empty table."""
    return table.agg(F.max(name).alias("top")).head()["top"] or 0


def extend_keys(
    new: DataFrame, existing: DataFrame, order: Sequence[str | Column], name: str, stage: Stage
) -> DataFrame:
    """Keys for rows that are new to a table: they continue after its last key."""
    return dense_key(new, order, name, stage, start=highest_key(existing, name))
