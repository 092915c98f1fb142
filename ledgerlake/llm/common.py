"""What the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.sinks.stage import Stage

BATCH_ROWS = 512
_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"

_STAGES: dict[tuple[str, str], Stage] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would, and size Arrow batches."""
    context = spark.sparkContext
    if getattr(context, "_ledgerlake_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    if package.is_dir():
        archive = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-code-"), "ledgerlake.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(archive)
    # Rows are whole texts: small batches keep a Python worker's memory small.  A setting of the user's own stays.
    if spark.conf.get(_BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, BATCH_ROWS)
    context._ledgerlake_shipped = True


def staging(spark: SparkSession, name: str) -> Stage:
    """Staged tables of one named job.  A job's older staged tables go when it is started again."""
    key = (spark.sparkContext.applicationId, name)
    if key in _STAGES:
        _STAGES[key].close()
    _STAGES[key] = Stage(spark)
    return _STAGES[key]


def whole_text(column: str = "text") -> Column:
    """The text, a NULL counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def documents(docs: DataFrame) -> DataFrame:
    """Only the two columns the operators read, so that extra columns of any name do no harm."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


_SPARE = 1.2  # so many times the rows asked for are kept, as the number of keys is an estimate within one per cent


def lowest_hashes(df: DataFrame, key: str, rows: int) -> DataFrame:
    """A little more than ``rows`` keys with all their rows, those with the lowest hashes; all if there are fewer.

    What follows, such as an ordered limit, then meets a bounded number of keys from the whole table and not ``rows``
    of every partition.
    """
    keys = df.agg(F.approx_count_distinct(key, 0.01)).first()[0]
    if keys <= _SPARE * rows:
        return df
    return df.where(F.xxhash64(key) < F.lit(int(_SPARE * rows / keys * 2**64) - 2**63))


ROW = "_row_number"
_ROW_BITS = 40  # for the place in a file; the rest of the positive numbers is for 8 million files


def numbered(docs: DataFrame, stage: Stage) -> DataFrame:
    """``docs`` with a number ``ROW`` for every row that is the same in each job that reads it.

    ``monotonically_increasing_id`` depends on how files are split, and Spark splits them anew in every job by the
    cores at hand.  Rows of a file scan are numbered by file and place in the file; only the numbers of the files
    are staged.  Rows of any other plan are staged whole with their numbers.
    """
    plan = getattr(docs, "_jdf", None)
    if plan is not None and docs.inputFiles() and plan.queryExecution().analyzed().children().isEmpty():
        place = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
        files = place.select("_file").distinct()
        # One row per file in one task, as in the driver's own list of files.
        order = F.row_number().over(Window.orderBy("_file")) - 1
        files = stage.keep(files.select("_file", order.cast("long").alias("_number")), "files")
        number = F.shiftleft(F.col("_number"), _ROW_BITS).bitwiseOR(F.col("_place")).alias(ROW)
        return place.join(F.broadcast(files), "_file").select(number, *docs.columns)
    return stage.keep(docs.select(F.monotonically_increasing_id().alias(ROW), *docs.columns), "numbered")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
