"""Newline-delimited JSON feeds, read in parallel with a fixed schema.

A line that is not valid JSON does not fail the read: it becomes a row of NULLs whose text sits in
``_corrupt_record``.  ``good_rows`` and ``bad_lines`` split the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas
from ledgerlake.operators.flatten import flatten_analytics

CORRUPT = "_corrupt_record"

FEEDS = {
    "users": schemas.USERS_FEED,
    "transactions": schemas.TRANSACTIONS_FEED,
    "analytics": schemas.ANALYTICS_FEED,
}

# The part of each feed that is landed.
LANDED = FEEDS | {"analytics": schemas.ANALYTICS_LANDED}

_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def scan_feed(spark: SparkSession, feed: str, path: str, contract: T.StructType | None = None) -> DataFrame:
    """Every line of a feed under its contract, plus ``_corrupt_record``."""
    return spark.read.schema(_with_corrupt(contract or FEEDS[feed])).options(**_PERMISSIVE).json(path)


def stream_feed(
    spark: SparkSession,
    feed: str,
    path: str,
    contract: T.StructType | None = None,
    max_age: str = "7d",
    files_at_once: int | None = None,
) -> DataFrame:
    """The lines of the files that come into a folder, as a stream; all that are there at once unless given."""
    reader = spark.readStream.schema(_with_corrupt(contract or FEEDS[feed])).options(**_PERMISSIVE)
    reader = reader.option("maxFileAge", max_age)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.json(path)


def _with_corrupt(contract: T.StructType) -> T.StructType:
    return T.StructType(contract.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def good_rows(scan: DataFrame) -> DataFrame:
    return scan.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_lines(scan: DataFrame) -> DataFrame:
    """The text of the lines that did not parse, with what could be read of them in ``parsed``.

    Whether a line parses depends on the columns that are read: a wrong type in a column nobody asks for goes
    unseen.  ``parsed`` asks for all of them, as the landing does, so a line is either landed or set aside.
    """
    parsed = F.to_json(F.struct(*[c for c in scan.columns if c != CORRUPT])).alias("parsed")
    return scan.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, parsed)


def bad_line_count() -> Column:
    """Aggregate for ``observe``: counts bad lines while the good ones are being written."""
    return F.count(F.col(CORRUPT))


def users_feed(spark: SparkSession, path: str) -> DataFrame:
    return good_rows(scan_feed(spark, "users", path))


def transactions_feed(spark: SparkSession, path: str) -> DataFrame:
    return good_rows(scan_feed(spark, "transactions", path))


def analytics_feed(spark: SparkSession, path: str) -> DataFrame:
    """Events with their nested device, geo, app and parameter columns."""
    return good_rows(scan_feed(spark, "analytics", path))


def flat_analytics_feed(spark: SparkSession, path: str) -> DataFrame:
    """Events as eleven flat columns; only the nested fields in use are parsed."""
    return flatten_analytics(good_rows(scan_feed(spark, "analytics", path, LANDED["analytics"])))
