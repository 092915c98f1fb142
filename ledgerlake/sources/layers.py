"""Scans of stored tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlake.functions.dates import on_day


def scan_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A whole table under its contract; columns come back in contract order."""
    return spark.read.schema(schema).parquet(path).select(*[f.name for f in schema.fields])


def scan_folder(spark: SparkSession, path: str, folder: str, schema: StructType) -> DataFrame:
    """One partition folder of the table at ``path``: no other folder is listed."""
    rows = spark.read.schema(schema).option("basePath", path).parquet(folder)
    return rows.select(*[f.name for f in schema.fields])


def day_slice(table: DataFrame, day: date) -> DataFrame:
    """One day of a table; prunes to the day's folder, or to its month's and there to the row groups that hold the day."""
    return table.where(on_day(day))
