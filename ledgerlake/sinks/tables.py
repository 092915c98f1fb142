"""Catalog tables: definitions, partition registration, appends.

Spark's session catalog has no key constraints on Parquet tables; ``operators.audit`` checks keys instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlake.schemas import DAY_PARTS
from ledgerlake.sinks.partitions import day_folder


def table_ddl(name: str, schema: StructType, parts: Sequence[str] = (), location: str | None = None) -> str:
    """CREATE TABLE text of a contract; with a location the table is external."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    text = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if parts:
        text += f" PARTITIONED BY ({', '.join(parts)})"
    if location:
        text += f" LOCATION '{location}'"
    return text


def create_table(
    spark: SparkSession, name: str, schema: StructType, parts: Sequence[str] = (), location: str | None = None
) -> None:
    spark.sql(table_ddl(name, schema, parts, location))


def register_partitions(spark: SparkSession, name: str) -> None:
    """Register every partition folder that exists under the table; safe to repeat."""
    spark.catalog.recoverPartitions(name)


def swap_day_partition(spark: SparkSession, name: str, path: str, day: date) -> None:
    """Drop and re-add one day, so that the catalog sees the folder as it is now.

    Costs one folder, not a listing of the whole table.  Dropping a partition of an external table keeps
    its files: replace the files first.
    """
    values = dict(zip(DAY_PARTS, (day.year, day.month, day.day)))
    spec = ", ".join(f"{k}={v}" for k, v in values.items())
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    spark.sql(f"ALTER TABLE {name} ADD PARTITION ({spec}) LOCATION '{day_folder(path, day)}'")
    spark.catalog.refreshTable(name)


def append_rows(df: DataFrame, name: str, parts: Sequence[str] = (), location: str | None = None) -> None:
    """Append to a table, creating it on first use; columns are matched by name."""
    writer = df.write.format("parquet").mode("append")
    if parts:
        writer = writer.partitionBy(*parts)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
