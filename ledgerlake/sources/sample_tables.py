"""The three feeds, projected from the shared orders / customer / events tables.

Only projections: every row of a shared table becomes one row of a feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


def _seconds(column: str) -> Column:
    """A timestamp as text to the second, without going through a time zone."""
    return F.substring(_text(F.col(column)), 1, 19)


def _iso(column: str) -> Column:
    text = _text(F.col(column))
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))


def _compact_day(column: str) -> Column:
    text = _text(F.col(column))
    return F.concat(F.substring(text, 1, 4), F.substring(text, 6, 2), F.substring(text, 9, 2))


def _numbered(prefix: str, n: int, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), _text(F.col("user_id") % n), F.lit(suffix))


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return _table(spark, folder, "orders").select(
        _text(F.col("o_orderkey")).alias("transaction_id"),
        _text(F.col("o_custkey")).alias("user_id"),
        _text(F.col("o_custkey") % 25).alias("business_id"),
        _text(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"),
        F.when(status == "O", "debit").when(status == "F", "credit").otherwise("other").alias("transaction_type"),
        F.col("o_orderpriority").alias("type"),
        _iso("o_orderdate").alias("created_at"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    signup = F.date_add(F.lit("1995-01-01").cast("date"), (key % 2000).cast("int"))
    return _table(spark, folder, "customer").select(
        _text(key).alias("user_id"),
        _text(key % 25).alias("business_id"),
        F.when(F.col("c_acctbal") >= 0, _text(key % 6)).alias("rating"),
        F.concat(_text(signup), F.lit("T00:00:00")).alias("created_at"),
    )


def user_sightings(spark: SparkSession, folder: str) -> DataFrame:
    """A users feed with repeats: the user is sent once at sign-up and again with every order."""
    key = F.col("o_custkey")
    again = _table(spark, folder, "orders").select(
        _text(key).alias("user_id"),
        _text(key % 25).alias("business_id"),
        F.col("o_orderpriority").alias("rating"),
        _iso("o_orderdate").alias("created_at"),
    )
    return users(spark, folder).unionByName(again)


def nested_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events in the shape of the analytics feed, plus ``event_ts`` and ``event_id`` as a finer clock."""
    events = _table(spark, folder, "events")
    k = F.get_json_object("props", "$.k")
    params = F.array(F.struct(F.lit("k").alias("key"), F.create_map(F.lit("int_value"), k).alias("value")))
    device = {
        "category": F.col("event_type"),
        "mobile_brand_name": _numbered("brand_", 5),
        "mobile_model_name": _numbered("model_", 3),
        "mobile_os_hardware_model": _numbered("hw", 4, ",1"),
        "operating_system": F.when(F.col("user_id") % 2 == 0, "ANDROID").otherwise("IOS"),
        "operating_system_version": _text(F.col("user_id") % 10),
    }
    geo = {"city": _numbered("city_", 7), "country": _numbered("country_", 3)}
    values = {
        "event_date": _compact_day("ts"),
        "event_timestamp": _seconds("ts"),
        "event_name": F.col("event_type"),
        "event_params": params,
        "user_id": _text(F.col("user_id")),
        "device": _struct(schemas.names(schemas.DEVICE), device),
        "geo": _struct(schemas.names(schemas.GEO), geo),
        "app_info": _struct(schemas.names(schemas.APP_INFO), {"version": k}),
    }
    columns = [
        values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.ANALYTICS_FEED.fields
    ]
    return events.select(*columns, F.col("ts").alias("event_ts"), "event_id")


def _struct(names: list[str], values: dict[str, Column]) -> Column:
    return F.struct(*[values.get(n, F.lit(None)).cast("string").alias(n) for n in names])
