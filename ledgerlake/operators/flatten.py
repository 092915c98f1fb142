"""Nested app events to flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_analytics(events: DataFrame, *extra: str) -> DataFrame:
    """Eleven flat columns by field access: commas inside a value cannot shift its neighbours, NULL stays
    NULL, and the reader parses only the nested fields named here.  ``extra`` names further columns to keep."""
    return events.select(
        *extra,
        "user_id",
        "event_date",
        F.col("device.category").alias("category"),
        F.col("device.mobile_brand_name").alias("mobile_brand_name"),
        F.col("device.mobile_model_name").alias("mobile_model_name"),
        F.col("device.mobile_os_hardware_model").alias("mobile_os_hardware_model"),
        F.col("device.operating_system").alias("operating_system"),
        F.col("device.operating_system_version").alias("operating_system_version"),
        F.col("geo.city").alias("city"),
        F.col("geo.country").alias("country"),
        F.col("app_info.version").alias("appversion"),
    )
