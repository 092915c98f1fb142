"""Checks in place of declared constraints, and row counts of the layers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import parts_date
from ledgerlake.operators.skew import key_counts


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_keys(table: DataFrame, key: str, check: str) -> DataFrame:
    """How many values of ``key`` occur more than once."""
    repeated = key_counts(table, [key]).where(F.col("rows") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(check).alias("check_name"), "violations")


def orphan_rows(table: DataFrame, key: str, parent: DataFrame, parent_key: str, check: str) -> DataFrame:
    """How many rows of ``table`` point to a key that ``parent`` lacks.

    Rows are counted per key before the join, so a key with many rows is one row in it.
    """
    known = parent.select(F.col(parent_key).alias("_known")).distinct()
    lost = key_counts(table, [key]).join(known, F.col(key) == F.col("_known"), "left_anti")
    count = F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")
    return lost.agg(count).select(F.lit(check).alias("check_name"), "violations")


def undated_rows(table: DataFrame, check: str) -> DataFrame:
    """How many rows have no calendar day."""
    count = F.count(F.when(parts_date().isNull(), 1)).alias("violations")
    return table.agg(count).select(F.lit(check).alias("check_name"), "violations")


def key_audit(
    fact: DataFrame, user_dim: DataFrame, trans_dim: DataFrame, analytics_dim: DataFrame, date_dim: DataFrame
) -> DataFrame:
    """One row per check: repeated surrogate and natural keys, fact rows without a dimension row, and the
    transactions that the fact leaves out because their user, their user's events or their day are unknown."""
    dims = {
        "user": (user_dim, "user_id_pk", "user_id_fk"),
        "trans": (trans_dim, "trans_id_pk", "trans_id_fk"),
        "analytics": (analytics_dim, "analytics_id_pk", "analytics_id_fk"),
        "date": (date_dim, "date_id_pk", "date_id_fk"),
    }
    checks = [duplicate_keys(fact, "profile_id_pk", "profile_fact repeated keys")]
    for name, (dim, pk, fk) in dims.items():
        checks.append(duplicate_keys(dim, pk, f"{name}_dim repeated keys"))
        checks.append(orphan_rows(fact, fk, dim, pk, f"profile_fact rows without {name}_dim"))
    for dim, key, check in (
        (user_dim, "user_id", "user_dim repeated users"),
        (trans_dim, "transaction_id", "trans_dim repeated transactions"),
        (analytics_dim, "user_id", "analytics_dim repeated users"),
    ):
        checks.append(duplicate_keys(dim, key, check))
    checks.append(undated_rows(trans_dim, "transactions without day"))
    checks.append(orphan_rows(trans_dim, "user_id", user_dim, "user_id", "transactions without user"))
    checks.append(orphan_rows(trans_dim, "user_id", analytics_dim, "user_id", "transactions without events"))
    return _union(checks)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )
