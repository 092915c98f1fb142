"""The fact table and its monthly measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions.dates import parts_date
from ledgerlake.functions.money import money
from ledgerlake.operators.keys import dense_key
from ledgerlake.operators.skew import fits, join_unique
from ledgerlake.sinks.stage import Stage



def calendar_of(days: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The calendar, to be broadcast: whole, or if one junk year has stretched it, the days that occur."""
    occurring = days if fits(days) else days.join(rows.select(key).distinct(), key, "left_semi")
    # One row per day that occurs in the rows.
    return F.broadcast(occurring)


def star_rows(
    trans_dim: DataFrame, user_dim: DataFrame, analytics_dim: DataFrame, date_dim: DataFrame, per_user: DataFrame
) -> DataFrame:
    """Transactions whose user, events and day are all known, with the keys of each dimension.

    The two user-sized dimensions are joined to each other first, on narrow rows, so the transactions are
    shuffled once; ``per_user`` holds the number of these transactions per user in ``rows``.
    """
    users = user_dim.select("user_id", "user_id_pk").join(
        analytics_dim.select("user_id", "analytics_id_pk"), "user_id"
    )
    trans = trans_dim.select(
        "trans_id_pk", "transaction_id", "user_id", money().alias("amount"), parts_date().alias("trans_date")
    )
    days = calendar_of(date_dim.select("trans_date", "date_id_pk", "trans_year", "trans_month"), trans, "trans_date")
    known = join_unique(
        trans,
        users,
        ["user_id"],
        "inner",
        per_user.where(F.col("user_id").isNotNull()).select("user_id", "rows"),
        F.col("trans_id_pk"),
    )
    return known.join(days, "trans_date")


def gmv_per_month(rows: DataFrame) -> DataFrame:
    """Sum and average amount per month; partial sums leave each task as one row per month."""
    total, count = F.sum("amount").cast("double"), F.count("amount")
    return rows.groupBy("trans_year", "trans_month").agg(
        total.alias("gmv_per_month"), F.try_divide(total, count).alias("avgtranspermonth")
    )


def number_fact(rows: DataFrame, stage: Stage, start: int = 0) -> DataFrame:
    """Star rows as stored fact rows, keyed in transaction order."""
    narrow = rows.select(
        "transaction_id",
        F.col("trans_id_pk").alias("trans_id_fk"),
        F.col("user_id_pk").alias("user_id_fk"),
        F.col("analytics_id_pk").alias("analytics_id_fk"),
        F.col("date_id_pk").alias("date_id_fk"),
        "amount",
        "trans_year",
        "trans_month",
    )
    keyed = dense_key(narrow, ["transaction_id", "trans_id_fk"], "profile_id_pk", stage, start)
    return keyed.select(*schemas.names(schemas.FACT_STORE))


def profile_fact(stored: DataFrame, gmv: DataFrame) -> DataFrame:
    """The fact contract: stored rows with the measures of their month.

    The monthly table has one row per calendar month of four-digit years, at most 120,000.
    """
    return stored.join(F.broadcast(gmv), ["trans_year", "trans_month"], "left").select(
        *schemas.names(schemas.PROFILE_FACT)
    )
