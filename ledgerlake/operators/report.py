"""The star report: the fact joined to its four dimensions on surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.fact import calendar_of
from ledgerlake.operators.skew import join_unique, key_counts, row_id

REPORT_COLUMNS = [
    "user_id", "rating", "signup_since_days", "gmv_per_month", "avgtranspermonth", "trans_date", "trans_year",
    "trans_month", "trans_quarter", "trans_weekday", "trans_dayname", "trans_dayofmonth", "amount",
    "debit_count", "credit_count", "total_trans_count", "debitamount_inmillion", "creditamount_inmillion",
    "totaltransamount_inmillion", "category", "mobile_brand_name", "city", "appversion",
]

_USER_KEYS = ["user_id_fk", "analytics_id_fk"]


def _user_rows(user_dim: DataFrame, analytics_dim: DataFrame, profile: DataFrame) -> DataFrame:
    """What the report says about a user, one row per user with events.

    User, profile and latest event are of the same grain, so they are joined to each other and not one by one
    to the fact.
    """
    users = user_dim.select(F.col("user_id_pk").alias("user_id_fk"), "user_id", "rating", "signup_since_days")
    events = analytics_dim.select(
        F.col("analytics_id_pk").alias("analytics_id_fk"), "user_id", "category", "mobile_brand_name", "city", "appversion"
    )
    return users.join(events, "user_id").join(profile.drop("trans_rows"), "user_id", "left")


def _amounts(trans_dim: DataFrame) -> DataFrame:
    return trans_dim.select(F.col("trans_id_pk").alias("trans_id_fk"), "amount")


def _days(date_dim: DataFrame) -> DataFrame:
    return date_dim.select(
        F.col("date_id_pk").alias("date_id_fk"), "trans_date", "trans_year", "trans_month", "trans_quarter",
        "trans_weekday", "trans_dayname", "trans_dayofmonth",
    )


def star_report(
    fact: DataFrame,
    user_dim: DataFrame,
    trans_dim: DataFrame,
    date_dim: DataFrame,
    analytics_dim: DataFrame,
    profile: DataFrame,
) -> DataFrame:
    """The fact with its dimensions and measures.

    ``trans_dim`` is the transaction dimension as stored or wide: two columns of it are read.  Where nothing
    is small enough to be broadcast, the fact is shuffled by user and by transaction, the transactions once.
    """
    users = _user_rows(user_dim, analytics_dim, profile)
    per_user = key_counts(fact, _USER_KEYS)
    rows = fact.join(calendar_of(_days(date_dim), fact, "date_id_fk"), "date_id_fk")
    rows = join_unique(rows, users, _USER_KEYS, "inner", per_user, F.col("profile_id_pk"))
    return rows.join(_amounts(trans_dim), "trans_id_fk").select("profile_id_pk", *REPORT_COLUMNS)


def star_report_top(
    fact: DataFrame,
    user_dim: DataFrame,
    trans_dim: DataFrame,
    date_dim: DataFrame,
    analytics_dim: DataFrame,
    profile: DataFrame,
    rows: int = 20,
) -> DataFrame:
    """The first ``rows`` rows of the report by fact key.

    Which rows those are is found on keys alone; only then are the wide columns brought to these few rows.
    """
    keys = fact.select("profile_id_pk", "trans_id_fk", "date_id_fk", *_USER_KEYS)
    known = user_dim.select(F.col("user_id_pk").alias("user_id_fk"), "user_id").join(
        analytics_dim.select(F.col("analytics_id_pk").alias("analytics_id_fk"), "user_id"), "user_id"
    )
    days = calendar_of(_days(date_dim).select("date_id_fk"), keys, "date_id_fk")
    there = keys.join(days, "date_id_fk", "left_semi")
    there = join_unique(there, known.select(*_USER_KEYS), _USER_KEYS, "inner", key_counts(keys, _USER_KEYS), row_id())
    there = there.join(_amounts(trans_dim).select("trans_id_fk"), "trans_id_fk", "left_semi")
    first = F.broadcast(there.orderBy("profile_id_pk").limit(rows))
    wide = fact.join(first.select("profile_id_pk"), "profile_id_pk", "left_semi")
    users = _user_rows(user_dim, analytics_dim, profile).join(first.select(*_USER_KEYS).distinct(), _USER_KEYS, "left_semi")
    amounts = _amounts(trans_dim).join(first.select("trans_id_fk"), "trans_id_fk", "left_semi")
    # Each side is cut down to the first rows, so all of this is small.
    joined = (
        wide.join(F.broadcast(users), _USER_KEYS)
        .join(F.broadcast(amounts), "trans_id_fk")
        .join(F.broadcast(_days(date_dim).join(first.select("date_id_fk").distinct(), "date_id_fk", "left_semi")), "date_id_fk")
    )
    return joined.orderBy("profile_id_pk").limit(rows).select("profile_id_pk", *REPORT_COLUMNS)
