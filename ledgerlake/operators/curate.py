"""Source layer to curated layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake import schemas
from ledgerlake.context import RunContext
from ledgerlake.functions.dates import parts_date
from ledgerlake.functions.money import in_millions, money
from ledgerlake.operators.skew import join_unique, row_id

# The two transaction types that a profile counts.
DEBIT = "debit"
CREDIT = "credit"


def to_contract(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a contract."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    Spark keeps only the first row per key and task before the shuffle (the row number is limited to 1),
    so a key that fills much of the table sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).where(F.col("_n") == 1).drop("_n")


def dedupe_users(users: DataFrame) -> DataFrame:
    """One row per user: the latest, by a total order over the feed's columns."""
    stamps = [F.col("processed_at").desc()] if "processed_at" in users.columns else []
    order = [F.col("created_at").desc(), *stamps, F.col("business_id"), F.col("rating")]
    return first_per_key(users, ["user_id"], order)


def dedupe_transactions(transactions: DataFrame) -> DataFrame:
    """One row per transaction id: the earliest, by a total order over the feed's columns.

    A later day or poll never changes what an earlier one has brought, so loads of any rhythm agree.
    """
    rest = ["user_id", "business_id", "amount", "transaction_type", "type"]
    order = [F.col("created_at").asc_nulls_last(), *[F.col(c) for c in rest]]
    return first_per_key(transactions, ["transaction_id"], order)


def dedupe_events(events: DataFrame) -> DataFrame:
    """One row per event: feeds without an identifier send exact copies, which count once."""
    return events.dropDuplicates([c for c in events.columns if c != "processed_at"])


def curate_users(users: DataFrame, ctx: RunContext) -> DataFrame:
    """Fill the rating, add the days since sign-up, cast to the contract."""
    shaped = users.withColumns(
        {
            "rating": F.coalesce(F.col("rating"), F.lit("0")),
            "signup_since_days": F.datediff(F.lit(ctx.as_of), parts_date()),
        }
    )
    return to_contract(shaped, schemas.CURATED_USERS)


def curate_analytics(events: DataFrame) -> DataFrame:
    return to_contract(events, schemas.CURATED_ANALYTICS)


def trans_core(transactions: DataFrame) -> DataFrame:
    """Curated transactions without the profile columns; an amount that is not a number becomes NULL."""
    shaped = transactions.withColumns(
        {
            "amount": F.when(money().isNotNull(), F.col("amount")),
            "trans_date": F.concat_ws("-", "cryear", "crmonth", "crday"),
        }
    )
    return to_contract(shaped, schemas.TRANS_CORE)


def amount_rejects() -> Column:
    """Aggregate: transactions whose amount is present but not a number."""
    return F.count(F.when(F.col("amount").isNotNull() & money().isNull(), 1))


# --- profile of a user -----------------------------------------------------------------------------------


def trans_type_counts(transactions: DataFrame) -> DataFrame:
    """Rows and amount per user and transaction type."""
    return transactions.groupBy("user_id", "transaction_type").agg(
        F.count(F.lit(1)).alias("userTotalTransCount"),
        F.count(F.lit(1)).alias("TransTypeCount"),
        F.sum(money()).cast("double").alias("totalAmount"),
    )


def _sums(keys: Sequence[str], transactions: DataFrame) -> DataFrame:
    kind = F.col("transaction_type")
    both = kind.isin(DEBIT, CREDIT)
    # The zero for other types is what turns "no debit" into 0 while "only unreadable debits" stays NULL.
    return (
        transactions.select(*keys, "transaction_type", money().alias("_amount"))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("trans_rows"),
            F.count(F.when(kind == DEBIT, 1)).alias("debit_count"),
            F.count(F.when(kind == CREDIT, 1)).alias("credit_count"),
            F.sum(F.when(kind == DEBIT, F.col("_amount")).otherwise(F.lit(0))).alias("debit_amount"),
            F.sum(F.when(kind == CREDIT, F.col("_amount")).otherwise(F.lit(0))).alias("credit_amount"),
            F.sum(F.when(both, F.col("_amount")).otherwise(F.lit(0))).alias("both_amount"),
        )
    )


def _as_profile(sums: DataFrame) -> DataFrame:
    return sums.select(
        "user_id",
        "trans_rows",
        "debit_count",
        "credit_count",
        (F.col("debit_count") + F.col("credit_count")).alias("total_trans_count"),
        in_millions(F.col("debit_amount")).alias("debitamount_inmillion"),
        in_millions(F.col("credit_amount")).alias("creditamount_inmillion"),
        in_millions(F.col("both_amount")).alias("totaltransamount_inmillion"),
    )


def profile_store(transactions: DataFrame) -> DataFrame:
    """Per-user profile in one pass, with the user's row count in ``trans_rows``."""
    return _as_profile(_sums(["user_id"], transactions))


def trans_profile(transactions: DataFrame) -> DataFrame:
    """Per-user debit and credit counts and amounts in millions."""
    return profile_store(transactions).drop("trans_rows")


def trans_daily(transactions: DataFrame) -> DataFrame:
    """Per-user sums of each day: what a day adds to the profile."""
    return to_contract(_sums(["user_id", *schemas.DAY_PARTS], transactions), schemas.TRANS_DAILY)


def profile_of_daily(daily: DataFrame) -> DataFrame:
    """The lifetime profile out of the daily sums; equal to ``profile_store`` over all transactions."""
    sums = [c for c in schemas.names(schemas.TRANS_DAILY) if c not in ("user_id", *schemas.DAY_PARTS)]
    return _as_profile(daily.groupBy("user_id").agg(*[F.sum(c).alias(c) for c in sums]))


def attach_profile(transactions: DataFrame, profile: DataFrame) -> DataFrame:
    """Left join of the profile; a transaction without a user keeps NULL profile columns.

    ``profile`` is read twice (heavy users, then the join), so pass a stored table; ``transactions`` is a
    table scan.
    """
    counts = profile.where(F.col("user_id").isNotNull()).select("user_id", "trans_rows")
    unique = profile.drop("trans_rows")
    return join_unique(transactions, unique, ["user_id"], "left", counts, row_id(), rows="trans_rows")


def curate_transactions(core: DataFrame, profile: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The curated transaction contract: typed rows with the profile of their user."""
    return attach_profile(core, profile).select(*schemas.names(schemas.CURATED_TRANSACTIONS), *extra)
