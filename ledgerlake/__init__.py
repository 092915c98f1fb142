"""ledgerlake: batch analytics for ledger data on Spark.

Three JSON feeds (users, transactions, app events) are landed by day, curated, and modelled as a star
schema.  Every operator takes DataFrames and returns a DataFrame; only ``sources``, ``sinks`` and ``plans``
touch storage.
"""

from ledgerlake.context import FULL_LOAD, INCREMENTAL_LOAD, RunContext

__all__ = ["FULL_LOAD", "INCREMENTAL_LOAD", "RunContext"]
