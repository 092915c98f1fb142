"""Which months may hold a key: Bloom filters kept beside a table, consulted before its ids are read.

A filter is kept as rows ``cryear, crmonth, word, bits``: a key's hash names one word of 64 bits in its month and
``PROBES`` bits in it, so looking a key up is one equality join on ``word`` and one comparison of bits, whatever the
number of months. Words that several runs added to are several rows; a key that is there has all of its bits in the row
of the run that added it. A filter never misses a key; of keys that are not there it lets through about one in a
thousand per month, at ``BITS_PER_KEY`` bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators.newrows import new_rows, with_key
from ledgerlake.operators.skew import fits

BITS_PER_KEY = 32
PROBES = 5
LEAST_WORDS = 1 << 10

_SALT = 17  # tells the bits' hash from the word's


def words_for(rows: int) -> int:
    """Words of a month's filter for so many keys: a power of two."""
    wanted = max(LEAST_WORDS, -(-rows * BITS_PER_KEY // 64))
    return 1 << (wanted - 1).bit_length()


def _word(key: str, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _bits(key: str) -> Column:
    spread = F.xxhash64(F.col(key), F.lit(_SALT))
    one = F.lit(1).cast("bigint")
    places = [F.shiftrightunsigned(spread, 6 * i).bitwiseAND(63).cast("int") for i in range(PROBES)]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", one, p) for p in places])


def month_filters(rows: DataFrame, key: str, words: int) -> DataFrame:
    """The filters of the keys in ``rows``; bits are joined in the tasks before their shuffle."""
    keyed = with_key(rows, [key])
    return keyed.groupBy(*schemas.DAY_MONTHS, _word(key, words).alias("word")).agg(
        F.bit_or(_bits(key)).alias("bits"), F.lit(words).cast("int").alias("words")
    )


def months_that_may_hold(source: DataFrame, filters: DataFrame, key: str) -> list[tuple[int | None, int | None]]:
    """Months that may hold some key of ``source``: one per calendar month at most."""
    head = filters.select("words").head()
    if head is None:
        return []
    wanted = with_key(source, [key]).select(_word(key, head["words"]).alias("word"), _bits(key).alias("wanted"))
    if fits(source):
        wanted = F.broadcast(wanted)
    hits = filters.join(wanted, "word").where(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    return sorted((r["cryear"], r["crmonth"]) for r in hits.select(*schemas.DAY_MONTHS).distinct().collect())


def of_months(table: DataFrame, months: list[tuple[int | None, int | None]]) -> DataFrame:
    """The months' rows of a table; their folders alone are read."""
    year, month = schemas.DAY_MONTHS
    picked = [F.col(year).eqNullSafe(F.lit(y)) & F.col(month).eqNullSafe(F.lit(m)) for y, m in months]
    return table.where(reduce(lambda a, b: a | b, picked, F.lit(False)))


def new_rows_by_month(source: DataFrame, existing: DataFrame, filters: DataFrame, key: str) -> DataFrame:
    """``new_rows`` on a table with a unique key: ids are read only of months whose filter lets a source key through."""
    months = months_that_may_hold(source, filters, key)
    return new_rows(source, of_months(existing, months), [key], unique=True)
