"""Where the tables of a lake are, and how to read them.

``<root>/<layer>/<table>/v0001``: a full load writes a new version folder, an incremental load adds to the
current one.  A version counts once its ``_SUCCESS`` marker is there, so readers never see half a rewrite
and nothing overwrites a folder it is reading.
"""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators.curate import curate_transactions
from ledgerlake.operators.fact import profile_fact
from ledgerlake.operators.sketches import month_filters, words_for
from ledgerlake.plans.together import together
from ledgerlake.sinks.compact import TARGET_BYTES, is_worth_it, table_files, write_packed
from ledgerlake.sinks.files import child_folders, delete_tree, exists
from ledgerlake.sinks.partitions import day_folder, month_folder, rebalance, replace_day, replace_day_in_month, write_partitioned
from ledgerlake.sinks.tables import create_table, drop_tables, register_partitions
from ledgerlake.sources.layers import day_slice, scan_folder, scan_table

DAYS_OF_MONTH = 31


def bucket_of(key: str) -> Column:
    """The bucket of a row; rows without a key have one too."""
    return F.pmod(F.xxhash64(key), F.lit(schemas.BUCKETS)).cast("int")


# Readers that started before a switch may still be on the previous version.
KEPT_VERSIONS = 2


class Lake:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # --- paths -------------------------------------------------------------------------------------------

    def folder(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _taken(self, table: str) -> list[int]:
        """Numbers of all version folders, finished or not, in order."""
        names = child_folders(self.spark, self.folder(table))
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())

    def _version(self, table: str, number: int) -> str:
        return f"{self.folder(table)}/v{number:04d}"

    def _versions(self, table: str) -> list[int]:
        return [n for n in self._taken(table) if exists(self.spark, f"{self._version(table, n)}/_SUCCESS")]

    def path(self, table: str) -> str:
        """Folder of the current version."""
        versions = self._versions(table)
        if not versions:
            raise FileNotFoundError(f"{table} has not been loaded under {self.root}")
        return self._version(table, versions[-1])

    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    # --- reading -----------------------------------------------------------------------------------------

    def stored(self, table: str) -> DataFrame:
        """The table as it is on storage."""
        return scan_table(self.spark, self.path(table), schemas.STORED[table][0])

    def _laid_out(self, table: str, df: DataFrame) -> DataFrame:
        """Rows with the columns of the table's folder."""
        df = df.select(*schemas.names(schemas.STORED[table][0]))
        return df.withColumn(schemas.BUCKET, bucket_of(schemas.BUCKETED[table])) if table in schemas.BUCKETED else df

    def buckets_of(self, table: str, rows: DataFrame) -> list[int]:
        """The buckets of a bucketed table that the keys of ``rows`` fall into: ``schemas.BUCKETS`` at most."""
        found = rows.select(bucket_of(schemas.BUCKETED[table]).alias("b")).distinct().collect()
        return sorted(r["b"] for r in found)

    def in_buckets(self, table: str, buckets: list[int]) -> DataFrame:
        """Some buckets of a bucketed table; their folders alone are read."""
        rows = scan_table(self.spark, self.path(table), schemas.layout(table)[0])
        return rows.where(F.col(schemas.BUCKET).isin(buckets)).drop(schemas.BUCKET)

    def replace_buckets(self, table: str, df: DataFrame) -> int:
        """Make ``df`` the content of the buckets its rows fall into; the others' files stay. Returns the rows written.

        ``df`` must not read what it replaces. The new files are complete before the old ones go.
        """
        seen = Observation()
        (
            rebalance(self._laid_out(table, df), (schemas.BUCKET,))
            .observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite")
            .option("compression", "snappy")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(schemas.BUCKET)
            .parquet(self.path(table))
        )
        return seen.get["rows"]

    def day(self, table: str, day: date) -> DataFrame:
        """One day of a table; of its folders only the one that may hold the day is looked at."""
        schema, parts = schemas.STORED[table]
        path = self.path(table)
        folder = (day_folder if parts == schemas.DAY_PARTS else month_folder)(path, day)
        rows = scan_folder(self.spark, path, folder, schema) if exists(self.spark, folder) else self.stored(table)
        return day_slice(rows, day)

    def _filters_path(self, table: str) -> str:
        return f"{self.path(table)}_keys"

    def filters(self, table: str) -> DataFrame | None:
        """The month filters of a table's keys, or None where the current version has none: then all ids have to be read."""
        path = self._filters_path(table)
        if not exists(self.spark, f"{path}/_SUCCESS"):
            return None
        return scan_table(self.spark, path, schemas.KEY_FILTERS)

    def read(self, table: str) -> DataFrame:
        """The table under its full contract, with the measures of the user or the month joined on."""
        if table == "curated.transactions":
            return curate_transactions(self.stored(table), self.stored("curated.trans_profile"))
        if table == "curated.trans_profile":
            return self.stored(table).drop("trans_rows")
        if table == "consumption.trans_dim":
            wide = curate_transactions(
                self.stored(table), self.stored("curated.trans_profile"), ("trans_id_pk", "isActive")
            )
            return wide.select(*schemas.names(schemas.TRANS_DIM))
        if table in ("consumption.user_dim", "consumption.analytics_dim"):
            return self.stored(table).drop("added_on")
        if table == "consumption.profile_fact":
            return profile_fact(self.stored(table), self.stored("consumption.gmv_per_month"))
        return self.stored(table)

    # --- writing -----------------------------------------------------------------------------------------

    def write_version(self, table: str, df: DataFrame) -> int:
        """Write a new version of the whole table; returns its row count."""
        number = max(self._taken(table), default=0) + 1
        rows = self._write(self._laid_out(table, df), self._version(table, number), schemas.layout(table)[1], "errorifexists")
        self._tidy(table)
        return rows

    def compact(self, table: str, target: int = TARGET_BYTES) -> int:
        """Write the small files of a table together, as a new version; returns the number of files after it.

        Nothing is written when that would not save a file. Readers of the version before are not disturbed. Nothing
        may append to the table meanwhile, as with every rewrite.
        """
        schema, parts = schemas.layout(table)
        path = self.path(table)
        files = table_files(self.spark, path)
        if not is_worth_it(files, target):
            return len(files)
        number = max(self._taken(table)) + 1
        filtered = table in schemas.FILTERED and self.filters(table) is not None
        _, after = write_packed(self.spark, path, self._version(table, number), schema, parts, target)
        if filtered:
            self.write_filters(table)
        self._tidy(table)
        return after

    def _tidy(self, table: str) -> None:
        for old in self._taken(table)[:-KEPT_VERSIONS]:
            delete_tree(self.spark, self._version(table, old))
            delete_tree(self.spark, f"{self._version(table, old)}_keys")

    def write_filters(self, table: str) -> None:
        """Build the month filters of the current version, sized for its largest month."""
        key, rows = schemas.FILTERED[table], self.stored(table)
        largest = rows.groupBy(*schemas.DAY_MONTHS).count().agg(F.max("count").alias("n")).head()["n"]
        filters = month_filters(rows, key, words_for(largest or 0))
        filters.write.mode("overwrite").parquet(self._filters_path(table))

    def append_filters(self, table: str, df: DataFrame) -> None:
        """Add keys to the filters, if the current version has them. To be done before the rows are added: a filter may
        know a key that is not there, but never the other way round."""
        filters = self.filters(table)
        if filters is None:
            return
        head = filters.select("words").head()
        words = head["words"] if head else words_for(df.count() * DAYS_OF_MONTH)
        month_filters(df, schemas.FILTERED[table], words).write.mode("append").parquet(self._filters_path(table))

    def create_missing(self) -> None:
        """Give every table that has not been loaded an empty first version."""
        missing = [t for t in schemas.STORED if not self.exists(t)]

        def create(table: str) -> int:
            return self.write_version(table, self.spark.createDataFrame([], schemas.STORED[table][0]).coalesce(1))

        if missing:
            together(*[partial(create, table) for table in missing])
        for table in set(missing) & set(schemas.FILTERED):
            self.write_filters(table)

    def append(self, table: str, df: DataFrame) -> int:
        """Add rows to the current version."""
        return self._write(self._laid_out(table, df), self.path(table), schemas.layout(table)[1], "append")

    def replace_day(self, table: str, df: DataFrame, day: date) -> int:
        """Make ``df``'s rows of ``day`` the only ones of that day in the current version."""
        schema, parts = schemas.STORED[table]
        df = df.select(*schemas.names(schema))
        if parts == schemas.DAY_PARTS:
            return replace_day(df, self.path(table), day)
        return replace_day_in_month(df, self.stored(table), self.path(table), day)

    @staticmethod
    def _write(df: DataFrame, path: str, parts: tuple[str, ...], mode: str) -> int:
        if parts:
            return write_partitioned(df, path, parts, mode)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
        return seen.get["rows"]

    # --- catalog -----------------------------------------------------------------------------------------

    def sql_name(self, table: str, database: str = "ledger") -> str:
        layer, name = table.split(".")
        return f"{database}_{layer}.{name}"

    def register(self, database: str = "ledger") -> list[str]:
        """Define every loaded table in the session catalog, with the partitions that exist."""
        names = []
        for table in schemas.STORED:
            if not self.exists(table):
                continue
            schema, parts = schemas.layout(table)
            name = self.sql_name(table, database)
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
            # The definition of an external table; its files stay.
            drop_tables(self.spark, [name])
            create_table(self.spark, name, schema, parts, self.path(table))
            if parts:
                register_partitions(self.spark, name)
            names.append(name)
        return names
