"""Intermediate results that later stages read more than once.

They are written as Parquet tables in the folder the cluster shares (``spark.checkpoint.dir``), so that a
lost executor costs a re-read and not a recomputation, and so that every reader sees the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.sinks.files import delete_tree


_LOCAL: list[str] = []
_WATCHERS: list[list["Stage"]] = []


def use_local_folder(folder: str) -> None:
    """Where a local session without ``spark.checkpoint.dir`` stages; on a cluster it is not used."""
    _LOCAL[:] = [folder.rstrip("/")]


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if _LOCAL and spark.sparkContext.master.startswith("local["):
        return _LOCAL[0]
    raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")


@contextmanager
def created_stages() -> Iterator[list["Stage"]]:
    """Collects the stages that are made inside, so that their owner can close them later."""
    made: list[Stage] = []
    _WATCHERS.append(made)
    try:
        yield made
    finally:
        _WATCHERS.remove(made)


class Stage:
    """A folder of staged tables, owned by one load; ``with`` removes it at the end."""

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark = spark
        self.folder = f"{folder or shared_folder(spark)}/ledgerlake-{uuid.uuid4().hex}"
        self._endings: list[Callable[[], object]] = []
        for made in _WATCHERS:
            made.append(self)

    def at_end(self, ending: Callable[[], object]) -> None:
        """Something else to undo when the stage is closed, such as a catalog table over its files."""
        self._endings.append(ending)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return a scan of what was written."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        while self._endings:
            self._endings.pop()()
        delete_tree(self.spark, self.folder)

    def __enter__(self) -> "Stage":
        return self

    def __exit__(self, *exc: object) -> None:
        self.close()
