"""Compaction: the small files of a table packed into files of about one size, rows unchanged.

What goes where is decided from the file listing alone. The files of each partition folder are packed into bins of at
most ``target`` bytes (first fit, largest first); a file beyond that is cut into pieces by the places of its rows. Each
bin is one task and one file, so no task holds more than about ``target`` bytes of input, however uneven the folders,
and the number of files is known before any row is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.operators.skew import BROADCAST_BYTES
from ledgerlake.schemas import order_within

TARGET_BYTES = 256 << 20

_FILE, _PLACE, _BIN, _PIECES = "_file", "_place", "_bin", "_pieces"
# Bytes that a file's name and numbers take in the plan at most, about.
_PLAN_ROW = 400


@dataclass(frozen=True)
class File:
    path: str
    folder: str
    bytes: int


@dataclass(frozen=True)
class Place:
    """Where a file goes: into bin ``first``, or row by row in turn into ``pieces`` bins from there on."""

    file: str
    first: int
    pieces: int


def table_files(spark: SparkSession, path: str) -> list[File]:
    """The data files below ``path`` with their sizes; contents are not read.

    The driver holds the listing, as it does for every scan.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    # Named as a scan names them, which escapes some characters.
    rows = listed.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).collect()
    return sorted((File(r["path"], r["path"].rsplit("/", 1)[0], r["bytes"]) for r in rows), key=lambda f: f.path)


def pack(files: Sequence[File], target: int) -> tuple[list[Place], int]:
    """Bins of at most ``target`` bytes, none of which mixes folders, and their number."""
    places: list[Place] = []
    bins = 0
    by_folder: dict[str, list[File]] = {}
    for file in files:
        by_folder.setdefault(file.folder, []).append(file)
    for folder in sorted(by_folder):
        room: list[tuple[int, int]] = []  # (bytes left, bin), of the bins of this folder
        for file in sorted(by_folder[folder], key=lambda f: (-f.bytes, f.path)):
            if file.bytes > target:
                pieces = -(-file.bytes // target)
                places.append(Place(file.path, bins, pieces))
                bins += pieces
                continue
            fit = next((i for i, (left, _) in enumerate(room) if left >= file.bytes), None)
            if fit is None:
                room.append((target, bins))
                fit = len(room) - 1
                bins += 1
            left, at = room[fit]
            places.append(Place(file.path, at, 1))
            room[fit] = (left - file.bytes, at)
    return places, bins


def is_worth_it(files: Sequence[File], target: int) -> bool:
    """Whether packing makes fewer files."""
    return pack(files, target)[1] < len(files)


def packed(spark: SparkSession, path: str, schema: StructType, parts: Sequence[str], target: int = TARGET_BYTES) -> tuple[DataFrame, int]:
    """The rows of the table at ``path``, dealt to one partition per bin, and the number of bins."""
    places, bins = pack(table_files(spark, path), target)
    rows = spark.read.schema(schema).parquet(path)
    rows = rows.select(*[f.name for f in schema.fields], F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_PLACE))
    plan = spark.createDataFrame([(p.file, p.first, p.pieces) for p in places], f"{_FILE} string, {_BIN} int, {_PIECES} int")
    if len(places) * _PLAN_ROW <= BROADCAST_BYTES:
        plan = F.broadcast(plan)
    # A file of many pieces deals its rows in turn: each piece keeps the file's order and the whole range of days.
    at = (F.col(_BIN) + F.col(_PLACE) % F.col(_PIECES)).cast("int")
    dealt = rows.join(plan, _FILE).withColumn(_BIN, at).repartitionById(max(bins, 1), _BIN)
    order = [*parts, *order_within(tuple(parts))]
    dealt = dealt.sortWithinPartitions(*order) if order else dealt
    return dealt.select(*[f.name for f in schema.fields]), bins


def write_packed(spark: SparkSession, path: str, to: str, schema: StructType, parts: Sequence[str], target: int = TARGET_BYTES) -> tuple[int, int]:
    """Write the table at ``path`` to the new folder ``to`` in packed files; returns (rows, files)."""
    rows, bins = packed(spark, path, schema, parts, target)
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").option("compression", "snappy")
    (writer.partitionBy(*parts) if parts else writer).parquet(to)
    return seen.get["rows"], bins
