"""Small files packed into larger ones."""

from __future__ import annotations

from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.plans.lake import Lake
from ledgerlake.sinks import compact

TABLE = "curated.transactions"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(1, 50)), max_size=40), st.integers(5, 60))
def test_bins_hold_no_more_than_the_target(files, target):
    files = [compact.File(f"{folder}/{i}", folder, size) for i, (folder, size) in enumerate(files)]
    places, bins = compact.pack(files, target)
    assert sorted(p.file for p in places) == sorted(f.path for f in files)
    by_path, held, folders = {f.path: f for f in files}, {}, {}
    for p in places:
        for piece in range(p.pieces):
            at = p.first + piece
            held[at] = held.get(at, 0) + by_path[p.file].bytes / p.pieces
            folders.setdefault(at, set()).add(by_path[p.file].folder)
    assert sorted(held) == list(range(bins))
    assert all(size <= target for size in held.values()) and all(len(f) == 1 for f in folders.values())
    # Two bins of a folder that are both half empty would have been one.
    loose = {f: sum(held[at] * 2 <= target for at in held if folders[at] == {f}) for f in "abc"}
    cut = sum(p.pieces for p in places if p.pieces > 1)
    assert all(n <= 1 + cut for n in loose.values())


def _rows(spark, n, month):
    core = {f.name: F.lit(None).cast(f.dataType) for f in schemas.TRANS_CORE.fields}
    core |= {
        "transaction_id": F.concat(F.lit(f"{month}-"), F.col("id").cast("string")), "cryear": F.lit(2024), "crmonth": F.lit(month),
        "crday": (F.col("id") % 28 + 1).cast("int"),
    }
    return spark.range(n).select(*[c.alias(name) for name, c in core.items()])


def _files(path):
    return sorted(Path(path).rglob("*.parquet"))


@pytest.fixture
def lake(spark, tmp_path):
    """A table of many small files: six appends over two months."""
    lake = Lake(spark, str(tmp_path / "lake 100% +"))
    lake.write_version(TABLE, _rows(spark, 0, 1))
    for i in range(6):
        lake.append(TABLE, _rows(spark, 50 + i, 1 + i % 2))
    return lake


def test_one_file_per_month_and_the_same_rows(spark, lake, values):
    old_path = lake.path(TABLE)
    old = lake.stored(TABLE)
    before = values(old, *old.columns)
    assert len([f for f in _files(old_path) if "crmonth" in str(f)]) == 6
    assert lake.compact(TABLE) == len(_files(lake.path(TABLE)))
    assert lake.path(TABLE) != old_path
    new = lake.stored(TABLE)
    assert values(new, *new.columns) == before
    assert [len([f for f in _files(lake.path(TABLE)) if f"crmonth={m}/" in str(f)]) for m in (1, 2)] == [1, 1]
    # A reader that holds the version before goes on.
    assert values(old, *old.columns) == before
    # Rows of a file lie by day, and a packed table is left alone.
    for file in _files(lake.path(TABLE)):
        days = [r.crday for r in spark.read.parquet(str(file)).select("crday").collect()]
        assert days == sorted(days)
    path = lake.path(TABLE)
    assert lake.compact(TABLE) == len(_files(path)) and lake.path(TABLE) == path
    # What comes later is added to the new version.
    lake.append(TABLE, _rows(spark, 3, 2))
    assert lake.stored(TABLE).count() == len(before) + 3


def test_a_large_file_is_cut(spark, tmp_path, values):
    path, to = str(tmp_path / "one"), str(tmp_path / "many")
    _rows(spark, 20_000, 1).coalesce(1).write.partitionBy(*schemas.DAY_MONTHS).parquet(path)
    size = compact.table_files(spark, path)[0].bytes
    rows, files = compact.write_packed(spark, path, to, schemas.TRANS_CORE, schemas.DAY_MONTHS, target=size // 3)
    assert rows == 20_000 and files == 4 == len(_files(to))
    counts = [spark.read.parquet(str(f)).count() for f in _files(to)]
    assert max(counts) - min(counts) <= 1
    read = lambda p: values(spark.read.parquet(p), "transaction_id", "crday", "crmonth")
    assert read(to) == read(path)


def test_nothing_to_pack(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.create_missing()
    path = lake.path("consumption.gmv_per_month")
    assert lake.compact("consumption.gmv_per_month") == len(_files(path)) and lake.path("consumption.gmv_per_month") == path
