from __future__ import annotations

import pytest

from ledgerlake.llm.common import ship

EXTRA = "lang string, score double, fp long, ids string, spans string, row long, record long"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def make_docs(spark, tmp_path):
    """A stored documents table from (doc_id, text), with extra columns whose names the operators use inside."""

    def make(rows, files: int = 3):
        wide = [(i, t, "en", 0.5, 1, "x", "y", 2, 3) for i, t in rows]
        path = str(tmp_path / "documents.parquet")
        frame = spark.createDataFrame(wide, f"doc_id long, text string, {EXTRA}")
        frame.repartition(files).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture
def other_splits(spark, stage, monkeypatch):
    """After each staged table files are split otherwise, as when executors come or go."""
    name, keep = "spark.sql.files.openCostInBytes", stage.keep
    before = spark.conf.get(name)

    def kept(frame, table):
        done = keep(frame, table)
        kept.n += 1
        spark.conf.set(name, str(1 << 27) if kept.n % 2 else "1")
        return done

    kept.n = 0
    monkeypatch.setattr(stage, "keep", kept)
    yield stage
    spark.conf.set(name, before)
