"""The registered queries of the subpackage on the smallest shared tables, and the pipeline's stages."""

from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from ledgerlake.llm.oracles import ORACLES
from ledgerlake.llm.queries import QUERIES
from tools.compare import connect, rows_by_name

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="shared tables are not here")

COLUMNS = {
    "op1": ["doc_id", "fingerprint", "component_id"],
    "op2": ["doc_id", "held_out", "score", "predicted"],
    "op3": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op4": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op5": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op6": ["doc_id", "item_id"],
    "op7": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8": ["page_id", "host", "path", "rule", "verdict"],
    "op9": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op10": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op11": ["query_id", "rank", "vec_id", "score"],
    "op12": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op13": ["lang", "source", "part", "item", "value", "rank"],
}


def test_one_query_for_each_operator():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    assert rows and df.columns[: len(COLUMNS[name.split("_")[0]])] == COLUMNS[name.split("_")[0]]
    if name in ORACLES:
        result = connect(FOLDER).execute(ORACLES[name])
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows_by_name(df.columns, rows) == rows_by_name(columns, result.fetchall())


def test_pipeline_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_ranking", "simhash_near_dedup", "decontamination", "personal_data", "byte_bpe"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, FOLDER)
        assert docs.columns == columns
        after = docs.count()
        assert after <= before and (name == "personal_data") <= (after == before)
        before = after
    assert corpus_pipeline.run(spark, FOLDER).count() == before
