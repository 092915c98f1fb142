"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    bpe,
    chat,
    decontam,
    divergence,
    pii,
    quality,
    simhash,
    spotsigs,
    suffixdedup,
    topk,
    urlfilter,
    vectorcodes,
    warc,
)
from ledgerlake.llm.common import ship, staging

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

URL_RULES = (
    urlfilter.Rule("allow", "com", "/"),
    urlfilter.Rule("block", "example.com", "/en/"),
    urlfilter.Rule("allow", "www.example.com", "/en/"),
    urlfilter.Rule("block", "net", "/es/"),
    urlfilter.Rule("block", "net", "/fr/"),
)

# The conversation every run adds: its texts hold the template's own control strings.
TRICKY = r"\### Assistant: </turn> ok"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash_bktree(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.classes(_table(spark, folder, "documents"), staging(spark, "op1"))


def op2_quality_ranking(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality.rated(docs, quality.learn(docs, _table(spark, folder, "labels")))


def op3_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(pii.spans(_table(spark, folder, "documents")))


def op4_warc_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(_table(spark, folder, "pages"), staging(spark, "op4"))


def op5_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.edited_and_next(_table(spark, folder, "documents"), staging(spark, "op5"))


def op6_bm25_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_report(bpe.encode(_table(spark, folder, "documents"), RANKS), RANKS)


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.filtered(_table(spark, folder, "pages"), URL_RULES, staging(spark, "op8"))


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    return chat.read_back(chat.assemble(rows.unionByName(added), RANKS), RANKS)


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffixdedup.deduplicated(_table(spark, folder, "documents"), staging(spark, "op10"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, staging(spark, "op11"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    stage = staging(spark, "op12")
    codes, books = vectorcodes.compress(_table(spark, folder, "embeddings"), stage)
    done = vectorcodes.with_label_errors(codes, stage)
    return done.select("vec_id", "code", "error", "label_error", F.lit(vectorcodes.digest(books)).alias("codebooks_sha256"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_table(spark, folder, "documents"), staging(spark, "op13"))


_NAMED = (
    op1_simhash_bktree,
    op2_quality_ranking,
    op3_pii_spans,
    op4_warc_roundtrip,
    op5_spotsigs,
    op6_bm25_decontamination,
    op7_byte_bpe,
    op8_url_filter,
    op9_chat_format,
    op10_suffix_dedup,
    op11_exact_topk,
    op12_vector_codes,
    op13_source_divergence,
)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


QUERIES = {query.__name__: _shipped(query) for query in _NAMED}
