"""Quality ranking: held-out accuracy and edge cases."""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np
import pytest
import xxhash

from ledgerlake.llm import quality

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    rated = quality.rated(docs, quality.learn(docs, labels))
    rows = rated.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in unseen) >= 0.95 * len(unseen)


def test_held_out_labels_are_not_learned(tables):
    docs, labels = tables
    turned = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - labels.quality).otherwise(labels.quality))
    a, b = quality.learn(docs, labels), quality.learn(docs, turned)
    assert np.allclose(a.weights, b.weights) and a.cut == b.cut


def test_odd_texts_and_labels(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "x" * 200_000), (None, "a b"), (4, "fine words here"), (4, "fine words here")])
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn(docs, labels)
    got = quality.rated(docs, model).collect()
    assert len(got) == 6 and all(r.score == 0.5 and r.predicted == 1 for r in got)
    assert quality.kept(docs, model).columns == docs.columns
    assert quality.rated(docs.limit(0), quality.learn(docs.limit(0), labels)).collect() == []


def test_pairs_rank_the_good_above_the_poor():
    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(1, 1, (300, 3)), r.normal(-1, 1, (60, 3))])
    good = np.arange(360) < 300
    model = quality.fit(x, good, pairs=20_000)
    scores = x @ model.weights
    assert (scores[good][:, None] > scores[~good]).mean() > 0.97


def brute_rating(docs: dict[int, str | None], labels: list[tuple], rows: int) -> dict[int, tuple]:
    """The whole operator without Spark: sample, features, fit and score."""
    known: dict[int, int] = {}
    for doc, q in labels:
        if doc is not None and q is not None and zlib.crc32(str(doc).encode()) % 3 != 1:
            known[doc] = min(q, known.get(doc, q))
    signed = lambda h: h - (h >> 63 << 64)
    lowest = sorted(known, key=lambda d: (signed(xxhash.xxh64_intdigest(struct.pack("<q", d), seed=42)), d))[:rows]
    learned = sorted(d for d in lowest if d in docs)
    x = np.array([quality.text_features(docs[d] or "") for d in learned])
    model = quality.fit(x, np.array([known[d] == 1 for d in learned]))
    s = {d: 1 / (1 + math.exp(model.cut - float(quality.text_features(t or "") @ model.weights))) for d, t in docs.items()}
    return {d: (zlib.crc32(str(d).encode()) % 3 == 1, v) for d, v in s.items()}


@pytest.mark.parametrize("rows", [150, 10_000])
def test_against_brute_force(tables, rows):
    """Also with fewer rows to learn from than labels: the ones with the lowest hashes."""
    docs, labels = tables
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    wanted = brute_rating(texts, [(r.doc_id, r.quality) for r in labels.collect()], rows)
    got = {r.doc_id: r for r in quality.rated(docs, quality.learn(docs, labels, rows)).collect()}
    assert got.keys() == wanted.keys()
    for doc, (held, score) in wanted.items():
        assert got[doc].held_out == held and abs(got[doc].score - score) < 1e-6


def test_very_long_and_repeated_texts(spark, make_docs):
    good, poor = "Plain words, as they are said. " * 40_000, "$$ BUY !!! " * 90_000
    rows = [(i, good if i % 2 else poor) for i in range(12)] + [(1, poor[:5000])] * 300
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    model = quality.learn(make_docs(rows), labels)
    got = quality.rated(make_docs(rows), model).collect()
    assert len(got) == len(rows) and len({(r.doc_id, r.score) for r in got}) == 13
