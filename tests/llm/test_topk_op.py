from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score double, rank int, vec array<string>, ids string, best int"
EXTRA = (0.5, 1, ["x"], "y", 2)


def brute(rows, k, every, scale=64):
    """Every row against every other one."""
    kept = [
        (i, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, v) in enumerate(kept):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, (j, w) in enumerate(kept) if m != n)
        out += [(i, rank, j, -down) for rank, (down, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def search(spark, stage, rows, k=20, every=20, **options):
    table = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(5)
    found = topk.top(table, F.col("vec_id") % every == 0, stage, k=k, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def vectors(n, dims, seed, clusters=6):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, dims))
    out = centres[r.integers(0, clusters, n)] + r.normal(scale=0.7, size=(n, dims))
    return [[float(x) for x in v / np.linalg.norm(v)] for v in out]


@pytest.mark.parametrize("dims", [1, 7, 16, 64, 70])
def test_same_as_brute_force(spark, stage, dims):
    rows = list(enumerate(vectors(300, dims, dims)))
    assert search(spark, stage, rows, k=5, every=7) == brute(rows, 5, 7)


def test_small_blocks_and_many_tasks_give_the_same(spark, stage, monkeypatch):
    rows = list(enumerate(vectors(700, 48, 1)))
    # Parameters reach the tasks by what the driver plans; block sizes there are the module's own.
    monkeypatch.setattr(topk, "QUERY_BLOCK", 10)
    monkeypatch.setattr(topk, "RANGE_LEAST", 40)
    assert search(spark, stage, rows, k=4, every=5) == brute(rows, 4, 5)


def test_blocks_drop_what_cannot_reach(monkeypatch):
    """The bounds work: with tight clusters most pairs are gone after the first dimensions, and none is lost."""
    import pyarrow as pa

    monkeypatch.setattr(topk, "BLOCK", 100)
    r = np.random.default_rng(5)
    data = np.floor(64 * np.array(vectors(2000, 64, 5)))
    data[:1000] *= 4
    seen = []
    compacted = topk.Search._compacted
    monkeypatch.setattr(topk.Search, "_compacted", lambda self, step, *a: seen.append(step) or compacted(self, step, *a))
    search_ = topk.Search(data[:50], 6, np.float64)
    for start in range(0, 2000, 100):
        ids = pa.array([[i] for i in range(start, start + 100)], pa.list_(pa.int64()))
        search_.take(data[start : start + 100], ids)
    scores = (data[:50] @ data.T).astype(np.int64)
    for q in range(50):
        want = sorted((-s, i) for i, s in enumerate(scores[q]))[:6]
        assert [(-s, i) for s, i in zip(search_.scores[q], search_.ids[q])] == want
    assert seen and r is not None


def test_ties_copies_and_repeated_rows(spark, stage):
    one = vectors(3, 8, 2)
    rows = [(i, one[i % 3]) for i in range(120)] + [(20, one[0]), (20, one[1]), (40, one[2]), (40, one[1]), (40, one[1])]
    assert search(spark, stage, rows, k=6, every=20) == brute(rows, 6, 20)
    assert search(spark, stage, rows, k=200, every=20) == brute(rows, 200, 20)


def test_rows_that_take_no_part(spark, stage):
    nan, inf = float("nan"), float("inf")
    rows = list(enumerate(vectors(30, 4, 3)))
    bad = [(0, None), (20, [1.0, None, 0.0, 0.0]), (40, [nan, 0.0, 0.0, 0.0]), (60, [0.0, inf, 0.0, 0.0]), (None, rows[3][1])]
    assert search(spark, stage, rows + bad, k=3, every=10) == brute(rows, 3, 10)


def test_large_components_stay_exact(spark, stage):
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.normal(scale=4e5, size=6)]) for i in range(90)]
    assert search(spark, stage, rows, k=5, every=9) == brute(rows, 5, 9)
    rows += [(90, [3e38] * 6), (99, [-3e38] * 6)]
    found = search(spark, stage, rows, k=5, every=9)
    assert [f for f in found if f[0] == 90 and f[1] == 1] and all(abs(f[3]) < 1 << 63 for f in found)


def test_empty_short_and_single(spark, stage):
    assert search(spark, stage, []) == []
    assert search(spark, stage, [(0, [1.0, 2.0])]) == []
    assert search(spark, stage, [(0, []), (1, []), (2, [])], every=1) == brute([(0, []), (1, []), (2, [])], 20, 1)
    mixed = [(0, [1.0]), (1, [1.0, 2.0]), (2, [])]
    filled = [(0, [1.0, 0.0]), (1, [1.0, 2.0]), (2, [0.0, 0.0])]
    assert search(spark, stage, mixed, every=1) == brute(filled, 20, 1)
