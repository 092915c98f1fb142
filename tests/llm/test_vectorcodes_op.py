from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from ledgerlake.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int, row long, part int, key int, code string, error long"
EXTRA = (1, 2, 3, "x", 4)


def brute(rows, scale=4096, rounds=6):
    """Plain loops over Python integers."""
    kept = [
        (i, label, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return []
    dims = -(-max(len(v) for _, _, v in kept) // 8) * 8
    width = dims // 8
    kept = [(i, label, v + [0] * (dims - len(v))) for i, label, v in kept]
    firsts = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:16]

    def parts(v):
        return [tuple(v[p * width : (p + 1) * width]) for p in range(8)]

    books = [[parts(v)[p] for _, _, v in firsts] for p in range(8)]

    def near(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(e, x)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(8):
            groups: dict[int, list] = {}
            for _, _, v in kept:
                x = parts(v)[p]
                groups.setdefault(near(books[p], x)[1], []).append(x)
            for k, members in groups.items():
                books[p][k] = tuple(sum(c) // len(members) for c in zip(*members))
    out, by_label = [], {}
    for i, label, v in kept:
        hits = [near(books[p], x) for p, x in enumerate(parts(v))]
        error = sum(d for d, _ in hits)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, label, "".join(f"{k:02x}" for _, k in hits), error))
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((i, code, error, by_label[label], digest) for i, label, code, error in out), key=str)


def coded(spark, stage, rows, rounds=6):
    table = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(4)
    codes, books = vectorcodes.compress(table, stage, rounds=rounds)
    done = vectorcodes.with_label_errors(codes, stage).select("vec_id", "code", "error", "label_error")
    return sorted(((*r, vectorcodes.digest(books)) for r in map(tuple, done.collect())), key=str)


def vectors(n, dims, seed, clusters=9):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, dims))
    out = centres[r.integers(0, clusters, n)] + r.normal(scale=0.4, size=(n, dims))
    return [[float(x) for x in v] for v in out / np.sqrt(dims)]


def test_same_as_brute_force(spark, stage):
    rows = [(i, v, i % 5 or None) for i, v in enumerate(vectors(700, 32, 1))]
    assert coded(spark, stage, rows) == brute(rows)


def test_other_splits_give_the_same(spark, other_splits, tmp_path):
    rows = [(i, v, i % 3) for i, v in enumerate(vectors(300, 16, 2))]
    path = str(tmp_path / "v.parquet")
    spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(6).write.parquet(path)
    codes, books = vectorcodes.compress(spark.read.parquet(path), other_splits)
    done = vectorcodes.with_label_errors(codes, other_splits).select("vec_id", "code", "error", "label_error")
    assert sorted(((*r, vectorcodes.digest(books)) for r in map(tuple, done.collect())), key=str) == brute(rows)


def test_ties_copies_and_repeated_rows(spark, stage):
    same = [0.25] * 8
    rows = [(i, same, 1) for i in range(400)] + [(5, [0.5] * 8, None), (5, [0.5] * 8, None), (5, [0.125] * 8, None)]
    rows += [(1000 + i, [(-1) ** i * 0.01 * (i % 7)] * 8, i % 2) for i in range(60)] + [(None, [0.3] * 8, 2)]
    assert coded(spark, stage, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(3, [1.0, -2.0], 1)], [(3, [], 1), (4, [], None)], [(1, None, 1)]])
def test_few_or_no_rows(spark, stage, rows):
    assert coded(spark, stage, rows) == brute(rows)


def test_rows_that_are_dropped_and_short_vectors(spark, stage):
    nan, inf = float("nan"), float("inf")
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(40, 10, 3))]
    rows += [(100, None, 0), (101, [nan] * 10, 0), (102, [1.0, None], 0), (103, [inf], 1), (104, [0.5], 1), (-1, [], None)]
    assert coded(spark, stage, rows) == brute(rows)


def test_large_components(spark, stage):
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.normal(scale=9e3, size=8)], 0) for i in range(100)]
    assert coded(spark, stage, rows) == brute(rows)
    found = coded(spark, stage, rows + [(200, [3e38] * 8, 0), (201, [-3e38] * 8, 0)])
    assert len(found) == 102 and all(e[2] >= 0 for e in found)


def test_shortlist_loses_no_nearest_entry():
    r = np.random.default_rng(5)
    for _ in range(300):
        points = r.integers(-20, 20, (r.integers(1, 30), 3))
        entries = r.integers(-25, 25, (16, 3))
        listed = vectorcodes.shortlist(points.min(axis=0), points.max(axis=0), entries)
        best, distance = vectorcodes.nearest(points, entries[listed])
        every = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (listed[best] == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_hilbert_curve_takes_single_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(np.ndindex(*[1 << bits] * dims)))
        keys = vectorcodes.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()
