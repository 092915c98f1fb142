"""SimHash against brute force over all pairs."""

from __future__ import annotations

import random
import re

import pytest
import xxhash

from ledgerlake.llm import simhash


def brute_print(text: str | None, words: int = 3) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(nodes: list, near) -> list[int]:
    """For each position the smallest position it is linked to."""
    parent = list(range(len(nodes)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            if near(nodes[i], nodes[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(nodes))]


def texts() -> list[tuple[int | None, str | None]]:
    r = random.Random(3)
    base = [r.choice("ab cd ef gh ij kl mn".split()) + str(r.randrange(9)) for _ in range(400)]
    rows = [(i, " ".join(base[:390] + [str(i)])) for i in range(12)]
    rows += [(20 + i, " ".join(r.sample(base, 60))) for i in range(12)]
    rows += [(40, ""), (41, None), (42, " \n\t"), (43, "One"), (44, "one TWO"), (45, "é Ü ß one"), (46, rows[15][1]), (46, rows[15][1])]
    return rows + [(50, "long " * 30_000)]


def test_fingerprints_and_components(make_docs, stage):
    rows = texts()
    got = simhash.classes(make_docs(rows), stage).collect()
    want = {i: brute_print(t) for i, t in rows}
    assert len(got) == len(rows)
    assert all(int(r.fingerprint, 16) == want[r.doc_id] and len(r.fingerprint) == 16 for r in got)
    ids = sorted(want)
    classes = brute_classes([want[i] for i in ids], lambda a, b: (a ^ b).bit_count() <= 2)
    assert {r.doc_id: r.component_id for r in got} == {i: ids[c] for i, c in zip(ids, classes)}


@pytest.mark.parametrize("crowd", [4096, 2])
def test_links_with_crowded_shards(spark, stage, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "SHARD_MAX", crowd)
    r = random.Random(5)
    values = [0]
    for _ in range(12):
        centre = r.getrandbits(64)
        for _ in range(14):
            values.append(centre)
            for bit in r.sample(range(64), r.choice([1, 1, 2, 3])):
                centre ^= 1 << bit
    values = sorted(set(values), key=lambda _: r.random())
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    got = simhash.linked(spark.createDataFrame(rows, "doc_id long, fp long"), stage).collect()
    classes = brute_classes(values, lambda a, b: (a ^ b).bit_count() <= 2)
    assert {r.fp: r.component_id for r in got} == {fp: classes[i] for i, fp in rows}


def test_null_ids_take_part(make_docs, stage):
    got = simhash.classes(make_docs([(None, "a b c"), (9, "a b c"), (None, "x y z q")]), stage).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in got if r.component_id) == [(False, 9), (True, 9)]
    assert sum(r.component_id is None for r in got) == 1


def test_empty_table(make_docs, stage):
    empty = make_docs([]).limit(0)
    assert simhash.classes(empty, stage).collect() == []
    assert simhash.one_of_each(empty, stage).collect() == []


def test_radius_is_bounded(spark, stage):
    with pytest.raises(ValueError):
        simhash.linked(spark.createDataFrame([(1, 1)], "doc_id long, fp long"), stage, radius=3)


def test_one_of_each(make_docs, stage):
    rows = texts() + [(7, "another text under a known id"), (None, "One"), (60, "One"), (60, "One")]
    docs = make_docs(rows)
    prints = [brute_print(t) for _, t in rows]
    classes = brute_classes(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    lowest = {}
    for (i, _), c in zip(rows, classes):
        if i is not None:
            lowest[c] = min(i, lowest.get(c, i))
    want = sorted((i is None, i or 0, t or "") for (i, t), c in zip(rows, classes) if i is None or i == lowest[c])
    kept = simhash.one_of_each(docs, stage)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect()) == want
    assert len(want) < len(rows)


def test_bk_tree_follows_all_edges_in_reach():
    r = random.Random(2)
    values = [r.getrandbits(16) for _ in range(300)]
    tree = simhash.BkTree()
    for i, v in enumerate(values):
        tree.add(v, i)
    for q in values[:40]:
        assert sorted(i for _, i in tree.near(q, 3)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= 3]
