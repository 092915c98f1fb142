from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from ledgerlake.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, p int, value double, rank string"
EXTRA = ("x", 1, 2, 0.5, "y")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, least=30, top=50):
    docs = [(lang or "", source or "", [t.translate(LOWER) for t in TERM.findall(text or "")]) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= least}
        groups = {s: Counter() for _, s, _ in mine}
        for _, s, ts in mine:
            groups[s].update(t for t in ts if t in kept)
        whole = sum(groups.values(), Counter())

        def p(counts, t):
            return 1 + 10**9 * (counts[t] + 5) // (sum(counts.values()) + 5 * len(kept))

        for s, counts in groups.items():
            pairs = [(-sum(abs(p(counts, t) - p(other, t)) for t in kept), o.encode(), o) for o, other in groups.items() if o != s]
            terms = [(p(whole, t) - p(counts, t), t.encode(), t) for t in kept if counts[t] and p(counts, t) > p(whole, t)]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -down, rank) for rank, (down, _, item) in enumerate(found, 1)]
    return sorted(out)


def audited(spark, stage, rows, **options):
    table = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(5)
    found = divergence.audit(table, stage, **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


def make(n, seed, sources=9, words=120):
    r = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(words)] + ["Straße", "ŒUVRE", "日本", "Ünï"]
    rows = []
    for i in range(n):
        s = r.randrange(sources)
        text = " ".join(r.choice(vocabulary[s * 5 :]).upper() if r.random() < 0.1 else r.choice(vocabulary[s * 5 :]) for _ in range(r.randrange(60)))
        rows.append((i, text.replace(" ", r.choice([" ", ". ", "7", "_", "\x7f"])), r.choice(["en", "de", None]), f"src{s}"))
    return rows


def test_same_as_loops(spark, stage):
    rows = make(500, 1)
    assert audited(spark, stage, rows) == brute(rows)


def test_many_cells_give_the_same(spark, stage, monkeypatch):
    monkeypatch.setattr(divergence, "GROUP_BLOCK", 2)
    monkeypatch.setattr(divergence, "TERM_BLOCK", 7)
    rows = make(400, 2, sources=11)
    assert audited(spark, stage, rows, least_docs=3, top_terms=4) == brute(rows, 3, 4)


def test_nulls_ties_repeated_rows_and_groups_without_terms(spark, stage):
    rows = [(1, "a b", "en", "x")] * 40 + [(2, "b a", "en", "y")] * 40 + [(3, None, "en", "z"), (4, "", "en", None), (None, "1 2 3", "fr", "x"), (5, "rare", "fr", "é"), (6, "AÄb\x00B", None, None)]
    found = audited(spark, stage, rows)
    assert found == brute(rows)
    assert [(f[1], f[4]) for f in found if f[0] == "fr"] == [("x", 0), ("é", 0)]
    # Equal texts in other words' order: no distance, no term above the language by more than the empty groups' share.
    assert [f[4] for f in found if f[:4] == ("en", "x", "pair", "y")] == [0]


def test_full_dictionaries_are_handed_on(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD", 5)
    texts = ["a b c d e f a", "a a", "", "g h i j k l m"]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 4, "source": ["s", "s", "t", "s"], "text": texts})
    total = Counter()
    for out in divergence._counting(iter([batch])):
        for row in out.to_pylist():
            total[row["source"], row["term"]] += row["n"]
    assert total["s", "a"] == 4 and total["s", "m"] == 1 and total["t", None] == 0 and ("t", None) in total


def test_long_text_and_large_counts(spark, stage):
    rows = [(i, "xyz " * 200_000 if i == 0 else "xyz abc", "en", f"s{i % 2}") for i in range(60)] + [(99, "q" * 1_000_000, "en", "s0")]
    assert audited(spark, stage, rows) == brute(rows)


def test_frequencies_of_very_large_counts(spark):
    big = 9 * 10**15
    row = spark.range(1).select(divergence._frequency(*(divergence.F.lit(x).cast("long") for x in (big, big + 7, 11))).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (big + 5) // (big + 7 + 55)


@pytest.mark.parametrize("rows", [[], [(1, "only", "en", "one")]])
def test_empty_and_single(spark, stage, rows):
    assert audited(spark, stage, rows) == brute(rows) == []
