"""Spot signatures against a word loop."""

from __future__ import annotations

import hashlib
from itertools import islice

import regex

from ledgerlake.llm import spotsigs

COMMON = set(spotsigs.COMMON)
ROWS = [
    (1, ""), (2, None), (3, "the cat of the dog ran to a big and small house is the end"), (4, "The THE the of of a"),
    (5, "é the über die Straße 😀 und 𝒳 das Haus ist groß"), (7, "the cat the cat"), (9, "the  cat, (dog) the\ncat dog the cat dog "),
    (12, "of the big"), (13, "the big house of the small cat is for the dog " * 3000),
    (14, "no anchors here at least none that count twice"), (15, "other words without any such thing"), (16, "单 词 😀"),
    (17, "!?"), (18, "..."), (19, "word " * 20_000), (20, " "), (21, "the cat sat on a mat " + "one two three four " * 2000 + "the end of it"),
]


def chains(text: str) -> set[tuple]:
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    found = set()
    for i, word in enumerate(words):
        if word in COMMON:
            rest = list(islice((w for w in words[i + 1 :] if w not in COMMON), 2))
            if len(rest) == 2:
                found.add((word, *rest))
    return found or {tuple(words[i : i + 3]) for i in range(len(words))} or ({text} if text else set())


def jaccard(a: set, b: set) -> float:
    if not a and not b:
        return 1.0
    return len(a & b) / len(a | b)


def test_against_a_word_loop(make_docs, stage):
    texts = {i: t or "" for i, t in ROWS}
    ids = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in spotsigs.edited_and_next(make_docs(ROWS), stage).collect()}
    for at, i in enumerate(ids):
        own, after = texts[i], texts[ids[(at + 1) % len(ids)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        row = got[i]
        assert row.next_id == ids[(at + 1) % len(ids)]
        assert (row.n_chars, row.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert len(row.fingerprint.split()) == len(chains(own))
        assert abs(row.near_edited - jaccard(chains(own), chains(edited))) < 1e-9
        assert abs(row.near_next - jaccard(chains(own), chains(after))) < 1e-9


def test_equal_texts_have_equal_fingerprints(make_docs, stage):
    text = "the cat sat on the mat with a hat"
    got = spotsigs.edited_and_next(make_docs([(1, text), (1, text), (None, text)]), stage).collect()
    assert len(got) == 3 and len({r.fingerprint for r in got}) == 1
    assert all(r.near_next == 1.0 for r in got)


def test_long_runs_of_common_words_take_linear_time(make_docs):
    """Neither the stack nor the output may grow with the square of a run."""
    rows = [(1, "the of " * 100_000), (2, "the of " * 100_000 + "cat dog"), (3, "the cat " + "of the " * 100_000 + "dog")]
    got = {r.doc_id: r.fingerprint for r in spotsigs.fingerprints(make_docs(rows)).collect()}
    assert [len(got[i]) for i in (1, 2, 3)] == [4, 2, 1]


def test_one_row_and_none(make_docs, stage):
    assert spotsigs.edited_and_next(make_docs([(3, "abc")]), stage).first().next_id == 3
    assert spotsigs.edited_and_next(make_docs([]).limit(0), stage).collect() == []


def test_pruning_by_length_loses_nothing(spark):
    from pyspark.sql import functions as F

    rows = [(list(range(n)), list(range(m))) for n in range(0, 60, 7) for m in range(0, 60, 5)]
    frame = spark.createDataFrame(rows, "a array<int>, b array<int>")
    for a, b, exact, pruned in frame.select("a", "b", spotsigs.likeness(F.col("a"), F.col("b"), 0.001), spotsigs.likeness(F.col("a"), F.col("b"), 0.5)).collect():
        assert pruned == (exact if exact >= 0.5 else pruned)
        assert pruned in (0.0, exact)


def test_other_file_splits_in_each_job(make_docs, other_splits):
    texts = {i: f"text{i} is a " * (i + 3) for i in range(40)}
    got = {r.doc_id: r for r in spotsigs.edited_and_next(make_docs(list(texts.items()), files=7), other_splits).collect()}
    assert len(got) == 40
    for i, own in texts.items():
        after = texts[(i - 1) % 40]
        half = len(own) // 2
        assert got[i].next_id == (i - 1) % 40
        assert got[i].edited_sha256 == hashlib.sha256((own[: len(own) - half] + after[:half]).encode()).hexdigest()


def test_unequal_texts_without_chains_are_not_alike(make_docs, stage):
    """Likeness 1 comes of equal signatures, never of a lack of them."""
    texts = ["plain words alone", "quite different things", "单词", "别的", "??", "!!", " ", "the of and", "of the", "x"]
    got = spotsigs.edited_and_next(make_docs(list(enumerate(texts))), stage).collect()
    assert len({r.fingerprint for r in got}) == len(texts) and all(r.fingerprint and r.near_next < 1 for r in got)
