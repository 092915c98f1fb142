"""Decontamination against a scan of every passage with every item."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np

from ledgerlake.llm import decontam


def items() -> list[tuple[int | None, str | None]]:
    r = random.Random(4)
    make = lambda n: " ".join(f"{r.choice('bcdfg')}{r.choice('aeiou')}{r.randrange(300)}" for _ in range(n))
    rows = [(i, make(r.randrange(15, 45)) + ". " + make(r.randrange(6, 12)) + ".") for i in range(40)]
    return rows + [(50, ""), (51, None), (52, "..."), (53, "two words"), (54, rows[3][1])]


def brute(texts, benchmark) -> set[tuple]:
    found = set()
    for doc, text in texts:
        own = decontam.words_of(text or "")
        for item, whole in benchmark:
            words = decontam.words_of(whole or "")
            if words and any(own[i : i + len(words)] == words for i in range(len(own) - len(words) + 1)):
                found.add((doc, item))
    return found


def test_every_passage_is_found(spark, make_docs):
    r = random.Random(9)
    benchmark = items()
    filler = [w for _, t in benchmark[:40] for w in t.split()]
    rows = []
    for i in range(60):
        body = [r.choice(filler) for _ in range(r.randrange(0, 400))]
        if i % 2:
            at = r.randrange(len(body) + 1)
            body[at:at] = benchmark[i % 40][1].upper().replace(" ", "  ").split(" ")
        rows.append((i, " ".join(body)))
    rows += [(70, ""), (71, None), (72, benchmark[0][1]), (72, benchmark[0][1]), (None, benchmark[1][1]), (73, "has two words in it")]
    got = decontam.contaminated(make_docs(rows), spark.createDataFrame(benchmark, "item_id long, text string")).collect()
    assert {(x.doc_id, x.item_id) for x in got} == brute(rows, benchmark)
    assert sum(x.doc_id == 72 for x in got) == 2
    assert all(0.5 - 1e-3 <= x.score for x in got)


def test_an_edited_copy_is_found_and_a_half_is_not(spark, make_docs):
    benchmark = items()[:40]
    words = benchmark[5][1].split()
    answer = len(words) - decontam.question_length(benchmark[5][1])
    edited = " ".join(["changed", *words[1:]])
    rows = [(1, edited), (2, " ".join(words[:-answer])), (3, " ".join(words[-answer:]))]
    got = decontam.contaminated(make_docs(rows), spark.createDataFrame(benchmark, "item_id long, text string")).collect()
    assert [(x.doc_id, x.item_id) for x in got] == [(1, 5)]


def test_indexes_and_passes_give_the_same(spark, make_docs, monkeypatch):
    """Scores too: the statistics are those of the whole benchmark, however it is cut."""
    benchmark = spark.createDataFrame(items() + [(None, items()[7][1]), (9, items()[9][1])], "item_id long, text string")
    docs = make_docs([(i, t) for i, t in items() if t])
    rows = lambda: sorted((r.doc_id, r.item_id or -1, round(r.score, 5)) for r in decontam.contaminated(docs, benchmark).collect())
    whole = rows()
    assert [r[:2] for r in whole].count((9, 9)) == 2 and (7, -1) in [r[:2] for r in whole]
    monkeypatch.setattr(decontam, "INDEX_ITEMS", 7)
    assert decontam.packed_indexes(benchmark).count() > 4
    assert rows() == whole
    monkeypatch.setattr(decontam, "PASS_INDEXES", 2)
    monkeypatch.setattr(decontam, "BUFFER_CHARS", 300)
    assert rows() == whole
    more = make_docs([(1, items()[2][1]), (2, "nothing here"), (3, None)])
    assert sorted(r.doc_id for r in decontam.clean(more, benchmark).collect()) == [2, 3]


def test_a_very_long_item_does_not_stretch_the_others(spark, make_docs):
    """The long item is found in its own passages, the short ones in short passages, each once."""
    r = random.Random(2)
    long = " ".join(f"w{r.randrange(30000)}" for _ in range(20_000)) + ". the end of it."
    benchmark = items()[:40] + [(90, long)]
    words = long.split()
    noise = [f"w{r.randrange(30000)}" for _ in range(60_000)]
    rows = [
        (1, " ".join(noise[:5000] + words + noise[5000:])),
        (2, " ".join(noise + items()[4][1].split())),
        (3, " ".join(noise)),
        (4, " ".join(words[: len(words) // 2])),
    ]
    got = decontam.contaminated(make_docs(rows), spark.createDataFrame(benchmark, "item_id long, text string")).collect()
    assert {(x.doc_id, x.item_id) for x in got} == {(1, 90), (2, 4)}


def test_clean_keeps_columns_and_clean_documents(spark, make_docs):
    benchmark = spark.createDataFrame(items(), "item_id long, text string")
    docs = make_docs([(1, items()[2][1]), (2, "nothing here"), (3, None)])
    kept = decontam.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert decontam.clean(docs, benchmark.limit(0)).count() == 3
    assert decontam.contaminated(make_docs([]).limit(0), benchmark).collect() == []


def index_of(benchmark) -> decontam.Index:
    texts = [decontam.words_of(t) for _, t in benchmark]
    df = Counter(w for t in texts for w in set(t))
    n = sum(1 for t in texts if t)
    return decontam.build_index([(i, t, 1) for i, t in benchmark], df, n, sum(map(len, texts)) / n)


def test_bounds_lose_no_item_above_the_threshold(monkeypatch):
    """Pivot and block maxima against the BM25 formula for every passage and item."""
    r = random.Random(3)
    benchmark = [x for x in items() if x[1]] + [(60 + i, " ".join(items()[i][1].split() * 3)) for i in range(9)]
    index = index_of(benchmark)
    assert len(index.classes) > 1
    df = Counter(t for w in index.words for t in set(w.tolist()))
    n, mean = len(index.words), sum(map(len, index.words)) / len(index.words)

    def impacts(words) -> dict:
        tf = Counter(words)
        norm = decontam.K1 * (1 - decontam.B + decontam.B * len(words) / mean)
        own = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (decontam.K1 + 1) / (c + norm) for t, c in tf.items()}
        return {t: v / (decontam.SHARE * sum(own.values())) for t, v in own.items()}

    every = [impacts(w.tolist()) for w in index.words]
    ids = np.array([r.randrange(-1, len(index.vocabulary)) for _ in range(6000)], dtype=np.int32)
    for at, k in ((100, 3), (2500, 42), (4000, len(every) - 1)):
        ids[at : at + len(index.words[k])] = index.words[k]
    for entries in (decontam.ENTRIES, 50):
        monkeypatch.setattr(decontam, "ENTRIES", entries)
        for lists in index.classes:
            got = {(s, k): score for t, s, _, k, score in decontam.retrieved(lists, [ids[:0], ids, ids[:9]]) if t == 1}
            mine = {int(k) for k in lists.item}
            step = lists.window // 2
            wanted = {}
            for start in range(0, max(1, -(-len(ids) // step) - 1) * step, step):
                terms = set(ids[start : start + 2 * step].tolist())
                for k in mine:
                    score = sum(v for t, v in every[k].items() if t in terms)
                    if score >= 1:
                        wanted[start, k] = score
            assert wanted and all(abs(got[x] - score) < 1e-3 for x, score in wanted.items())
            assert all(score >= 1 - 1e-3 for score in got.values())


def test_every_one_word_edit_is_found_and_a_question_alone_is_not(spark, make_docs):
    benchmark = [(i, t) for i, t in items()[:40]][:8]
    rows, n = [], 0
    for _, text in benchmark:
        words = text.split()
        for at in range(len(words)):
            changed = "other." if words[at].endswith(".") else "other"
            rows.append((n, " ".join([*words[:at], changed, *words[at + 1 :]])))
            n += 1
    short = (99, "bako23 gide4 fuba77 coda12 dibe81 gafu5 bice19 cofi33 dubo62 gebi7 fada90 cuge14. bofa3 digu8.")
    words = short[1].split()
    rows += [(n + i, " ".join([*words[:i], "new", *words[i:]])) for i in range(len(words))]
    rows += [(-1, " ".join(words[:7])), (-2, " ".join(reversed(words)))]
    got = decontam.contaminated(make_docs(rows), spark.createDataFrame([*benchmark, short], "item_id long, text string")).collect()
    assert {x.doc_id for x in got} == {i for i, _ in rows if i >= 0}
