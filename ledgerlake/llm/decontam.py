"""Benchmark decontamination: every training passage is a BM25 query against an index of the test items.

Passages are overlapping windows of a document.  Items are put in classes by length, and the passages of a class are
such that any copy of one of its items, and a fifth more, lies whole in one of them; so one very long item does not
stretch the passages that short ones are looked for in.

The index of a class holds a posting list for each term: the items that have it, in blocks, with their BM25 impacts
divided by the item's threshold (``SHARE`` of the score an item gives itself), and the largest impact of each block.
A passage goes through it as in block-max WAND: no item can reach the threshold by terms whose largest impacts add up to
less than it, so only blocks in the lists of the other terms (behind the pivot) are candidates; of these the block
maxima are added up, and postings are scored only in blocks whose sum reaches the threshold.  All items above it are
retrieved, not a top k.  Document frequencies, number and mean length of items are those of the whole benchmark.

What is retrieved is verified.  It is a leak if the passage holds ``OVERLAP`` of the
five-word shingles of the item's question and of its answer each, or of the words of each where the item is laid
beside its best place in the passage (a changed word breaks up to five shingles, but is one word).  A part may also
lack one word if the item keeps ``ALIGNED`` of its words, and half of its words if the passage holds ``OVERLAP`` of the
shingles of the whole item; so a question without its answer is no leak.  A copy that passes verification and keeps
its rare words scores above the threshold.

The last sentence of an item is its answer, the words before it are its question; an item of one sentence is
halved.  Words are runs without white space, lower case, less all that is not a letter or digit.  Items
without words, and NULL items, can leak nowhere; NULL and empty texts contain nothing; repeated rows and
repeated items are judged one by one.

Items are spread over indexes by hash, each of about ``INDEX_ITEMS`` items or ``INDEX_CHARS`` characters, which are built in
tasks and broadcast packed.  A task unpacks them one after another over a buffer of texts.  At most ``PASS_INDEXES`` are
broadcast for one pass over the documents; a larger benchmark takes more passes.  Documents stay where they are and
nothing of them is shuffled.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import documents, staging, whole_text

INDEX_ITEMS = 16_384
INDEX_CHARS = 4_000_000
PASS_INDEXES = 16
BUFFER_CHARS = 16_000_000  # of texts that a task holds while it goes through the indexes
BLOCK_ITEMS = 4
K1, B = 1.2, 0.75
SHARE = 0.5
SHINGLE = 5
OVERLAP = 0.8
ALIGNED = 0.9
LEAST_WINDOW = 128
PASSAGES = 256  # passages looked at a time
AT_ONCE = 100_000  # words of short texts that are looked at together
ENTRIES = 1_000_000  # blocks of posting lists added up at a time, unless one passage has more

_SLACK = 1e-4  # sums of single-precision impacts


def word(raw: str) -> str:
    return raw if raw.isalnum() else "".join(c for c in raw if c.isalnum())


def words_of(text: str) -> list[str]:
    return [w for w in map(word, text.lower().split()) if w]


def question_length(text: str) -> int:
    """How many words of an item belong to its question."""
    raw = [r for r in text.lower().split() if word(r)]
    ends = [i + 1 for i, r in enumerate(raw[:-1]) if r.rstrip("\"')]").endswith((".", "?", "!"))]
    return ends[-1] if ends else len(raw) // 2


def parts_of(ids: list[int], question: int) -> tuple[set[tuple], set[tuple]]:
    """The shingles of question and answer; a part shorter than a shingle borrows from its neighbour."""
    n = len(ids)
    if n <= SHINGLE:
        return {tuple(ids)}, {tuple(ids)}
    starts = range(n - SHINGLE + 1)
    ask = {tuple(ids[i : i + SHINGLE]) for i in starts if i + SHINGLE <= max(question, SHINGLE)}
    answer = {tuple(ids[i : i + SHINGLE]) for i in starts if i >= min(question, n - SHINGLE)}
    return ask, answer


def common_subsequence(own: list[int], other: list[int]) -> int:
    """Length of the longest common subsequence, a bit of one number for each element of the first list."""
    places: dict[int, int] = {}
    for i, x in enumerate(own):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(own)) - 1
    row = full
    for x in other:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(own) - row.bit_count()


def aligned(item: list[int], question: int, passage: list[int]) -> tuple[int, int]:
    """How many words of question and answer are in the passage in order, where the item is laid beside its best place.

    The best place is the shift with the most equal words; a fifth of the item's length is added on both sides.
    """
    places: dict[int, list[int]] = {}
    for at, x in enumerate(passage):
        places.setdefault(x, []).append(at)
    shifts = Counter(at - i for i, x in enumerate(item) for at in places.get(x, ()))
    if not shifts:
        return 0, 0
    best = max(shifts.values())
    shift, slack = min(s for s, c in shifts.items() if c == best), len(item) // 5 + 1
    start = max(0, shift - slack)
    cut = max(start, shift + question)
    upto = shift + len(item) + slack
    return (
        common_subsequence(item[:question], passage[start : cut + slack]),
        common_subsequence(item[question:], passage[max(start, cut - slack) : upto]),
    )


class _Terms(dict):
    """Raw token to term number: -1 for words of no item, -2 for tokens without a word."""

    def __missing__(self, raw: str) -> int:
        own = word(raw)
        number = self.vocabulary.get(own, -1) if own else -2
        if len(self) > 200_000:
            self.clear()
        self[raw] = number
        return number


@dataclass
class Postings:
    """The posting lists of the items of one length class.

    The list of term ``t`` is its blocks ``lists[t]`` to ``lists[t + 1]``: their numbers (``block``) and largest impacts
    (``most``); block entry ``e`` holds the postings ``entries[e]`` to ``entries[e + 1]`` (``item``, ``impact``).
    """

    window: int
    n_blocks: int
    upper: np.ndarray  # the largest impact of each term; the last term stands for words of no item
    lists: np.ndarray
    block: np.ndarray
    most: np.ndarray
    entries: np.ndarray
    item: np.ndarray
    impact: np.ndarray


@dataclass
class Index:
    """Items as term numbers, and their posting lists by length class."""

    item_ids: list[int | None]
    copies: list[int]
    vocabulary: dict[str, int]
    words: list[np.ndarray]
    questions: list[int]  # how many of an item's words are the question's
    classes: list[Postings]
    terms: _Terms = field(default_factory=_Terms)
    parts: dict[int, tuple[set[tuple], set[tuple]]] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("terms", "parts")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.terms, self.parts = _Terms(), {}
        self.terms.vocabulary = self.vocabulary

    def parts_of(self, item: int) -> tuple[set[tuple], set[tuple]]:
        if item not in self.parts:
            if len(self.parts) > 4096:
                self.parts.clear()
            self.parts[item] = parts_of(self.words[item].tolist(), self.questions[item])
        return self.parts[item]


def window_of(length: int) -> int:
    """The passages in which items of a length are looked for: powers of two, twice the item and a fifth more."""
    return max(LEAST_WINDOW, 2 << (length + length // 5).bit_length())


def build_index(
    items: Sequence[tuple[int | None, str, int]], df: Mapping[str, int], n: int, mean: float
) -> Index:
    """Index some items (id, text, copies) by the statistics of the benchmark; those without words are left out."""
    texts = [(*x, words_of(x[1])) for x in items]
    texts = [x for x in texts if x[3]]
    vocabulary: dict[str, int] = {}
    words = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in x[3]], dtype=np.int32) for x in texts]
    found = np.array([df[w] for w in vocabulary], dtype=float)
    idf = np.log(1 + (n - found + 0.5) / (found + 0.5))
    classes: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
    for i, row in enumerate(words):
        at, tf = np.unique(row, return_counts=True)
        own = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(row) / mean))
        classes.setdefault(window_of(len(row)), []).append((i, at, own / (SHARE * own.sum())))
    index = Index(
        [x[0] for x in texts], [x[2] for x in texts], vocabulary, words, [question_length(x[1]) for x in texts],
        [_postings(window, rows, len(vocabulary)) for window, rows in sorted(classes.items())],
    )
    index.terms.vocabulary = vocabulary
    return index


def _postings(window: int, rows: list[tuple[int, np.ndarray, np.ndarray]], n_terms: int) -> Postings:
    sizes = [len(at) for _, at, _ in rows]
    term = np.concatenate([at for _, at, _ in rows])
    block = np.repeat(np.arange(len(rows)) // BLOCK_ITEMS, sizes)
    item = np.repeat([i for i, _, _ in rows], sizes)
    impact = np.concatenate([own for _, _, own in rows])
    order = np.lexsort((item, block, term))
    term, block, item, impact = term[order], block[order], item[order], impact[order]
    new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])]))
    most = np.maximum.reduceat(impact, new)
    upper = np.zeros(n_terms + 1)
    np.maximum.at(upper, term, impact)
    return Postings(
        window, -(-len(rows) // BLOCK_ITEMS), upper.astype(np.float32),
        np.searchsorted(term[new], np.arange(n_terms + 2)), block[new].astype(np.int32), most.astype(np.float32),
        np.append(new, len(term)), item.astype(np.int32), impact.astype(np.float32),
    )


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers from ``first`` on, ``size`` of each."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


def retrieved(lists: Postings, texts: Sequence[np.ndarray]) -> Iterator[tuple[int, int, int, int, float]]:
    """``text, start, end, item, score`` of every passage and item at or above the threshold (a score of 1)."""
    step, other = lists.window // 2, len(lists.upper) - 1
    halves = np.array([max(2, -(-len(ids) // step)) for ids in texts])
    begin = np.cumsum(halves) - halves
    padded = np.full(int(halves.sum()) * step, other, dtype=np.int32)
    for at, ids in zip((begin * step).tolist(), texts):
        padded[at : at + len(ids)] = ids
    padded[padded < 0] = other
    padded = padded.reshape(-1, step)
    text = np.repeat(np.arange(len(texts)), halves - 1)
    passage = _ranges(begin, halves - 1)  # the last half is part of the passage before it
    at_once = max(1, min(PASSAGES, PASSAGES * LEAST_WINDOW // lists.window))
    for first in range(0, len(passage), at_once):
        own = passage[first : first + at_once]
        terms = np.sort(np.concatenate([padded[own], padded[own + 1]], axis=1), axis=1)
        terms[:, 1:][terms[:, 1:] == terms[:, :-1]] = other  # each term counts once
        upper = lists.upper[terms]
        live = np.flatnonzero(upper.sum(axis=1) >= 1 - _SLACK)
        if not len(live):
            continue
        terms, upper = terms[live], upper[live]
        sizes = (lists.lists[terms + 1] - lists.lists[terms]).sum(axis=1)
        for part in np.split(np.arange(len(live)), np.flatnonzero(np.diff(np.cumsum(sizes) // ENTRIES)) + 1):
            for p, item, score in _above(lists, terms[part], upper[part]):
                at = first + int(live[part[p]])
                t = int(text[at])
                start = (int(passage[at]) - int(begin[t])) * step
                yield t, start, min(start + 2 * step, len(texts[t])), item, score


def _above(lists: Postings, terms: np.ndarray, upper: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """``passage, item, score`` of the items that reach the threshold in some passages (a row of terms each)."""
    # Behind the pivot: the terms without which the others' largest impacts stay below the threshold.
    order = np.argsort(upper, axis=1)
    reached = np.cumsum(np.take_along_axis(upper, order, axis=1), axis=1) >= 1 - _SLACK
    needed = np.zeros_like(reached)
    np.put_along_axis(needed, order, reached, axis=1)
    passage, place = np.nonzero(upper > 0)
    term, needed = terms[passage, place], needed[passage, place]
    size = lists.lists[term + 1] - lists.lists[term]
    entry = _ranges(lists.lists[term], size)
    key = np.repeat(passage * lists.n_blocks, size) + lists.block[entry]
    candidate = np.zeros(len(terms) * lists.n_blocks, dtype=bool)
    candidate[key[np.repeat(needed, size)]] = True
    keep = candidate[key]
    entry, key = entry[keep], key[keep]
    bound = np.bincount(key, weights=lists.most[entry], minlength=len(candidate))
    keep = bound[key] >= 1 - _SLACK
    entry, key = entry[keep], key[keep]
    # Postings of the blocks that are left.
    size = lists.entries[entry + 1] - lists.entries[entry]
    posting = _ranges(lists.entries[entry], size)
    item = lists.item[posting].astype(np.int64)
    pairs, at = np.unique(np.repeat(key // lists.n_blocks, size) << 32 | item, return_inverse=True)
    scores = np.bincount(at, weights=lists.impact[posting], minlength=len(pairs))
    for k in np.flatnonzero(scores >= 1 - _SLACK).tolist():
        yield int(pairs[k]) >> 32, int(pairs[k]) & 0xFFFFFFFF, float(scores[k])


def near_copy(index: Index, item: int, passage: list[int], inside: set[tuple]) -> tuple[float, float] | None:
    """Shares of question and answer in a passage if it holds a copy with some words changed."""
    words, question = index.words[item].tolist(), index.questions[item]
    n = len(words)
    if n <= SHINGLE or not 0 < question < n:
        return None
    shingles = {tuple(words[i : i + SHINGLE]) for i in range(n - SHINGLE + 1)}
    whole = len(shingles & inside) >= OVERLAP * len(shingles)
    if not whole and sum(x in passage for x in words) < OVERLAP * n:
        return None
    q, a = aligned(words, question, passage)
    least = 1 if q + a >= ALIGNED * n else 0

    def enough(found: int, size: int) -> bool:
        return found >= OVERLAP * size or found >= size - least or whole and 2 * found >= size

    if enough(q, question) and enough(a, n - question):
        return q / question, a / (n - question)
    return None


def leaks_in(index: Index, texts: Sequence[str]) -> list[list[tuple[int | None, float, float, float]]]:
    """``item_id, score, question, answer`` of the items that each text contains, with the item's best passage."""
    found: list[list] = []
    held: list[np.ndarray] = []
    lookup, words = index.terms.__getitem__, 0
    for text in texts:
        ids = np.array(list(map(lookup, text.lower().split())), dtype=np.int32)
        held.append(ids[ids != -2])
        words += len(ids)
        if words >= AT_ONCE:
            found += _leaks(index, held)
            held, words = [], 0
    return found + _leaks(index, held)


def _leaks(index: Index, texts: list[np.ndarray]) -> list[list[tuple[int | None, float, float, float]]]:
    best: list[dict[int, tuple]] = [{} for _ in texts]
    cut, shingles, own = None, set(), []
    hits = (hit for lists in index.classes if texts for hit in retrieved(lists, texts))
    for text, start, end, item, score in hits:
        if (text, start, end) != cut:
            cut, own = (text, start, end), texts[text][start:end].tolist()
            shingles = {tuple(own[i : i + SHINGLE]) for i in range(max(1, len(own) - SHINGLE + 1))}
        ask, answer = index.parts_of(item)
        if len(next(iter(ask))) < SHINGLE:  # an item of a few words
            n = len(next(iter(ask)))
            inside = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}
        else:
            inside = shingles
        q, a = len(ask & inside) / len(ask), len(answer & inside) / len(answer)
        leak = min(q, a) >= OVERLAP
        if not leak and (near := near_copy(index, item, own, inside)):
            (q, a), leak = near, True
        if leak and (item not in best[text] or best[text][item] < (q + a, score)):
            best[text][item] = (q + a, score, q, a)
    return [
        [(index.item_ids[i], s * SHARE, q, a) for i, (_, s, q, a) in sorted(b.items()) for _ in range(index.copies[i])]
        for b in best
    ]


_LEAK = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("question_overlap", T.DoubleType()),
        T.StructField("answer_overlap", T.DoubleType()),
    ]
)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _words(texts: pd.Series) -> pd.Series:
    return pd.Series([words_of(t) for t in texts], dtype=object)


def packed_indexes(benchmark: DataFrame) -> DataFrame:
    """``number, packed``: the indexes of a benchmark, each built in one task."""
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
        .groupBy("item_id", "text").agg(F.count("*").alias("copies"))
        .withColumn("words", _words("text")).where(F.size("words") > 0)
    )
    n = F.sum("copies").alias("n")
    whole = items.agg(
        n, F.sum(F.size("words") * F.col("copies")).alias("words"), F.count("*").alias("items"), F.sum(F.length("text")).alias("chars")
    ).first()
    numbers = max(-(-whole["items"] // INDEX_ITEMS), -(-(whole["chars"] or 0) // INDEX_CHARS), 1)
    placed = items.withColumn("number", F.pmod(F.xxhash64("item_id", "text"), F.lit(numbers)))
    terms = placed.select("number", "copies", F.explode(F.array_distinct("words")).alias("word"))
    found = terms.groupBy("word").agg(n, F.collect_set("number").alias("numbers"))
    found = found.select(F.explode("numbers").alias("number"), "word", "n")
    total, mean = whole["n"] or 0, (whole["words"] or 0) / (whole["n"] or 1)

    def build(key: tuple, own: pd.DataFrame, df: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["item_id", "text"])
        ids = [None if pd.isna(i) else int(i) for i in own["item_id"].astype(object)]
        rows = list(zip(ids, own["text"], own["copies"].astype(int)))
        index = build_index(rows, dict(zip(df["word"], df["n"])), total, mean)
        return pd.DataFrame({"number": [key[0]], "packed": [pickle.dumps(index)]})

    # Ids as text: a NULL among long numbers would make them doubles in pandas.
    own = placed.select("number", F.col("item_id").cast("string").alias("item_id"), "text", "copies")
    built = own.groupBy("number").cogroup(found.groupBy("number"))
    return built.applyInPandas(build, "number long, packed binary")


def _searcher(indexes: list[Broadcast]):
    """A column function: text to the leaked items of some indexes."""

    def found_in(texts: list[pd.Series]) -> Iterator[pd.Series]:
        found: list[list[list]] = [[[] for _ in batch] for batch in texts]
        for packed in indexes:
            index = loaded.get(0) or pickle.loads(packed.value)
            if len(indexes) == 1:
                loaded[0] = index
            for batch, rows in zip(texts, found):
                for leaked, row in zip(leaks_in(index, [t or "" for t in batch]), rows):
                    row.extend(dict(zip(_LEAK.names, x)) for x in leaked)
        for rows in found:
            yield pd.Series(rows, dtype=object)

    loaded: dict[int, Index] = {}

    @F.pandas_udf(T.ArrayType(_LEAK))
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held, chars = [], 0
        for batch in batches:
            held.append(batch)
            chars += sum(len(t or "") for t in batch)
            if len(indexes) == 1 or chars >= BUFFER_CHARS:
                yield from found_in(held)
                held, chars = [], 0
        yield from found_in(held)

    return search


def searches(benchmark: DataFrame) -> list:
    """Column functions from a text to its leaked items, one for each pass over the documents."""
    context = benchmark.sparkSession.sparkContext
    packed = [context.broadcast(row["packed"]) for row in packed_indexes(benchmark).toLocalIterator()]
    return [_searcher(packed[i : i + PASS_INDEXES]) for i in range(0, len(packed), PASS_INDEXES)]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: one row per leaked item of a document.

    The score is the share of the item's own BM25 score.
    """
    own = documents(docs)
    found = own.select("doc_id", F.lit(None).cast(T.ArrayType(_LEAK)).alias("leaks")).where(F.lit(False))
    for search in searches(benchmark):
        found = found.unionByName(own.select("doc_id", search(F.col("text")).alias("leaks")))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text contains no test item."""
    passes = searches(benchmark)
    stage = staging(docs.sparkSession, "decontamination") if len(passes) > 1 else None
    for i, search in enumerate(passes):
        docs = docs.where(F.size(search(whole_text())) == 0)
        if i + 1 < len(passes):
            docs = stage.keep(docs, f"pass{i}")  # one pass's indexes at a time
    return docs
