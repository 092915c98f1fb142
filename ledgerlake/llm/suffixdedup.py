"""Removal of repeated byte strings by hash-compared suffix sorting.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts earlier: in a document with a
smaller id, or further up in the same one.  All strings are judged on the input.

1. *Anchors.*  Of every window of ``LENGTH`` bytes the ``GRAM``-byte string with the smallest hash is an anchor, so
   equal windows have equal anchors at equal places.  Anchors whose hash occurs twice are kept: tasks settle
   repeats of their own and send the rest, packed, to the bucket of the hash.
2. *Contexts.*  The bytes around each repeated anchor that any window over it can reach go to the task of the
   anchor's hash.  Equal contexts of one task are reduced to the first of them before that.  An anchor with more
   than ``MEMBERS`` places is hot: its windows go by their own hashes, so that a passage in very many documents
   is sent once per task, and the surroundings in which they differ spread over all tasks.
3. *Suffix sort.*  The suffixes from the anchor on, and those running backwards from it, are merge-sorted.  Two
   suffixes are compared by binary search over polynomial prefix hashes for the length of their common part, and
   then by the byte behind it.  Neighbours in the order are verified byte by byte; if a hash has misled the
   sort, that batch is sorted by its bytes.  Runs of the two orders say which windows over the anchor are
   equal, and all but the first of equal windows are removed.
4. *Removal.*  The removed stretches of each document are united and taken out of its bytes.

Order of documents: by id, NULL ids last, then by row number, so that of repeated rows the first keeps its
bytes.  ``docs`` must be a table scan, which numbers its rows alike each time.  NULL texts are empty; texts
shorter than ``LENGTH`` bytes lose nothing; very long texts are cut into overlapping slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ROW, numbered, partitions
from ledgerlake.sinks.stage import Stage

LENGTH = 100
GRAM = 32
REACH = LENGTH - GRAM  # how far a window can extend on either side of an anchor
SLICE = 1 << 20
MEMBERS = 1 << 14  # places of an anchor beyond which it is hot
SORTED = 1 << 13  # suffixes sorted together
HOT_ANCHORS = 100_000
REMEMBERED = 40_000  # contexts a task keeps to settle repeats

_BASE = 0x9E3779B97F4A7C15
_NO_ID = np.iinfo(np.int64).max
_U = np.uint64


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up = np.full(n, _BASE, dtype=_U)
    down = np.full(n, pow(_BASE, -1, 1 << 64), dtype=_U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """``pick`` over each ``values[i : i + width]``, by minima or maxima of blocks from both ends."""
    n = len(values)
    padded = np.full(-(-n // width) * width + width, fill, dtype=values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    back = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes (48 bits at most) of the anchors of texts that lie end to end in ``data``.

    ``ends`` gives for each byte the end of its text.
    """
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    up, down = _powers(1 << (max(n, SLICE) - 1).bit_length())
    sums = np.zeros(n + 1, dtype=_U)
    np.cumsum((data + _U(1)) * up[:n], out=sums[1:])
    h = (sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1]
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h = (h >> _U(17)) + _U(1)  # zero is left for windows that do not count
    width = REACH + 1
    least = _sliding(h, width, np.minimum, (1 << 64) - 1)
    least[np.arange(len(h)) + LENGTH > ends[: len(h)]] = 0  # windows that run over the end of their text
    # A gram is an anchor if it is the least of one of the windows that it is part of.
    shifted = np.concatenate([np.zeros(width - 1, dtype=_U), least])
    found = np.flatnonzero(_sliding(shifted, width, np.maximum, 0)[: len(h)] == h)
    return found, h[found].astype(np.int64)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list[tuple[int, int]], list[bytes]]]:
    """Texts of a batch in groups of about ``SLICE`` bytes, as (row, offset) and bytes; long ones are cut."""
    at, parts, size = [], [], 0
    for row, text in enumerate(batch.column("bytes")):
        data = text.as_py()
        for start in range(0, max(1, len(data) - LENGTH + 1), SLICE):
            part = data[start : start + SLICE + LENGTH - 1]
            if parts and size + len(part) > SLICE:
                yield at, parts
                at, parts, size = [], [], 0
            at.append((row, start))
            parts.append(part)
            size += len(part)
    if parts:
        yield at, parts


def _pack(h: np.ndarray, record: np.ndarray, place: np.ndarray) -> bytes:
    return (h & 0xFFFFFFFF).astype("<u4").tobytes() + (h >> 32).astype("<u2").tobytes() + record.astype("<i8").tobytes() + place.astype("<u4").tobytes()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(blob) // 18
    low, high = np.frombuffer(blob, "<u4", n), np.frombuffer(blob, "<u2", n, 4 * n)
    h = low.astype(np.int64) | (high.astype(np.int64) << 32)
    return h, np.frombuffer(blob, "<i8", n, 6 * n), np.frombuffer(blob, "<u4", n, 14 * n).astype(np.int64)


_BLOBS = pa.schema([("bucket", pa.int32()), ("sent", pa.binary()), ("known", pa.binary())])
_HITS = pa.schema([("record", pa.int64()), ("hash", pa.int64()), ("place", pa.int64())])


def _anchor_blobs(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = batch.column("record").to_numpy()
            for at, parts in _slices(batch):
                lengths = np.array([len(p) for p in parts])
                bounds = np.cumsum(lengths)
                data = np.frombuffer(b"".join(parts), dtype=np.uint8)
                found, h = anchors(data, np.repeat(bounds, lengths))
                if not len(found):
                    continue
                own = np.searchsorted(bounds, found, side="right")
                rows, offsets = np.array(at).T
                record = records[rows[own]]
                place = found - (bounds - lengths)[own] + offsets[own]
                order = np.argsort(h, kind="stable")
                h, record, place = h[order], record[order], place[order]
                new = np.concatenate([[True], h[1:] != h[:-1]])
                again = ~new | ~np.append(new[1:], True)
                # What repeats here is known to repeat; one of each hash is sent on for the others to meet.
                known = _pack(h[again], record[again], place[again])
                h, record, place = h[new], record[new], place[new]
                bucket = h % buckets
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                sent, numbers = [], []
                for b in np.flatnonzero(np.diff(cuts)).tolist():
                    some = order[cuts[b] : cuts[b + 1]]
                    sent.append(_pack(h[some], record[some], place[some]))
                    numbers.append(b)
                where = int(record[0]) % buckets
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*numbers, where], pa.int32()), pa.array([*sent, b""], pa.binary()), pa.array([*[b""] * len(sent), known], pa.binary())],
                    schema=_BLOBS,
                )

    return run


def _hits(h: np.ndarray, record: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(record), pa.array(h), pa.array(place)], schema=_HITS)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors whose hash occurs more than once; a partition holds whole buckets."""
    sent: list[bytes] = []
    for batch in batches:
        for blob in batch.column("known"):
            if known := blob.as_py():
                yield _hits(*_unpack(known))
        sent += [blob for blob in batch.column("sent").to_pylist() if blob]
    if sent:
        h, record, place = (np.concatenate(x) for x in zip(*map(_unpack, sent)))
        order = np.argsort(h, kind="stable")
        h = h[order]
        same = h[1:] == h[:-1]
        again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        chosen = order[again]
        yield _hits(h[again], record[chosen], place[chosen])


_CONTEXTS = pa.schema(
    [
        ("hash", pa.int64()), ("rank", pa.int64()), ("record", pa.int64()), ("place", pa.int64()), ("left", pa.int32()),
        ("right", pa.int32()), ("context", pa.binary()),
    ]
)


def _windows(data: bytes, place: int) -> Iterator[tuple[int, bytes]]:
    """All windows of a text that hold the gram at ``place``."""
    for start in range(max(0, place - REACH), min(place, len(data) - LENGTH) + 1):
        yield start, data[start : start + LENGTH]


def _contexts(hot: Broadcast):
    """The surroundings of repeated anchors, to meet by the anchor's hash.

    One that follows an equal one of the same task is settled here.  Those of a hot anchor meet window by
    window instead, by the hash of the window: what very many documents share is settled in the task, and
    what differs goes to different tasks.  The memory of what was sent is bounded; once it is full it starts
    anew, and more is sent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The first place that was sent, in the order of documents; an earlier one is sent as well.
        seen: dict[tuple[int, int, bytes], tuple[int, int, int]] = {}
        windows: dict[bytes, tuple[int, int, int]] = {}
        for batch in batches:
            ranks, records = batch.column("rank").to_numpy(), batch.column("record").to_numpy()
            sent: set[tuple[int, int]] = set()
            rows: list[tuple] = []
            for i in np.lexsort([records, ranks]).tolist():
                data, rank, record = batch.column("bytes")[i].as_py(), int(ranks[i]), int(records[i])
                settled: list[tuple[int, int]] = []
                for memory in (seen, windows):
                    if len(memory) > REMEMBERED:
                        memory.clear()
                for place, h in sorted({(x["place"], x["hash"]) for x in batch.column("hits")[i].as_py()}):
                    start, end = max(0, place - REACH), min(len(data), place + LENGTH)
                    if end - start < LENGTH:
                        continue
                    context = data[start:end]
                    key, own = (h, place - start, context), (rank, record, place)
                    if seen.get(key, own) < own:
                        settled.append((start, end))
                        continue
                    seen[key] = own
                    if h not in hot.value:
                        rows.append((h, rank, record, place, place - start, end - place, context))
                        continue
                    for at, window in _windows(data, place):
                        own = (rank, record, at)
                        if windows.get(window, own) < own:
                            settled.append((at, at + LENGTH))
                        elif (record, at) not in sent:  # two hot anchors may share a window
                            windows[window] = own
                            sent.add((record, at))
                            rows.append((xxhash.xxh3_64_intdigest(window) >> 1, rank, record, at, 0, LENGTH, window))
                # Settled stretches need no company; they travel by their document.
                rows += [(record, rank, record, start, 0, end - start, None) for start, end in _united(settled)]
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CONTEXTS)], schema=_CONTEXTS)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CONTEXTS)], schema=_CONTEXTS)

    return run


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((start, end))
    return found


class Suffixes:
    """Rows of bytes, each from column 0 on, to be sorted within groups."""

    def __init__(self, rows: np.ndarray, lengths: np.ndarray) -> None:
        self.rows, self.lengths, self.width = rows, lengths, rows.shape[1]
        up, _ = _powers(1 << 20)
        self.sums = np.zeros((len(rows), self.width + 1), dtype=_U)
        # One is added to each byte so that leading zero bytes count.
        np.cumsum((rows.astype(_U) + _U(1)) * up[: self.width], axis=1, out=self.sums[:, 1:])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common part of suffixes ``a`` and ``b``, by binary search over prefix hashes."""
        low = np.zeros(len(a), dtype=np.int64)
        high = np.minimum(self.lengths[a], self.lengths[b])
        for _ in range(int(self.width).bit_length()):
            middle = (low + high + 1) // 2
            same = self.sums[a, middle] == self.sums[b, middle]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, ties: bool) -> np.ndarray:
        """Whether suffix ``a`` comes before ``b``; a prefix comes first, equal ones as ``ties`` says."""
        n = self.common(a, b)
        over = n >= np.minimum(self.lengths[a], self.lengths[b])
        at = np.minimum(n, self.width - 1)
        by_length = np.where(self.lengths[a] == self.lengths[b], ties, self.lengths[a] < self.lengths[b])
        return np.where(over, by_length, self.rows[a, at] < self.rows[b, at])

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Order by group and suffix: runs of 1, 2, 4, ... of each group are merged, all groups side by side.

        A member's place in a merged run is its own place plus the number of members of the sister run that
        come before it, which a binary search finds.
        """
        n = len(group)
        order = np.arange(n)
        first = np.searchsorted(group, group, side="left")
        size = np.searchsorted(group, group, side="right") - first
        width = 1
        while n and width < size.max():
            slot = np.flatnonzero(size > width)  # places in groups that still merge
            inside = slot - first[slot]
            pair = inside // (2 * width) * (2 * width)
            in_left = inside - pair < width
            start = first[slot] + pair + np.where(in_left, width, 0)
            stop = np.minimum(start + width, first[slot] + size[slot])
            low, high = np.minimum(start, stop), stop.copy()
            own = order[slot]
            while (active := np.flatnonzero(low < high)).size:
                middle = (low[active] + high[active]) // 2
                other = order[middle]
                me, left = own[active], in_left[active]
                # Equal suffixes of the left run go first, which keeps the order of documents.
                goes = np.where(left, self.before(other, me, False), self.before(other, me, True))
                low[active] = np.where(goes, middle + 1, low[active])
                high[active] = np.where(goes, high[active], middle)
            counted = low - start
            counted[start >= stop] = 0
            base = first[slot] + pair
            own_place = inside - pair - np.where(in_left, 0, width)
            merged = order.copy()
            merged[base + own_place + counted] = own
            order = merged
            width *= 2
        return order

    def classes(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sorted order and the verified common length of each suffix with the one before it (-1: none)."""
        order = self.sort(group)
        a, b = order[:-1], order[1:]
        shared = np.where(group[a] == group[b], self.common(a, b), -1)
        if not self._verified(a, b, shared):
            order = self._byte_order(group)
            a, b = order[:-1], order[1:]
            shared = np.where(group[a] == group[b], self._byte_common(a, b), -1)
        return order, np.concatenate([[-1], shared])

    def _verified(self, a: np.ndarray, b: np.ndarray, shared: np.ndarray) -> bool:
        mates = shared >= 0
        true = self._byte_common(a[mates], b[mates])
        if not np.array_equal(true, shared[mates]):
            return False
        at = np.minimum(true, self.width - 1)
        la, lb = self.lengths[a[mates]], self.lengths[b[mates]]
        over = true >= np.minimum(la, lb)
        return bool(np.where(over, la <= lb, self.rows[a[mates], at] < self.rows[b[mates], at]).all())

    def _byte_common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        same = np.logical_and.accumulate(self.rows[a] == self.rows[b], axis=1).sum(axis=1)
        return np.minimum(same, np.minimum(self.lengths[a], self.lengths[b]))

    def _byte_order(self, group: np.ndarray) -> np.ndarray:
        inside = np.arange(self.width) < self.lengths[:, None]
        keys = np.where(inside, self.rows.astype(np.int16) + 1, 0)
        return np.lexsort([*keys.T[::-1], group])


def covered(group: np.ndarray, left: np.ndarray, right: np.ndarray, contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per member, how far its removed bytes reach to the left and right of the anchor's start (0, 0: none).

    Members are ordered by group and, inside it, by document and place.
    """
    n = len(group)
    sizes = left + right
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    offset = np.cumsum(sizes) - sizes
    ahead, behind = np.zeros((n, LENGTH), dtype=np.uint8), np.zeros((n, REACH), dtype=np.uint8)
    column = np.arange(LENGTH)
    inside = column < right[:, None]
    ahead[inside] = data[((offset + left)[:, None] + column)[inside]]
    column = np.arange(REACH)
    inside = column < left[:, None]
    behind[inside] = data[((offset + left - 1)[:, None] - column)[inside]]
    forward, forward_shared = Suffixes(ahead, right).classes(group)
    backward, backward_shared = Suffixes(behind, left).classes(group)
    most, least = np.full(n, -1), np.full(n, LENGTH)
    for reach in range(REACH + 1):  # windows that start so many bytes before the anchor
        members = np.flatnonzero((left >= reach) & (right >= LENGTH - reach))
        if not len(members):
            continue
        on, back = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        on[forward] = np.cumsum(forward_shared < LENGTH - reach)
        back[backward] = np.cumsum(backward_shared < reach)
        # Equal keys are equal windows; the first member of a key is the first in the order of documents.
        _, first, key = np.unique(on[members] * (n + 1) + back[members], return_index=True, return_inverse=True)
        removed = members[first[key] != np.arange(len(members))]
        most[removed] = np.maximum(most[removed], reach)
        least[removed] = np.minimum(least[removed], reach)
    hit = most >= 0
    return np.where(hit, most, 0), np.where(hit, LENGTH - least, 0)


_SPANS = pa.schema([("record", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _span_batch(record: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(record, pa.int64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], schema=_SPANS)


def _judged(table: pa.Table) -> pa.RecordBatch:
    group, record, place = (table.column(c).to_numpy() for c in ("hash", "record", "place"))
    left, right = (table.column(c).to_numpy().astype(np.int64) for c in ("left", "right"))
    back, on = covered(group, left, right, table.column("context").to_pylist())
    hit = on > 0
    return _span_batch(record[hit], (place - back)[hit], (place + on)[hit])


def _sorted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed stretches; groups arrive sorted, and whole groups are sorted together in batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        settled = batch.filter(batch.column("context").is_null())
        record, place, right = (settled.column(c).to_numpy() for c in ("record", "place", "right"))
        yield _span_batch(record, place, place + right)
        batch = batch.filter(batch.column("context").is_valid())
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= SORTED:
            table = pa.Table.from_batches(held)
            group = table.column("hash").to_numpy()
            cut = int(np.searchsorted(group, group[-1], side="left"))  # the last group may go on
            if cut:
                yield _judged(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
            size = sum(b.num_rows for b in held)
    if held:
        yield _judged(pa.Table.from_batches(held))


def _rows(docs: DataFrame, stage: Stage) -> DataFrame:
    return numbered(docs, stage).select(
        F.col(ROW).alias("record"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("doc_id", F.lit(int(_NO_ID))).cast("long").alias("rank"),
        F.coalesce("text", F.lit("")).cast("binary").alias("bytes"),
    )


def _hot_anchors(hits: DataFrame) -> frozenset[int]:
    """Hashes of anchors with more places than one task should sort: at most ``HOT_ANCHORS``, whatever the size."""
    counts = hits.select(F.explode("hits.hash").alias("hash")).groupBy("hash").count()
    total = F.sum(F.size("hits"))
    fair = max(MEMBERS, (hits.agg(total.alias("n")).first()["n"] or 0) // HOT_ANCHORS)
    return frozenset(r["hash"] for r in counts.where(F.col("count") > fair).select("hash").collect())


def removed_spans(rows: DataFrame, stage: Stage) -> DataFrame:
    """``record, start, end``: stretches to remove, in bytes; they may overlap and repeat."""
    n = partitions(rows.sparkSession)
    blobs = rows.select("record", "bytes").mapInArrow(_anchor_blobs(n), "bucket int, sent binary, known binary")
    repeats = blobs.repartition(n, "bucket").mapInArrow(_repeats, "record long, hash long, place long")
    hits = stage.keep(repeats.groupBy("record").agg(F.collect_list(F.struct("hash", "place")).alias("hits")), "anchors")
    hot = rows.sparkSession.sparkContext.broadcast(_hot_anchors(hits))
    contexts = rows.join(hits, "record").select("record", "rank", "bytes", "hits").mapInArrow(
        _contexts(hot), "hash long, rank long, record long, place long, left int, right int, context binary"
    )
    grouped = contexts.repartition(n, "hash").sortWithinPartitions("hash", "rank", "record", "place")
    return grouped.mapInArrow(_sorted_windows, "record long, start long, end long")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, kept = [], []
        for data, spans in zip(batch.column("bytes"), batch.column("spans")):
            data, stretches = data.as_py(), _united([(x["start"], x["end"]) for x in spans.as_py() or []])
            at, parts = 0, []
            for start, end in stretches:
                parts.append(data[at:start])
                at = end
            kept.append(b"".join([*parts, data[at:]]))
            counts.append((len(data), sum(e - s for s, e in stretches), len(stretches)))
        columns = [pa.array(list(c), pa.int64()) for c in zip(*counts)] if counts else [pa.array([], pa.int64())] * 3
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def deduplicated(docs: DataFrame, stage: Stage) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` per row of ``docs``; ``kept`` holds the bytes that remain."""
    rows = _rows(docs, stage)
    spans = stage.keep(removed_spans(rows, stage), "spans")
    by_record = spans.groupBy("record").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = rows.join(by_record, "record", "left").select("doc_id", "bytes", "spans")
    return joined.mapInArrow(_without, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
