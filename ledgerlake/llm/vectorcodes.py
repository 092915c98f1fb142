"""Vector codes: each of eight parts of a vector by the number of its nearest codebook entry, in exact integers.

Codebooks start as the parts of the vectors with the smallest ids and are moved by rounds of assign and average.

For each part position the parts of all vectors are sorted along a Hilbert curve and stored, once, as flat blocks of
at most ``BLOCK`` neighbours with the box of their minima and maxima and with their sums. A round reads the blocks and
the codebooks (a fixed number of entries, whatever the data). An entry whose nearest point to the box is farther than
another entry's farthest point cannot be nearest to any part in the block; what is left is the block's shortlist. A
shortlist of one takes the whole block by its stored sum and count, and no part is looked at. Otherwise the parts are
measured against the shortlist alone. Sums per entry are added up in the tasks and then over tasks; 16 entries per
part position go to the driver.

Many copies of a vector are neighbours on the curve and fill blocks of their own; the row's number closes the order,
so they are dealt over several tasks.

Defined results. Vectors that are NULL or hold a NULL or non-finite component are dropped. Short vectors count as
filled up with zeros, up to the greatest length rounded up to a multiple of the number of parts. Integer components
are held within a bound from which errors surely fit a long (134,217,728 for 64 components). With fewer rows than
entries there are as many entries as rows; rows that repeat an id are rows of their own, in the order of their
vectors; NULL ids come last. Sums over labels beyond a long are held at its end. An empty table gives no rows. Columns
other than ``vec_id``, the label and the vector are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ROW, numbered
from ledgerlake.llm.vectors import floored, matrix, usable
from ledgerlake.sinks.stage import Stage

PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK = 256
KEY_BITS = 62

_POINTS = "part int, key long, row long, vec_id long, label string, point array<int>"
_BLOCKS = (
    "part int, n int, lo array<int>, hi array<int>, sums array<bigint>, points binary, rows binary, "
    "vec_ids array<bigint>, labels array<string>"
)
_SUMS = "part int, entry int, n long, sums array<bigint>"
_CODES = "row long, vec_id long, label string, code long, error long"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with ``bits`` bits in each dimension.

    After J. Skilling, "Programming the Hilbert curve" (2004): undo the rotations from the top bit down, take the Gray
    code over the dimensions, then read the bits across the dimensions.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(dims):
            high = (x[i] & bit) != 0
            swapped = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swapped)
            x[i] ^= swapped
        bit >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(turn)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def _cut(dims: int, low: float, high: float):
    """Rows of vectors to rows of parts with their places on the curve."""
    width = dims // PARTS
    used = min(width, KEY_BITS)
    bits = max(1, KEY_BITS // max(1, used))
    bits = min(bits, 16)
    scale = ((1 << bits) - 1) / max(high - low, 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            vectors = matrix(batch["vec"], dims)
            columns: list[list] = [[] for _ in range(6)]
            for part in range(PARTS):
                points = vectors[:, part * width : (part + 1) * width]
                cells = np.clip((points[:, :used] - low) * scale, 0, (1 << bits) - 1)
                first = part == 0
                flat = pa.array(np.ascontiguousarray(points).ravel().astype(np.int32))
                for column, values in zip(
                    columns,
                    (
                        pa.array(np.full(n, part, dtype=np.int32)),
                        pa.array(hilbert_keys(cells, bits) if used else np.zeros(n, dtype=np.int64)),
                        batch["row"],
                        batch["vec_id"] if first else pa.nulls(n, pa.int64()),
                        batch["label"] if first else pa.nulls(n, pa.string()),
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), flat),
                    ),
                ):
                    column.append(values)
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], ["part", "key", "row", "vec_id", "label", "point"])

    return run


def _blocks(dims: int):
    """Sorted rows of parts to flat blocks."""
    width = dims // PARTS

    def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))

    def block(rows: pa.Table) -> pa.RecordBatch:
        points = np.asarray(rows["point"].combine_chunks().flatten(), dtype=np.int32).reshape(rows.num_rows, width)
        first = rows["part"][0].as_py() == 0
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows["part"][0].as_py()], pa.int32()),
                pa.array([rows.num_rows], pa.int32()),
                lists(points.min(axis=0), pa.int32()),
                lists(points.max(axis=0), pa.int32()),
                lists(points.sum(axis=0, dtype=np.int64), pa.int64()),
                pa.array([points.tobytes()]),
                pa.array([np.asarray(rows["row"], dtype=np.int64).tobytes()]),
                pa.array([rows["vec_id"].to_pylist() if first else None], pa.list_(pa.int64())),
                pa.array([rows["label"].to_pylist() if first else None], pa.list_(pa.string())),
            ],
            ["part", "n", "lo", "hi", "sums", "points", "rows", "vec_ids", "labels"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            waiting = rows if waiting is None else pa.concat_tables([waiting, rows])
            while waiting.num_rows:
                part = np.asarray(waiting["part"])
                same = int(np.searchsorted(part, part[0], side="right"))
                if same < BLOCK and same == len(part):
                    break  # the next batch may go on with this part
                yield block(waiting.slice(0, min(same, BLOCK)))
                waiting = waiting.slice(min(same, BLOCK))
        if waiting is not None and waiting.num_rows:
            yield block(waiting)

    return run


def shortlist(lo: np.ndarray, hi: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Entries that may be nearest to a point in the box, lowest number first; ties with the best stay in."""
    below, above = lo - entries, entries - hi
    near = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=1)
    far = (np.maximum(-below, -above) ** 2).sum(axis=1)
    return np.flatnonzero(near <= far.min())


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of, and squared distance to, the nearest entry; ties go to the lower number."""
    peak = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * peak * peak * points.shape[1] < 1 << 52:
        # Every sum is an integer below 2**53, so doubles are exact.
        p, e = points.astype(np.float64), entries.astype(np.float64)
        distance = (p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)
    else:
        distance = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(points)), best].astype(np.int64)


class _Stored:
    """The blocks of a batch, read one by one."""

    def __init__(self, batch: pa.RecordBatch, width: int) -> None:
        self.batch, self.width = batch, width
        self.lo, self.hi, self.sums = (
            np.asarray(batch[c].flatten(), dtype=np.int64).reshape(batch.num_rows, width) for c in ("lo", "hi", "sums")
        )

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        parts, sizes = np.asarray(self.batch["part"]), np.asarray(self.batch["n"])
        return iter(zip(range(self.batch.num_rows), parts.tolist(), sizes.tolist()))

    def points(self, i: int) -> np.ndarray:
        flat = np.frombuffer(self.batch["points"][i].as_buffer(), dtype=np.int32)
        return flat.reshape(self.batch["n"][i].as_py(), self.width).astype(np.int64)


def _round(books: np.ndarray, width: int):
    """Blocks to the count and sums of what each entry is nearest to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(books.shape[:2], dtype=np.int64)
        sums = np.zeros(books.shape, dtype=np.int64)
        for batch in batches:
            stored = _Stored(batch, width)
            for i, part, n in stored:
                listed = shortlist(stored.lo[i], stored.hi[i], books[part])
                if len(listed) == 1:
                    count[part, listed[0]] += n
                    sums[part, listed[0]] += stored.sums[i]
                    continue
                points = stored.points(i)
                best, _ = nearest(points, books[part][listed])
                count[part, listed] += np.bincount(best, minlength=len(listed))
                np.add.at(sums[part], listed[best], points)
        part, entry = np.nonzero(count)
        flat = pa.array(sums[part, entry].ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), lists],
            ["part", "entry", "n", "sums"],
        )

    return run


def _assign(books: np.ndarray, width: int):
    """Blocks to one row per part: its entry, shifted to the part's place in the code, and its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stored = _Stored(batch, width)
            for i, part, n in stored:
                listed = shortlist(stored.lo[i], stored.hi[i], books[part])
                best, error = nearest(stored.points(i), books[part][listed])
                code = listed[best].astype(np.int64) << (8 * (PARTS - 1 - part))
                rows = np.frombuffer(batch["rows"][i].as_buffer(), dtype=np.int64)
                ids, labels = (batch[c][i].values if part == 0 else pa.nulls(n, t) for c, t in (("vec_ids", pa.int64()), ("labels", pa.string())))
                yield pa.RecordBatch.from_arrays([pa.array(rows), ids, labels, pa.array(code), pa.array(error)], ["row", "vec_id", "label", "code", "error"])

    return run


def _first_entries(rows: DataFrame, width: int) -> np.ndarray:
    """Codebooks from the vectors with the smallest ids: a fixed number of rows."""
    firsts = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(ENTRIES).select("vec").collect()
    vectors = np.array([r["vec"] for r in firsts], dtype=np.float64).astype(np.int64).reshape(len(firsts), PARTS, width)
    return vectors.transpose(1, 0, 2).copy()


def _moved(blocks: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """Codebooks after one round; an entry that nothing is nearest to stays."""
    found = blocks.mapInArrow(_round(books, width), _SUMS)
    long_sum = [F.sum(F.col("sums")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(width)]
    books = books.copy()
    for row in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *long_sum).collect():
        books[row["part"], row["entry"]] = [int(row[f"s{j}"]) // row["n"] for j in range(width)]
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all integers of the codebooks, by part, entry and place."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def compress(table: DataFrame, stage: Stage, scale: int = 4096, rounds: int = ROUNDS, vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every usable row, and the codebooks (part, entry, place)."""
    rows = numbered(table, stage).where(usable(vector))
    rows = rows.select(F.col(ROW).alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col(vector).alias("_v"))
    length = rows.agg(F.max(F.size("_v")).alias("n")).first()["n"] or 0
    dims = -(-length // PARTS) * PARTS
    width = dims // PARTS
    limit = math.isqrt((1 << 62) // max(dims, 1)) // 2
    rows = rows.select("row", "vec_id", "label", floored("_v", scale, dims, limit).alias("vec"))
    # Where most components lie; what lies outside shares the outermost cells, which costs neighbourhood only.
    spread = rows.agg(F.percentile_approx(F.array_min("vec"), 0.01).alias("low"), F.percentile_approx(F.array_max("vec"), 0.99).alias("high")).first()
    parts = rows.mapInArrow(_cut(dims, spread["low"] or 0.0, spread["high"] or 0.0), _POINTS)
    order = ["part", "key", "row"]
    blocks = parts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks(dims), _BLOCKS)
    blocks = stage.keep(blocks, "blocks")
    books = _first_entries(rows, width)
    for _ in range(rounds):
        books = _moved(blocks, books, width)
    assigned = blocks.mapInArrow(_assign(books, width), _CODES)
    codes = assigned.groupBy("row").agg(
        F.max("vec_id").alias("vec_id"),
        F.max("label").alias("label"),
        F.lpad(F.lower(F.hex(F.bit_or("code"))), 2 * PARTS, "0").alias("code"),
        F.sum("error").alias("error"),
    )
    return codes.select("vec_id", "label", "code", "error"), books


def with_label_errors(codes: DataFrame, stage: Stage) -> DataFrame:
    """Add the error summed over the rows with the same label, NULL labels together.

    Sums are partial before their shuffle. The few rows of labels come back by a join that the adaptive planner
    broadcasts if their measured size allows, and whose hot keys it splits if not.
    """
    codes = stage.keep(codes, "codes")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long")
    sums = codes.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
