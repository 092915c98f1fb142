"""Exact top-k search by inner product: branch and bound over columns.

Vectors become integers. A task holds one block of queries and streams candidates past it in blocks that are laid
out vertically, one row per dimension. Products are summed dimension block by dimension block, those in which the
queries have most mass first. After each, what the other dimensions can still add is bounded by the masses that
remain on both sides (Cauchy-Schwarz), and candidates that cannot reach a query's k-th score any more are dropped:
first by masks over the dense block, and once few are left by compacting them to a list of pairs.

Distribution. Equal vectors are searched once: of each, the ``k + 1`` smallest ids stand for all, which is exact, as
ties go to the smaller id and a query leaves out one row, its own. So neither many copies of a candidate nor of a
query cost more than one. Queries are cut into blocks of about ``QUERY_BLOCK``; candidates are dealt by hash over
ranges, and each (query block, range) is one task whose memory holds the query block and ``BLOCK`` candidates, however
many there are. Ranges are as many as tasks are wanted, so what tasks return is small beside what they read.

Defined results. Vectors that are NULL or hold a NULL or non-finite component, and rows without ``vec_id``, take no
part. Short vectors count as filled up with zeros, so all scores with an empty vector are 0. Integer components are
held within the largest value whose scores surely fit a long (379,625,062 for 64 components). Every row is a query or
candidate of its own, rows that repeat a ``vec_id`` included. Ties go to the smaller id. An empty table, or one with
a single row, gives no rows. Columns other than ``vec_id`` and the vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import partitions
from ledgerlake.llm.vectors import floored, matrix, usable
from ledgerlake.sinks.stage import Stage

QUERY_BLOCK = 1 << 15  # queries of a task
RANGE_LEAST = 1 << 13  # candidates that are worth a task
BLOCK = 1 << 12  # candidates in one vertical block
TILE = 64  # queries measured at a time
STEP = 16  # dimensions of a dimension block
SPARSE = 1 / 8  # share of surviving pairs below which they are compacted

_LEAST = np.iinfo(np.int64).min
_LAST = np.iinfo(np.int64).max
_FOUND = "vec array<double>, best array<struct<down: bigint, vec_id: bigint>>"


class Block:
    """Candidates side by side: ``columns`` has one row per dimension, ``mass`` the roots of what follows each step."""

    def __init__(self, vectors: np.ndarray, ids: pa.ListArray, order: np.ndarray, steps: list[tuple[int, int]]) -> None:
        self.columns = np.ascontiguousarray(vectors[:, order].T)
        self.mass = _roots(self.columns, steps)
        offsets = np.asarray(ids.offsets)
        self.ids, self.first, self.count = np.asarray(ids.values), offsets[:-1], np.diff(offsets)


def _roots(columns: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Per step the root of the squares of the dimensions after it, rounded up."""
    squares = columns.astype(np.float64) ** 2
    return np.array([np.sqrt(squares[end:].sum(axis=0)) for _, end in steps]).reshape(len(steps), columns.shape[1]) * (1 + 1e-9)


class Search:
    """The best ``depth`` candidates so far of each query of a block."""

    def __init__(self, queries: np.ndarray, depth: int, kind: type) -> None:
        n, dims = queries.shape
        self.depth, self.kind = depth, kind
        self.order = np.argsort(-(queries.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.steps = [(a, min(a + STEP, dims)) for a in range(0, dims, STEP)]
        self.columns = np.ascontiguousarray(queries[:, self.order].T.astype(kind))
        self.mass = _roots(self.columns, self.steps)
        self.scores = np.full((n, depth), _LEAST, dtype=np.int64)
        self.ids = np.full((n, depth), _LAST, dtype=np.int64)
        self.filled = np.zeros(n, dtype=np.int64)

    def take(self, vectors: np.ndarray, ids: pa.ListArray) -> None:
        """Measure all queries against one more block of candidates."""
        block = Block(vectors.astype(self.kind), ids, self.order, self.steps)
        for at in range(0, self.columns.shape[1], TILE):
            self._keep(at, block, *self._reach(at, block))

    def _slack(self, partial: np.ndarray) -> np.ndarray | float:
        """What comparing as doubles may be wrong by; integers below 2**53 are exact."""
        return 1.0 if self.kind is np.float64 else 1.0 + np.abs(partial.astype(np.float64)) * 1e-12

    def _reach(self, at: int, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (query in tile, candidate, score) that reach the query's last place."""
        tile = self.columns[:, at : at + TILE]
        mass = self.mass[:, at : at + TILE]
        last = self.scores[at : at + TILE, -1].astype(np.float64)
        partial = np.zeros((tile.shape[1], block.columns.shape[1]), dtype=self.kind)
        alive = np.ones(partial.shape, dtype=bool)
        for step, (a, b) in enumerate(self.steps):
            partial += tile[a:b].T @ block.columns[a:b]
            rest = np.outer(mass[step], block.mass[step])
            slack = self._slack(partial)
            if partial.shape[1] >= self.depth and (last == _LEAST).any():
                # So many candidates surely reach this score, so the last place does.
                sure = np.partition(partial - rest, -self.depth, axis=1)[:, -self.depth]
                last = np.maximum(last, sure - np.max(slack))
            alive = partial + rest + slack >= last[:, None]
            if alive.mean() < SPARSE and b < tile.shape[0]:
                return self._compacted(step + 1, tile, mass, block, partial, alive, last)
        query, candidate = np.nonzero(alive)
        return query, candidate, partial[query, candidate]

    def _compacted(self, step: int, tile, mass, block: Block, partial, alive, last):
        query, candidate = np.nonzero(alive)
        score = partial[query, candidate]
        for n in range(step, len(self.steps)):
            a, b = self.steps[n]
            score = score + np.einsum("ij,ij->j", tile[a:b, query], block.columns[a:b, candidate])
            reach = score + mass[n, query] * block.mass[n, candidate] + self._slack(score) >= last[query]
            query, candidate, score = query[reach], candidate[reach], score[reach]
        return query, candidate, score

    def _keep(self, at: int, block: Block, query: np.ndarray, candidate: np.ndarray, score: np.ndarray) -> None:
        """Merge pairs into the best; a candidate counts once per id."""
        reach = score.astype(np.int64) >= self.scores[at + query, -1]
        query, candidate, score = query[reach], candidate[reach], score[reach].astype(np.int64)
        if not len(query):
            return
        times = block.count[candidate]
        ends = np.cumsum(times)
        place = np.arange(ends[-1]) - np.repeat(ends - times, times) + np.repeat(block.first[candidate], times)
        touched, query = np.unique(np.repeat(query, times), return_inverse=True)
        added = np.bincount(query, minlength=len(touched))
        rows = at + touched
        who = np.concatenate([query, np.repeat(np.arange(len(touched)), self.depth)])
        scores = np.concatenate([np.repeat(score, times), self.scores[rows].ravel()])
        ids = np.concatenate([block.ids[place], self.ids[rows].ravel()])
        order = np.lexsort((ids, ~scores, who))
        who, scores, ids = who[order], scores[order], ids[order]
        sizes = added + self.depth
        rank = np.arange(len(who)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        top = rank < self.depth
        self.scores[rows] = scores[top].reshape(-1, self.depth)
        self.ids[rows] = ids[top].reshape(-1, self.depth)
        self.filled[rows] = np.minimum(self.depth, self.filled[rows] + added)

    def found(self, start: int, end: int) -> pa.ListArray:
        """The best of some queries, as lists of (negated score, id)."""
        there = np.arange(self.depth) < self.filled[start:end, None]
        offsets = np.concatenate([[0], np.cumsum(self.filled[start:end])])
        entries = pa.StructArray.from_arrays(
            [pa.array(-self.scores[start:end][there]), pa.array(self.ids[start:end][there])], ["down", "vec_id"]
        )
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)


def _searching(dims: int, depth: int, kind: type):
    """Rows of one task, queries first, to the best candidates of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: list[np.ndarray] = []
        search, waiting, held = None, [], 0
        for batch in batches:
            split = int(np.count_nonzero(np.asarray(batch["kind"]) == 0))
            vectors = matrix(batch["vec"], dims)
            if split:
                queries.append(vectors[:split].copy())
            if split == batch.num_rows or not queries:
                continue
            search = search or Search(np.concatenate(queries), depth, kind)
            waiting.append((vectors[split:], batch["ids"].slice(split)))
            held += batch.num_rows - split
            if held >= BLOCK:
                search.take(*_joined(waiting))
                waiting, held = [], 0
        if search is None:
            return
        if waiting:
            search.take(*_joined(waiting))
        asked = np.concatenate(queries)
        for start in range(0, len(asked), BLOCK):
            part = asked[start : start + BLOCK]
            offsets = pa.array(np.arange(len(part) + 1) * dims, pa.int32())
            vec = pa.ListArray.from_arrays(offsets, pa.array(part.ravel()))
            yield pa.RecordBatch.from_arrays([vec, search.found(start, start + len(part))], ["vec", "best"])

    return run


def _joined(waiting: list[tuple[np.ndarray, pa.Array]]) -> tuple[np.ndarray, pa.ListArray]:
    ids = pa.concat_arrays([ids for _, ids in waiting])
    return np.concatenate([v for v, _ in waiting]), ids


def _copies(vectors: DataFrame, most: int) -> DataFrame:
    """``vec, ids``: each distinct vector with its ``most`` smallest ids.

    The rank limit applies before the shuffle too, so a task sends at most ``most`` rows of a vector.
    """
    place = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = vectors.withColumn("_place", place).where(F.col("_place") <= most)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def top(
    table: DataFrame,
    is_query: Column,
    stage: Stage,
    k: int = 20,
    scale: int = 64,
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of each row for which ``is_query`` holds."""
    spark = table.sparkSession
    rows = table.where(F.col("vec_id").isNotNull() & usable(vector))
    # ``is_query`` may name columns that the search itself does not carry.
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("_v"), F.coalesce(is_query, F.lit(False)).alias("_asks"))
    found = rows.agg(F.max(F.size("_v")).alias("dims"), F.max(F.greatest(F.abs(F.array_max("_v")), F.abs(F.array_min("_v")))).alias("peak")).first()
    dims, peak = found["dims"] or 0, float(found["peak"] or 0.0)
    limit = math.isqrt(((1 << 63) - 1) // max(dims, 1))
    top_value = min(limit, int(min(peak * scale, 1e18)) + 1)
    kind = np.float64 if top_value**2 * dims < 1 << 52 else np.int64
    rows = rows.select("vec_id", "_asks", floored("_v", scale, dims, limit).alias("vec"))
    depth = k + 1
    asking = rows.where("_asks").select("vec_id", "vec")
    candidates = stage.keep(_copies(rows.select("vec_id", "vec"), depth), "candidates")
    queries = stage.keep(asking.select("vec").distinct(), "queries")

    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    wanted = -(-partitions(spark) // blocks)
    ranges = max(1, min(wanted, -(-candidates.count() // RANGE_LEAST)))
    hashed = F.xxhash64("vec")

    def over(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    asked = queries.select(F.lit(0).alias("kind"), "vec", F.lit(None).cast("array<bigint>").alias("ids"), F.pmod(hashed, F.lit(blocks)).alias("_block"), over(ranges).alias("_range"))
    offered = candidates.select(F.lit(1).alias("kind"), "vec", "ids", over(blocks).alias("_block"), F.pmod(hashed, F.lit(ranges)).alias("_range"))
    cells = asked.unionByName(offered).withColumn("task", (F.col("_block") * ranges + F.col("_range")).cast("int"))
    tasks = cells.select("task", "kind", "vec", "ids").repartitionById(blocks * ranges, "task").sortWithinPartitions("kind")
    best = tasks.mapInArrow(_searching(dims, depth, kind), _FOUND)

    merged = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, depth)
    best = best.groupBy("vec").agg(merged.alias("best"))
    long_vec = F.transform("vec", lambda x: x.cast("long"))
    own = F.struct((-F.aggregate(long_vec, F.lit(0).cast("long"), lambda s, x: s + x * x)).alias("down"), F.col("vec_id"))
    at = F.array_position("best", own).cast("int")
    others = F.when(at > 0, F.concat(F.slice("best", F.lit(1), at - 1), F.slice("best", at + 1, F.lit(depth)))).otherwise(F.col("best"))
    listed = asking.join(best, "vec").select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("_at", "_hit"))
    return listed.select("query_id", (F.col("_at") + 1).alias("rank"), F.col("_hit.vec_id").alias("vec_id"), (-F.col("_hit.down")).alias("score"))
