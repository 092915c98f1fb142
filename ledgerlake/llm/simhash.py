"""SimHash near-duplicates, found with BK-trees.

A BK-tree hangs every fingerprint below its parent on an edge that is labelled with their integer Hamming
distance; a search of radius r at distance d from a node follows only the edges d - r to d + r.

*Links of fingerprints* (``linked``): fingerprints are dealt to shards so that any two within the radius of 2
meet in one: the 64 bits are cut into four blocks, two of which must agree, which gives six shards per
fingerprint.  Only distinct fingerprints are dealt.  A shard with more than ``SHARD_MAX`` of them is cut again by
three of five pieces of its free bits, ten sub-shards, after which at most 2**14 can meet.  Each task builds
the trees of its shards and searches them; it gives a spanning forest of the links of a shard instead of all
pairs.  The trees are not broadcast: they hold the fingerprints of all documents, which have no proven bound.

*One document of each group* (``one_of_each``): the document with the smallest id of every component stays.

Texts: A-Z is lower-cased, words are runs without ASCII white space, NULL counts as empty.  A text with fewer
words than a shingle has is one shingle; one without words has fingerprint zero and links like any other.
Repeated rows are copies like any others.  Rows with a NULL document id take part, but never name a
component that has an id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import documents, partitions, whole_text
from ledgerlake.llm.components import components
from ledgerlake.sinks.stage import Stage

SEED = 42
SHARD_MAX = 4096


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each shingle of a text, repeats included."""
    found = text.encode("utf-8", "replace").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    last = ends[words - 1 :] if len(found) >= words else ends[-1:]
    bounds = zip(starts[:n].tolist(), last.tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in bounds), dtype=np.uint64, count=n)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes, as a signed 64-bit number."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):  # long texts in pieces
        part = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def fingerprints(words: int):
    """A column function: text to fingerprint."""

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(shingle_hashes(t or "", words)) for t in texts], dtype="int64")

    return of


def as_hex(column: str) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")


class BkTree:
    """Fingerprints by Hamming distance to their parents."""

    def __init__(self) -> None:
        self._root: list | None = None

    def near(self, value: int, radius: int) -> Iterator[tuple[int, int]]:
        """``distance, payload`` of everything within the radius."""
        stack = [self._root] if self._root else []
        while stack:
            own, payload, children = stack.pop()
            distance = (own ^ value).bit_count()
            if distance <= radius:
                yield distance, payload
            for edge in range(max(0, distance - radius), distance + radius + 1):
                if edge in children:
                    stack.append(children[edge])

    def add(self, value: int, payload: int) -> None:
        """Equal values hang below each other on edges of length zero."""
        node, leaf = self._root, [value, payload, {}]
        if node is None:
            self._root = leaf
            return
        while True:
            edge = (node[0] ^ value).bit_count()
            if edge not in node[2]:
                node[2][edge] = leaf
                return
            node = node[2][edge]


class Sets:
    """Union-find over the members of one shard."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)
        return i != j


_ALL = (1 << 64) - 1


def forest(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links within the radius that connect all linked members of a shard, as positions."""
    tree, sets = BkTree(), Sets(len(values))
    for i, value in enumerate(values):
        unsigned = value & _ALL
        for _, j in tree.near(unsigned, radius):
            if sets.join(i, j):
                yield i, j
        tree.add(unsigned, i)


def _sorted_groups(batches: Iterable[pa.RecordBatch], key: str, columns: list[str]) -> Iterator[tuple[object, list[tuple]]]:
    """Runs of equal keys in a sorted stream of batches."""
    rows = (row for b in batches for row in zip(b.column(key).to_pylist(), *(b.column(c).to_pylist() for c in columns)))
    for value, group in groupby(rows, key=lambda r: r[0]):
        yield value, [r[1:] for r in group]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _search_shards(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for _, rows in _sorted_groups(batches, "shard", ["fp"]):
            if len(rows) > 1:
                values = [r[0] for r in rows]
                found += [(values[i], values[j]) for i, j in forest(values, radius)]
            if len(found) > 10_000:
                yield _batch(found, _PAIR)
                found = []
        yield _batch(found, _PAIR)

    return run


def _bits(column: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(column, at).bitwiseAND((1 << width) - 1)


# Blocks as (lowest bit, width).
_BLOCKS = [(0, 16), (16, 16), (32, 16), (48, 16)]


def _shards(nodes: DataFrame) -> DataFrame:
    """``fp, table, shard`` of distinct fingerprints: six shards each, or ten times that where a shard is crowded."""
    fp = F.col("fp")
    first = nodes.select(
        "fp",
        F.posexplode(F.array(*[F.shiftleft(_bits(fp, *a), 16).bitwiseOR(_bits(fp, *b)) for a, b in combinations(_BLOCKS, 2)])).alias("table", "agreed"),
    )
    crowded = first.groupBy("table", "agreed").count().where(F.col("count") > SHARD_MAX).select("table", "agreed", F.lit(True).alias("crowded"))
    marked = first.join(crowded, ["table", "agreed"], "left")
    free: Column | None = None  # the 32 bits that the shard leaves open
    for table, (a, b) in enumerate(combinations(_BLOCKS, 2)):
        rest = [x for x in _BLOCKS if x not in (a, b)]
        bits = F.shiftleft(_bits(fp, *rest[0]), 16).bitwiseOR(_bits(fp, *rest[1]))
        free = F.when(F.col("table") == table, bits) if free is None else free.when(F.col("table") == table, bits)
    pieces = [(0, 6), (6, 6), (12, 6), (18, 7), (25, 7)]
    sub = [
        F.concat_ws("/", F.lit(str(n)), *[_bits(F.col("free"), *p).cast("string") for p in three])
        for n, three in enumerate(combinations(pieces, 3))
    ]
    split = F.explode(F.when(F.col("crowded"), F.array(*sub)).otherwise(F.array(F.lit("")))).alias("sub")
    return marked.withColumn("free", free).select("fp", "table", "agreed", split).select("fp", F.xxhash64("table", "agreed", "sub").alias("shard"))


def linked(prints: DataFrame, stage: Stage, radius: int = 2) -> DataFrame:
    """``fp, component_id`` of distinct fingerprints: the smallest document id reachable over links.

    ``prints`` holds ``doc_id, fp``; the radius is 2 at most, which is what the shards are made for.
    """
    if not 0 <= radius <= 2:
        raise ValueError("two of four blocks agree for a radius of 2 at most")
    nodes = stage.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "nodes")
    dealt = _shards(nodes.select("fp")).repartition(partitions(prints.sparkSession), "shard").sortWithinPartitions("shard", "fp")
    joined = components(dealt.mapInArrow(_search_shards(radius), "a long, b long"), stage).withColumnRenamed("node", "fp")
    named = nodes.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = stage.keep(named, "named")
    # Most components are one fingerprint; the minimum is partial before its shuffle.
    lowest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(lowest, "component").select("fp", "component_id")


def classes(docs: DataFrame, stage: Stage, words: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``."""
    prints = stage.keep(documents(docs).select("doc_id", fingerprints(words)("text").alias("fp")), "prints")
    return prints.join(linked(prints, stage, radius), "fp").select("doc_id", as_hex("fp").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, stage: Stage, words: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` without those whose component has a document with a smaller id.

    Rows without an id cannot be told apart; they stay. Rows that repeat an id stay or go by their own text: equal ones
    together.
    """
    text = whole_text()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_text"))
    prints = stage.keep(rows.select("doc_id", "_text", fingerprints(words)("text").alias("fp")), "prints")
    found = prints.join(linked(prints, stage, radius), "fp").where("doc_id <> component_id")
    dropped = stage.keep(found.select(F.col("doc_id").alias("_dropped"), "_text").distinct(), "dropped")
    # Lists of ids grow with the corpus: the join that brings them to the texts never broadcasts them.
    same = (docs["doc_id"] == dropped["_dropped"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == dropped["_text"])
    return docs.join(dropped.hint("merge"), same, "left_anti")
