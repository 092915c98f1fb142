"""Source divergence audit: how far the term frequencies of sources lie apart, within each language.

Terms are runs of letters: ASCII letters, lower-cased, and all characters beyond ASCII. Each language keeps the terms
that occur in at least ``least_docs`` of its documents. A (language, source) group, and a language, gives a kept term
the frequency ``p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))``.

Distance of two sources, summed over all kept terms: the cube of (source block, source block, term block) is cut into
cells, one task each. A slice of frequencies (the terms of one term block that occur in the sources of one source
block) is replicated to the cells of its two edges, so a cell holds two slices of at most about ``GROUP_BLOCK`` x
``TERM_BLOCK`` numbers, however many sources, terms or documents there are. A cell gives partial sums for its pairs of
sources; these are added up along the term axis. A term that occurs in neither block's sources has the frequency of a
zero count in all of them, so cells report how many terms they covered and the rest is added by arithmetic.

Counting is done in the tasks that read the documents, by dictionaries that are handed on when they are full, so a
frequent term costs one row per task. Frequencies are exact integers, divided as decimals.

Defined results. A NULL text, language or source is empty. Every (language, source) that occurs is a group, also
without terms; its pairs count. Without kept terms all distances are 0. A language with one source has no pairs.
Rows that repeat a ``doc_id`` are documents of their own. Equal values rank by the item's bytes. An empty table gives
no rows. Columns other than ``text``, ``lang`` and ``source`` are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import whole_text
from ledgerlake.sinks.stage import Stage

SCALE = 1_000_000_000
PRIOR = 5
LEAST_DOCS = 30
TOP_TERMS = 50
GROUP_BLOCK = 32  # sources along an edge of a cell, about
TERM_BLOCK = 1 << 11  # terms along the third edge, about
HELD = 1 << 18  # terms a task counts before it hands the counts on

# All that is no part of a term becomes a blank; A-Z become a-z.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_COUNTS = "lang string, source string, term string, n long, docs long"
_CELLS = "lang string, a string, b string, apart long, covered long, a_zero long, b_zero long, terms long"


def terms(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8. No byte of a character beyond ASCII is an ASCII byte, so bytes can be split."""
    return text.translate(_LETTERS).split()


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to counts of terms and of the documents that hold them, per language and source."""
    counts: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
    held = 0
    for batch in batches:
        langs, sources, texts = (batch[c].cast(pa.binary()).to_pylist() for c in ("lang", "source", "text"))
        for lang, source, text in zip(langs, sources, texts):
            found = counts.get((lang, source))
            if found is None:
                found = counts[lang, source] = (Counter(), Counter())
            n, docs = found
            before = len(n)
            here = Counter(terms(text))
            n.update(here)
            docs.update(here.keys())
            held += len(n) - before
            if held >= HELD:
                yield from _handed_on(counts)
                counts, held = {}, 0
    yield from _handed_on(counts)


def _handed_on(counts: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in counts.items():
        # A group without terms is one row without a term, so that it is known to occur.
        words = list(n) or [None]
        for start in range(0, len(words), 1 << 14):
            part = words[start : start + (1 << 14)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(part), pa.binary()).cast(pa.string()),
                    pa.array([source] * len(part), pa.binary()).cast(pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array([n.get(w, 0) for w in part], pa.int64()),
                    pa.array([docs.get(w, 0) for w in part], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )


def _frequency(count: Column, total: Column, kept: Column) -> Column:
    """The frequency of a term, in exact integers."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + F.lit(PRIOR)).cast("decimal(20,0)")
    below = (total + F.lit(PRIOR) * kept).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, below)


def _cell(rows: pa.Table) -> pa.Table:
    """Partial distances between the sources of two blocks over one block of terms.

    Rows without a term name the sources of the two edges with their frequency at count 0.
    """
    header = rows.filter(rows["term"].is_null())
    values = rows.filter(rows["term"].is_valid())
    edges = []
    names, number = np.unique(np.array(values["term"].to_pylist(), dtype=object), return_inverse=True)
    where = np.asarray(values["edge"])
    for edge in (0, 1):
        mine = header.filter(pc.equal(header["edge"], edge))
        sources = mine["source"].to_pylist()
        zero = np.asarray(mine["zero"], dtype=np.int64)
        place = {s: i for i, s in enumerate(sources)}
        table = np.repeat(zero[:, None], len(names), axis=1)
        picked = where == edge
        rows_of = np.fromiter((place[s] for s in values["source"].filter(pa.array(picked)).to_pylist()), dtype=np.int64, count=int(picked.sum()))
        table[rows_of, number[picked]] = np.asarray(values["p"], dtype=np.int64)[picked]
        edges.append((sources, zero, table))
    (left, left_zero, a), (right, right_zero, b) = edges
    out: dict[str, list] = {c: [] for c in ("a", "b", "apart", "a_zero", "b_zero")}
    diagonal = rows["first"][0].as_py() == rows["second"][0].as_py()
    for i, source in enumerate(left):
        apart = np.abs(b - a[i]).sum(axis=1)
        # On the diagonal both edges are the same block: each pair once.
        for j in (j for j in range(len(right)) if not diagonal or source < right[j]):
            for column, value in zip(out, (source, right[j], int(apart[j]), int(left_zero[i]), int(right_zero[j]))):
                out[column].append(value)
    n = len(out["a"])
    return pa.table(
        {
            "lang": pa.array([rows["lang"][0].as_py()] * n, pa.string()),
            "a": pa.array(out["a"], pa.string()),
            "b": pa.array(out["b"], pa.string()),
            "apart": pa.array(out["apart"], pa.int64()),
            "covered": pa.array([len(names)] * n, pa.int64()),
            "a_zero": pa.array(out["a_zero"], pa.int64()),
            "b_zero": pa.array(out["b_zero"], pa.int64()),
            "terms": pa.array([header["kept"][0].as_py()] * n, pa.int64()),
        }
    )


def _edges(rows: DataFrame) -> DataFrame:
    """Each row once for every cell that its source block is an edge of: as first edge, as second, or as both."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    rows = rows.select("*", other)
    first, second = F.least("block", "other"), F.greatest("block", "other")
    both = F.array(F.lit(0), F.lit(1))
    edge = F.when(F.col("block") == F.col("other"), both).when(F.col("block") < F.col("other"), F.array(F.lit(0))).otherwise(F.array(F.lit(1)))
    return rows.select("lang", "source", "slab", "term", "p", "zero", "kept", first.alias("first"), second.alias("second"), F.explode(edge).alias("edge"))


def _distances(rates: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value`` for every pair of sources of a language, ``a`` before ``b`` or after it."""
    block = F.pmod(F.xxhash64("source"), F.col("blocks"))
    heads = groups.select(
        "lang", "source", "blocks", "zero", "kept", block.alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slabs") - 1)).alias("slab"),
        F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"),
    )
    values = rates.select(
        "lang", "source", "blocks", F.lit(None).cast("long").alias("zero"), F.lit(None).cast("long").alias("kept"),
        block.alias("block"), F.pmod(F.xxhash64("term"), F.col("slabs")).alias("slab"), "term", "p",
    )
    cells = _edges(heads.unionByName(values)).groupBy("lang", "first", "second", "slab").applyInArrow(_cell, _CELLS)
    sums = cells.groupBy("lang", "a", "b").agg(
        F.sum("apart").alias("apart"), F.sum("covered").alias("covered"), *(F.first(c).alias(c) for c in ("a_zero", "b_zero", "terms"))
    )
    rest = (F.col("terms") - F.col("covered")) * F.abs(F.col("a_zero") - F.col("b_zero"))
    return sums.select("lang", "a", "b", (F.col("apart") + rest).alias("value"))


def audit(docs: DataFrame, stage: Stage, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances to other sources, and terms above the language's frequency."""
    read = docs.select(whole_text().alias("text"), whole_text("lang").alias("lang"), whole_text("source").alias("source"))
    counts = read.mapInArrow(_counting, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = stage.keep(counts, "counts")
    words = counts.where(F.col("term").isNotNull())
    kept = words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = stage.keep(kept.select("lang", "term", "lang_n"), "kept")
    rows = stage.keep(words.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "rows")

    # One row per language, and one per (language, source).
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    occurring = counts.select("lang", "source").distinct()
    sizes = occurring.groupBy("lang").agg(F.ceil(F.count("*") / GROUP_BLOCK).cast("long").alias("blocks"))
    zero = F.when(F.col("kept") > 0, _frequency(F.lit(0), F.col("total"), F.col("kept"))).otherwise(0)
    groups = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang").na.fill(0, ["total", "kept", "lang_total"])
    slabs = F.greatest(F.lit(1), F.ceil(F.col("kept") / TERM_BLOCK)).cast("long")
    groups = stage.keep(groups.select("*", slabs.alias("slabs"), zero.cast("long").alias("zero")), "groups")
    rates = rows.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "blocks", "slabs",
        _frequency(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        _frequency(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    )

    apart = _distances(rates, groups)
    pairs = apart.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        apart.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    above = rates.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = pairs.select("*", F.lit("pair").alias("part"), rank.alias("rank")).unionByName(
        # The rank limit applies before the shuffle too, so a task sends no more than that of a source.
        above.select("*", F.lit("term").alias("part"), rank.alias("rank")).where(F.col("rank") <= top_terms)
    )
    return ranked.select("lang", "source", "part", "item", "value", "rank")
