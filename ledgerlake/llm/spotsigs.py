"""SpotSigs document fingerprints, in SQL functions only.

A spot signature is a common word (the anchor) with the two content words that follow it; common words in
between are passed over.  A fingerprint is the set of the 64-bit hashes of a text's signatures.  Sets are compared by
Jaccard similarity.  With a ``least`` they are pruned by length first: sets are partitioned by their size such that
sets of a similarity of ``least`` or more lie in the same or in neighbouring partitions, and within those the smaller
size over the larger bounds the similarity; a pruned pair has a likeness below ``least`` and gets 0.

Words are runs of letters and digits in lower case.  A text without a whole chain has each word with the two after it
(as far as there are) for signatures instead, one without words but not empty the hash of itself.  NULL texts count as
empty; the empty text alone has the empty fingerprint, so likeness 1 never comes of a lack of signatures.  Repeated
rows have the same fingerprint.
In the order of documents NULL ids come last and repeated ids follow the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ROW, numbered, whole_text
from ledgerlake.operators.keys import dense_key
from ledgerlake.sinks.stage import Stage

# Common words of English, German, Spanish and French.
COMMON = (
    "the a an of to and in is it that was for on with as by at be this are or from not "
    "der die das und ein eine den dem des ist mit von zu auf sich für im auch "
    "el la los las de que y en un una es por con para del se no lo "
    "le les et des une du est dans pour sur ce il elle au ne pas"
).split()

_COMMON = "(?:" + "|".join(sorted(set(COMMON))) + ")"
# A run of anchors (group 1), and seen but not consumed the two content words behind it with any common words
# between them (group 2, empty where the text ends before).  Runs are consumed whole, so the time is linear.
_CHAIN = f" ((?:{_COMMON} )++)(?:(?=([^ ]++ (?:{_COMMON} )*+[^ ]++) )|)"
# Without anchors: each word with up to two after it, seen but not consumed.
_WORDS = " (?=([^ ]++(?: [^ ]++){0,2}+) )"


def with_signatures(frame: DataFrame, sets: dict[str, str]) -> DataFrame:
    """Adds the sorted set of signature hashes of text columns; ``sets`` maps new columns to text columns.

    Anchors of one run share their content words.  What is found is kept in columns of its own, so that each
    search runs once per text.
    """
    words = {
        name: F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
        for name, text in sets.items()
    }
    normal = frame.withColumns({f"_w_{n}": w for n, w in words.items()})
    found = normal.withColumns(
        {f"_{g}_{n}": F.regexp_extract_all(f"_w_{n}", F.lit(_CHAIN), F.lit(i)) for n in sets for i, g in ((1, "run"), (2, "tail"))}
    )

    def chains(run: Column, tail: Column) -> Column:
        first, second = F.substring_index(tail, " ", 1), F.substring_index(tail, " ", -1)
        own = F.transform(F.array_distinct(F.split(F.trim(run), " ")), lambda anchor: F.xxhash64(anchor, first, second))
        return F.when(tail != "", own).otherwise(F.array().cast("array<bigint>"))

    def hashes(name: str) -> Column:
        own = F.flatten(F.zip_with(f"_run_{name}", f"_tail_{name}", chains))
        plain = F.transform(F.regexp_extract_all(f"_w_{name}", F.lit(_WORDS), F.lit(1)), lambda w: F.xxhash64(w))
        found = (
            F.when(F.exists(f"_tail_{name}", lambda tail: tail != ""), own)
            .when(F.trim(f"_w_{name}") != "", plain)
            .when(F.col(sets[name]) != "", F.array(F.xxhash64(sets[name])))
            .otherwise(F.array().cast("array<bigint>"))
        )
        return F.sort_array(F.array_distinct(found))

    return found.withColumns({n: hashes(n) for n in sets}).drop(*[f"_{g}_{n}" for n in sets for g in ("w", "run", "tail")])


def as_text(fingerprint: Column) -> Column:
    return F.array_join(fingerprint.cast("array<string>"), " ")


def length_partition(size: Column, least: float) -> Column:
    """Partition of a set size: a similarity of ``least`` needs the same partition or the next one."""
    return F.floor(F.log(F.greatest(size, F.lit(1))) / F.log(F.lit(1 / least))).cast("int")


def likeness(a: Column, b: Column, least: float | None = None) -> Column:
    """Jaccard similarity of two sets; with ``least``, 0 where their lengths alone put it below that."""
    m, n = F.size(a), F.size(b)
    common = F.size(F.array_intersect(a, b))
    exact = F.when((m == 0) & (n == 0), 1.0).otherwise(common / (m + n - common))
    if least is None:
        return exact
    far = F.abs(length_partition(m, least) - length_partition(n, least)) > 1
    return F.when(far | (F.least(m, n) < F.lit(least) * F.greatest(m, n)), 0.0).otherwise(exact)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row."""
    own = docs.select("doc_id", whole_text().alias("text"))
    return with_signatures(own, {"fingerprint": "text"}).select("doc_id", "fingerprint")


def _rows(docs: DataFrame, stage: Stage) -> DataFrame:
    text = whole_text()
    return numbered(docs, stage).select(
        F.col(ROW).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")
    )


def successors(rows: DataFrame, stage: Stage) -> DataFrame:
    """``row, previous, need``: the row before each row by descending id, and half that row's characters.

    The first row follows the last one.  Only ids and lengths are ranked, never texts.
    """
    light = stage.keep(rows.select("row", "doc_id", F.length("text").cast("long").alias("n_chars")), "lengths")
    ranked = stage.keep(dense_key(light, [F.col("doc_id").desc_nulls_last(), F.col("row")], "rank", stage), "ranked")
    total = light.count()
    after = F.when(F.col("rank") == total, 1).otherwise(F.col("rank") + 1)
    before = ranked.select(F.col("row").alias("previous"), F.floor(F.col("n_chars") / 2).cast("int").alias("need"), after.alias("rank"))
    return ranked.select("row", "rank").join(before, "rank").select("row", "previous", "need")


def edited_and_next(docs: DataFrame, stage: Stage, least: float | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited form, compared with each other and with the next document's.

    In the edited form the second half of a text is replaced by as much of the next document's beginning.
    Each text goes over the network once as itself and, cut to what is needed, once to its predecessor.
    """
    rows = _rows(docs, stage)
    marked = rows.join(stage.keep(successors(rows, stage), "successors"), "row")
    given = with_signatures(marked, {"next_set": "text"}).select(
        F.col("previous").alias("row"), F.col("doc_id").alias("next_id"), "next_set",
        F.substring("text", F.lit(1), F.col("need")).alias("filler"),
    )
    kept = F.length("text") - F.floor(F.length("text") / 2).cast("int")
    both = rows.join(given, "row").withColumn("edited", F.concat(F.substring("text", F.lit(1), kept), "filler"))
    sets = with_signatures(both, {"own_set": "text", "edited_set": "edited"})
    return sets.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own_set")).alias("fingerprint"),
        as_text(F.col("edited_set")).alias("edited_fingerprint"),
        likeness(F.col("own_set"), F.col("edited_set"), least).alias("near_edited"),
        likeness(F.col("own_set"), F.col("next_set"), least).alias("near_next"),
        "next_id",
    )
