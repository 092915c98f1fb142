"""Document quality by Bradley-Terry ranking.

Every pair of a good and a poor document is a preference: P(good beats poor) = sigmoid(w . (x_good - x_poor)).
The weights are fitted to such pairs by logistic loss on feature differences, so only differences of scores
mean anything; the cut comes afterwards, as a quantile of the scores of the fitted sample.  The score that is
returned is sigmoid(s - cut): 0.5 or more means the document is above the cut.

Features describe the whole text only (shape of words, symbols and lines); ids, source, language and labels
are no inputs.  NULL and empty texts get the features of an empty text and a score like any other.  Labels:
NULL ids or labels are left out, repeated labels of a document count as poor if any is poor, and of the texts of a
repeated id one is learned from.  Without both a
good and a poor labelled document nothing can be ranked, and every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import documents, lowest_hashes, whole_text

FIT_ROWS = 20_000  # labelled documents used for the fit at most; the bound of what the driver gets
FIT_PAIRS = 200_000
RIDGE = 1e-3

SATURATION = 0.02  # a share of this much counts as "present"
_BYTES = np.arange(256)
_CLASSES = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "lower": (_BYTES >= 97) & (_BYTES <= 122),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "space": np.isin(_BYTES, list(b" \t")),
    "line": _BYTES == 10,
    "stop": np.isin(_BYTES, list(b".,;:?'\"")),
    "bang": _BYTES == 33,
    "bar": _BYTES == 124,
    "mark": np.isin(_BYTES, list(b"#$%&*")),
    "other": np.isin(_BYTES, list(b"+-/<=>@[\\]^_`{}~()")),
    "high": _BYTES >= 128,
    "control": (_BYTES < 32) & (_BYTES != 10) & (_BYTES != 9) | (_BYTES == 127),
}
_MATRIX = np.array(list(_CLASSES.values()), dtype=np.float64).T
FEATURES = [
    *(f"{kind}_{name}" for kind in ("share", "some") for name in _CLASSES),
    "length", "word_length", "word_variety", "line_length", "line_repeats", "short_lines", "word_symbols",
]


def text_features(text: str) -> np.ndarray:
    """Numbers that describe one text; shares are per byte, per word or per line."""
    data = text.encode("utf-8", "replace")
    n = max(1, len(data))
    shares = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256) @ _MATRIX / n
    words = data.split()
    lines = [x for x in data.split(b"\n") if x]
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    rest = [
        np.log1p(len(data)) / 10,
        np.log1p(lengths.mean() if len(words) else 0),
        len(set(words)) / n_words,
        np.log1p(len(data) / n_lines) / 5,
        1 - len(set(lines)) / n_lines,
        sum(len(x) < 30 for x in lines) / n_lines,
        np.minimum(lengths, 2).mean() / 2 if len(words) else 0,
    ]
    return np.concatenate([shares, np.minimum(shares / SATURATION, 1), rest])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def features(texts: pd.Series) -> pd.Series:
    return pd.Series([text_features(t or "") for t in texts], dtype=object)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of all ids that is never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


@dataclass(frozen=True)
class Ranking:
    """A fitted scorer: ``weights`` on the raw features and the ``cut`` that maps to 0.5."""

    weights: np.ndarray
    cut: float


def fit(x: np.ndarray, good: np.ndarray, pairs: int = FIT_PAIRS, seed: int = 7) -> Ranking:
    """Weights from random preference pairs by Newton steps on the logistic loss, and the quantile cut."""
    if not good.any() or good.all():
        return Ranking(np.zeros(x.shape[1] if x.ndim == 2 else len(FEATURES)), 0.0)
    scale = x.std(axis=0)
    scale[scale < 1e-9] = np.inf  # a constant says nothing
    z = (x - x.mean(axis=0)) / scale
    draw = np.random.default_rng(seed)
    d = z[draw.choice(np.flatnonzero(good), pairs)] - z[draw.choice(np.flatnonzero(~good), pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        slope = d.T @ (p - 1) / pairs + RIDGE * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    weights = w / scale
    return Ranking(weights, cut_at_quantile(x @ weights, good))


def cut_at_quantile(scores: np.ndarray, good: np.ndarray) -> float:
    """The score quantile, among hundredths and the share of poor documents, with the fewest mistakes."""
    shares = np.append(np.arange(0.01, 1, 0.01), 1 - good.mean())
    cuts = np.quantile(scores, shares)
    balance = [((scores >= c) & good).sum() / good.sum() + ((scores < c) & ~good).sum() / (~good).sum() for c in cuts]
    best = np.flatnonzero(np.isclose(balance, max(balance)))
    return float(cuts[best[len(best) // 2]])


def learn(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Ranking:
    """Fit on at most ``rows`` labelled documents, taken by a hash of their id; held-out ids are left out."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out()
    )
    known = (
        lowest_hashes(usable, "doc_id", rows).groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    # Bounded by ``rows``, so it is sent to the documents instead of shuffling texts.
    sample = documents(docs).join(F.broadcast(known), "doc_id").select(
        "doc_id", F.struct(F.xxhash64("text").alias("text"), "quality", features("text").alias("x")).alias("one")
    )
    # One row of a repeated id, picked before the shuffle; at most ``rows`` ids.
    got = [r["one"] for r in sample.groupBy("doc_id").agg(F.min("one").alias("one")).orderBy("doc_id").collect()]
    if not got:
        return Ranking(np.zeros(len(FEATURES)), 0.0)
    return fit(np.array([r["x"] for r in got]), np.array([r["quality"] == 1 for r in got]))


def score(model: Ranking, text: Column) -> Column:
    """The score of a text column, from 0 to 1."""
    x = features(text)
    total = F.aggregate(
        F.zip_with(x, F.array(*[F.lit(float(w)) for w in model.weights]), lambda a, b: a * b),
        F.lit(-model.cut),
        lambda a, b: a + b,
    )
    return 1 / (1 + F.exp(-total))


def rated(docs: DataFrame, model: Ranking) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = documents(docs).select("doc_id", held_out().alias("held_out"), score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def kept(docs: DataFrame, model: Ranking) -> DataFrame:
    """The rows of ``docs`` whose text is at or above the cut, with all their columns."""
    return docs.where(score(model, whole_text()) >= 0.5)
