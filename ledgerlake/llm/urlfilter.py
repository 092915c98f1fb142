"""URL filter: fixed rules first, gradient-boosted trees on lexical features for the rest.

A rule is a host and a path prefix; it fits the host and its subdomains when the URL's path starts with the
prefix, and the longest fitting rule wins.  The trees learn from labelled URLs: lengths, depth, digit ratio,
character entropy, parameter counts and the share of blocked URLs per host suffix.

NULL URLs and URLs without ``://`` have an empty host and path; the trees still judge their characters.
Repeated URLs and ids are judged row by row; for the fit a repeated URL counts once.  With no labelled URLs, or labels of one kind only, there is
nothing to learn: the verdict is that kind, or "allow".
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import lowest_hashes
from ledgerlake.sinks.stage import Stage

ALLOW, BLOCK = "allow", "block"
FIT_ROWS = 20_000  # labelled URLs used for the fit at most, taken by a hash of the URL
TREES, DEPTH, SEED = 20, 4, 11
PRIOR = 20.0  # a suffix counts as if seen so many times more at the average rate


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a URL column."""
    whole = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.substring(whole, at + 3, F.length(whole))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The text of the longest rule that fits, else NULL."""
    found: Column | None = None
    for rule in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.text)) if found is None else found.when(fits, F.lit(rule.text))
    return F.lit(None).cast("string") if found is None else found


def parsed(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``page_id, url, host, path, rule`` and ``ruled``, the rule's verdict (NULL without one)."""
    host, path = host_and_path()
    split = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    named = split.withColumn("rule", longest_rule(rules, F.col("host"), F.col("path")))
    ruled: Column = F.lit(None).cast("string")
    for rule in rules:
        ruled = F.when(F.col("rule") == rule.text, F.lit(rule.verdict)).otherwise(ruled)
    return named.withColumn("ruled", ruled)


def _share(pattern: str, text: Column) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    """Bits per character of the first-order character distribution."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.greatest(F.size(chars), F.lit(1))
    shares = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
    return F.aggregate(shares, F.lit(0.0), lambda a, p: a - p * F.log2(p))


FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio", "entropy",
    "parameters", "hyphens", "marks", "longest_word", "suffix_rate",
)


def with_features(urls: DataFrame) -> DataFrame:
    """Adds the lexical features (all but the suffix statistics) and ``suffix``, the last label of the host."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    words = F.split(F.lower(url), r"[^\p{L}]+")
    return urls.withColumns(
        {
            "suffix": F.regexp_extract(host, r"[^.]*$", 0),
            "url_length": F.length(url).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "depth": F.regexp_count(path, F.lit("/[^/]")).cast("double"),
            "labels": F.regexp_count(host, F.lit(r"[^.]+")).cast("double"),
            "digit_ratio": _share("[0-9]", url),
            "host_digit_ratio": _share("[0-9]", host),
            "entropy": _entropy(url),
            "parameters": F.regexp_count(url, F.lit(r"[?&][^=&#]+=")).cast("double"),
            "hyphens": F.regexp_count(host, F.lit("-")).cast("double"),
            "marks": F.regexp_count(url, F.lit("[%_@~=+]")).cast("double"),
            "longest_word": F.array_max(F.transform(words, F.length)).cast("double"),
        }
    )


@dataclass(frozen=True)
class UrlModel:
    """Trees and the suffix statistics they were trained with, or the one verdict there was."""

    trees: GBTClassificationModel | None
    suffixes: DataFrame | None
    rate: float
    only: str


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="_features", handleInvalid="error")


def _with_rate(urls: DataFrame, suffixes: DataFrame, rate: float) -> DataFrame:
    joined = urls.join(suffixes, "suffix", "left")
    return joined.withColumn("suffix_rate", F.coalesce("suffix_rate", F.lit(rate)))


def learn(labelled: DataFrame, stage: Stage, rows: int = FIT_ROWS) -> UrlModel:
    """Fit on at most ``rows`` labelled URLs (``url, host, path, blocked`` with blocked 0 or 1)."""
    known = lowest_hashes(labelled.where(F.col("blocked").isNotNull()), "url", rows)
    # Copies go before the shuffle; what reaches the one task of the limit is little more than ``rows`` URLs.
    once = known.select("url", "host", "path", "blocked").distinct()
    sample = stage.keep(with_features(once.orderBy(F.xxhash64("url"), "url", "blocked").limit(rows)), "labelled")
    counts = sample.agg(F.count("*").alias("n"), F.coalesce(F.avg("blocked"), F.lit(0.0)).alias("rate")).first()
    rate = float(counts["rate"])
    if rate in (0.0, 1.0):
        return UrlModel(None, None, rate, BLOCK if rate else ALLOW)
    # No more suffixes than sampled URLs.
    suffixes = sample.groupBy("suffix").agg(
        ((F.sum("blocked") + PRIOR * rate) / (F.count("*") + PRIOR)).alias("suffix_rate")
    )
    ready = _assembler().transform(_with_rate(sample, suffixes, rate)).select("_features", F.col("blocked").cast("double"))
    trees = GBTClassifier(
        featuresCol="_features", labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, seed=SEED, maxBins=32
    ).fit(ready.coalesce(4))
    return UrlModel(trees, suffixes, rate, ALLOW)


def judged(urls: DataFrame, model: UrlModel) -> DataFrame:
    """Adds ``learned``, the model's verdict."""
    if model.trees is None:
        return urls.withColumn("learned", F.lit(model.only))
    ready = _assembler().transform(_with_rate(with_features(urls), model.suffixes, model.rate))
    return model.trees.transform(ready).select(*urls.columns, F.when(F.col("prediction") == 1, BLOCK).otherwise(ALLOW).alias("learned"))


def filtered(pages: DataFrame, rules: Sequence[Rule], stage: Stage, rows: int = FIT_ROWS) -> DataFrame:
    """``page_id, host, path, rule, verdict``: the rule's verdict, else that of trees trained on the ruled URLs."""
    urls = stage.keep(parsed(pages, rules), "urls")  # read for the fit and for the verdicts, without the pages
    model = learn(urls.withColumn("blocked", (F.col("ruled") == BLOCK).cast("int")), stage, rows)
    return judged(urls, model).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "learned").alias("verdict")
    )
