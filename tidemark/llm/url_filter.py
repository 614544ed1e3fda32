"""URL filter: host and path rules, and gradient-boosted trees for the rest.

A rule names a host and the beginning of a path; it fits the host and all its
subdomains, and the longest rule that fits decides.  URLs that no rule fits are
judged by boosted trees on lexical features: lengths, depth, digit ratio,
character entropy, numbers of parameters, and how often the host's suffix was
blocked among the labelled URLs.

The trees are fitted on labelled URLs, at most about ``SAMPLE`` distinct ones,
picked by a hash.  Suffix statistics come from all labelled URLs; those of
suffixes with less than a ten-thousandth of them are joined into one, so at
most ten thousand are broadcast.

Null URLs and those without ``://`` have an empty host and path, fit no rule and
are judged on empty features.  Without labelled URLs of both verdicts, URLs
that no rule fits get the only verdict there is, or else are allowed.  Rows of
``pages`` that repeat are judged each; a URL counts once in training however
often it stands there.  Very long URLs are judged whole.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from tidemark.llm.tables import column, map_texts, packed, staged

SAMPLE = 200_000
TREES, DEPTH, STEP = 20, 4, 0.2
SUFFIX_SHARE = 10_000
SMOOTHING = 20.0

# Verdict and rule.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

LEXICAL = [
    "url_length",
    "host_length",
    "host_labels",
    "host_dashes",
    "host_digit_ratio",
    "path_length",
    "depth",
    "digit_ratio",
    "entropy",
    "host_entropy",
    "params",
    "query_length",
    "has_fragment",
]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without any."""
    rule = verdict = None
    # Longest first; WHEN takes the first that holds.
    for decision, text in sorted(rules, key=lambda r: -len(r[1])):
        name, _, begin = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + begin)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, decision) if verdict is None else verdict.when(fits, decision)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _entropy(data: bytes) -> float:
    if not data:
        return 0.0
    share = np.bincount(np.frombuffer(data, np.uint8)) / len(data)
    share = share[share > 0]
    return float(-(share * np.log2(share)).sum())


def _digits(data: bytes) -> float:
    return sum(48 <= b <= 57 for b in data) / len(data) if data else 0.0


def lexical_features(url: bytes | None) -> list[float]:
    rest = (url or b"").partition(b"://")[2]
    rest, mark, _ = rest.partition(b"#")
    rest, _, query = rest.partition(b"?")
    host, slash, path = rest.partition(b"/")
    path = slash + path
    return [
        float(len(url or b"")),
        float(len(host)),
        float(host.count(b".") + 1 if host else 0),
        float(host.count(b"-")),
        _digits(host),
        float(len(path)),
        float(path.count(b"/")),
        _digits(url or b""),
        _entropy(url or b""),
        _entropy(host),
        float(query.count(b"&") + 1 if query else 0),
        float(len(query)),
        float(bool(mark)),
    ]


def with_features(frame: DataFrame, url: str) -> DataFrame:
    """``frame`` as ``doc`` with the lexical features beside it."""
    make = lambda: lambda urls: list(
        map(list, zip(*(lexical_features(u) for u in urls), strict=True))
    ) or [[] for _ in LEXICAL]
    return map_texts(frame, url, [StructField(n, DoubleType()) for n in LEXICAL], make)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


class UrlModel:
    """Fitted trees with the suffix statistics they need."""

    def __init__(self, trees, suffixes: DataFrame | None, prior: float):
        self.trees, self.suffixes, self.prior = trees, suffixes, prior

    def blocked(self, features: DataFrame, host: Column) -> DataFrame:
        """``features`` with a column ``blocked``."""
        if self.trees is None:
            return features.withColumn("blocked", F.lit(self.prior > 0.5))
        ready = _assembled(features, self.suffixes, host, self.prior)
        scored = self.trees.transform(ready)
        return scored.select(*features.columns, (F.col("prediction") > 0.5).alias("blocked"))


def _assembled(features: DataFrame, suffixes: DataFrame, host: Column, prior: float) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    joined = features.withColumn("suffix", suffix_of(host)).join(F.broadcast(suffixes), "suffix", "left")
    joined = joined.withColumn("suffix_rate", F.coalesce("suffix_rate", F.lit(prior)))
    return VectorAssembler(inputCols=[*LEXICAL, "suffix_rate"], outputCol="features").transform(joined)


def train(labelled: DataFrame, sample: int = SAMPLE, seed: int = 5) -> UrlModel:
    """A model from rows of ``url``, ``host`` and ``blocked``."""
    from pyspark.ml.classification import GBTClassifier

    labelled = staged(
        labelled.where("url is not null").groupBy("url", "host").agg(F.max("blocked").alias("blocked")),
        "url-labelled",
    )
    n, bad = labelled.agg(F.count(F.lit(1)), F.count_if("blocked")).first()
    prior = bad / n if n else 0.0
    if not 0 < bad < n:
        return UrlModel(None, None, prior)
    by_suffix = labelled.groupBy(suffix_of(F.col("host")).alias("suffix")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("blocked").alias("bad")
    )
    rate = (F.col("bad") + SMOOTHING * prior) / (F.col("n") + SMOOTHING)
    suffixes = staged(
        by_suffix.where(F.col("n") * SUFFIX_SHARE >= n).select("suffix", rate.alias("suffix_rate")),
        "url-suffixes",
    )
    part = 1_000_000
    picked = labelled.where(F.pmod(F.xxhash64("url"), F.lit(part)) < int(part * min(1.0, sample / n)))
    ready = _assembled(with_features(picked, "url"), suffixes, F.col("doc.host"), prior)
    ready = staged(ready.select("features", F.col("doc.blocked").cast("double").alias("label")), "url-train")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=seed).fit(ready)
    return UrlModel(trees, suffixes, prior)


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    *,
    url: str = "url",
    page_id: str = "page_id",
    model: UrlModel | None = None,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict``.

    Without a ``model`` one is trained on the URLs that rules decide.
    """
    address = column(url)
    parts = pages.select(
        packed(pages, [page_id]), address.alias("url"), host_of(address).alias("host"), path_of(address).alias("path")
    )
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "ruled": verdict})
    if model is None:
        known = parts.where("ruled is not null")
        model = train(known.select("url", "host", (F.col("ruled") == "block").alias("blocked")))
    judged = model.blocked(with_features(parts, "url"), F.col("doc.host"))
    by_trees = F.when(F.col("blocked"), "block").otherwise("allow")
    return judged.select(
        F.col(f"doc.doc.`{page_id}`").alias("page_id"),
        "doc.host",
        "doc.path",
        "doc.rule",
        F.coalesce(F.col("doc.ruled"), by_trees).alias("verdict"),
    )
