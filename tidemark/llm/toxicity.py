"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are the distinct lower-case words of a text and their beginnings of
five to eight letters, so that compounds share what they begin with.  One weight
vector is shared by all thresholds: the chance that the grade is above k is
sigmoid(s - threshold_k), s being the sum of the weights.  The expected severity
is the sum of these chances.

Labels say toxic or not.  Grade 0 is not toxic; toxic texts get the grades 1 to
3 by the number of distinct features they hold that speak for toxicity, cut at
its terciles.

The model is fitted on a bounded sample: ``SAMPLE`` labelled ids of each class
at most, picked by a hash, weighed back to the shares of the classes.  Every
document is scored on its whole text.

Null and empty texts have no features and get the grade of the thresholds
alone.  Very long texts are scored whole.  Labels without an id or a value are
left out; of several for one id the highest counts.  Where documents of different
texts share a labelled id, the model learns from the greatest text by code point;
all of them are scored.  Without labels of both classes every severity is 0.
Documents that repeat score each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField

from tidemark.llm.tables import column, map_texts, staged

SAMPLE = 10_000
FEATURES = 5_000
LEAST_DOCS, LEAST_CHI2 = 5, 30.0
GRADES = 4
STEMS = (5, 6, 7, 8)
CACHED_WORDS = 300_000
STEPS, RIDGE = 1000, 3e-6
# Everything but letters, digits and non-ASCII characters parts words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def _stems(word: bytes) -> list[bytes]:
    letters = word.decode("utf-8", "replace")
    return [b"^" + letters[:n].encode() for n in STEMS if len(letters) >= n]


def _features(text: bytes | None) -> set[bytes]:
    words = set(text.translate(_WORD_BYTES).split()) if text else set()
    return words.union(*map(_stems, words))


@dataclass
class OrdinalModel:
    """Weights by feature, and the rising thresholds between the grades."""

    weights: dict[bytes, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=lambda: [50.0] * (GRADES - 1))

    def chances(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected severity, and the chances to be above each threshold."""
        above = 1 / (1 + np.exp(np.clip(np.array(self.thresholds)[None, :] - s[:, None], -60, 60)))
        return above.sum(axis=1), above


class _WordFeatures(dict):
    """Of each word the features with a weight; most have none."""

    def __init__(self, weights):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes):
        value = tuple(f for f in (word, *_stems(word)) if f in self.weights)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value


def fit(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, weight: np.ndarray, n: int):
    """Weights and thresholds by Adam on the full (weighed) likelihood.

    ``rows`` and ``columns`` are the places of the ones in the feature matrix.
    """
    k = GRADES - 1
    w = np.zeros(n)
    # The first threshold and the logarithms of the gaps to the next ones.
    free = np.array([1.0] + [0.0] * (k - 1))
    moments = [np.zeros(n + k), np.zeros(n + k)]
    scale = weight / weight.sum()
    for step in range(1, STEPS + 1):
        gaps = np.exp(free[1:])
        cut = np.concatenate(([free[0]], free[0] + np.cumsum(gaps)))
        s = np.bincount(rows, weights=w[columns], minlength=len(grades))
        below = 1 / (1 + np.exp(np.clip(s[:, None] - cut[None, :], -60, 60)))
        below = np.concatenate((np.zeros((len(s), 1)), below, np.ones((len(s), 1))), axis=1)
        at = np.arange(len(s))
        low, high = below[at, grades], below[at, grades + 1]
        p = np.maximum(high - low, 1e-12)
        d_s = (1 - high - low) * scale
        d_cut = np.zeros((len(s), k + 2))
        d_cut[at, grades + 1] -= high * (1 - high) / p * scale
        d_cut[at, grades] += low * (1 - low) / p * scale
        d_cut = d_cut[:, 1:-1].sum(axis=0)
        d_free = np.concatenate(([d_cut.sum()], [d_cut[i:].sum() * gaps[i - 1] for i in range(1, k)]))
        d_w = np.bincount(columns, weights=d_s[rows], minlength=n) + RIDGE * w
        g = np.concatenate((d_w, d_free))
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.99 * moments[1] + 0.01 * g * g
        move = 0.1 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        w, free = w - move[:n], free - move[n:]
    return w, np.concatenate(([free[0]], free[0] + np.cumsum(np.exp(free[1:]))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> OrdinalModel:
    given = labels.select(column(label_id).alias("id"), column(label).cast("int").alias("toxic"))
    given = given.where("id is not null and toxic is not null").groupBy("id").agg(
        (F.max("toxic") > 0).alias("toxic")
    )
    given = staged(given, "toxicity-labels")
    sizes = {r.toxic: r["count"] for r in given.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return OrdinalModel()
    pick = lambda toxic: given.where(F.col("toxic") == toxic).orderBy(F.xxhash64("id"), "id").limit(sample)
    picked = staged(pick(True).union(pick(False)), "toxicity-sample")
    # At most twice ``sample`` rows are broadcast, and texts of as many ids kept.
    texts = (
        docs.select(column(doc_id).alias("id"), column(text).alias("text"))
        .join(F.broadcast(picked), "id")
        .groupBy("id", "toxic")
        .agg(F.max("text").alias("text"))
    )
    make = lambda: lambda values: ([[f.hex() for f in sorted(_features(v))] for v in values],)
    rows = staged(
        map_texts(texts, "text", [StructField("features", ArrayType(StringType()))], make, ["toxic"])
        .select("doc.toxic", "features")
        .withColumn("row", F.monotonically_increasing_id()),
        "toxicity-features",
    )
    n = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return OrdinalModel()
    held = rows.select("row", "toxic", F.explode("features").alias("feature"))
    a, b = F.count_if("toxic"), F.count_if(~F.col("toxic"))
    counts = held.groupBy("feature").agg(a.alias("a"), b.alias("b")).where(F.col("a") + F.col("b") >= LEAST_DOCS)
    c, d = F.lit(n[True]) - F.col("a"), F.lit(n[False]) - F.col("b")
    off = F.col("a") * d - F.col("b") * c
    chi2 = off.cast("double") * off / ((F.col("a") + F.col("b")).cast("double") * (c + d + 1e-9)) * (
        (n[True] + n[False]) / (n[True] * n[False])
    )
    best = counts.withColumn("chi2", chi2).where(F.col("chi2") >= LEAST_CHI2)
    best = best.orderBy(F.desc("chi2"), "feature").limit(FEATURES).collect()
    names = {r.feature: i for i, r in enumerate(best)}
    speaks = np.array([r.a * n[False] > r.b * n[True] for r in best], bool)
    chosen = F.array_intersect("features", F.array(*map(F.lit, names))) if names else F.array().cast("array<string>")
    matrix = rows.select("toxic", chosen.alias("features")).collect()
    row = np.array([i for i, r in enumerate(matrix) for _ in r.features], np.int64)
    col = np.array([names[f] for r in matrix for f in r.features], np.int64)
    toxic = np.array([r.toxic for r in matrix])
    hits = np.bincount(row[speaks[col]], minlength=len(matrix)) if len(row) else np.zeros(len(matrix))
    cuts = np.quantile(hits[toxic], [1 / 3, 2 / 3])
    grades = np.where(toxic, 1 + (hits > cuts[0]) + (hits > cuts[1]), 0).astype(np.int64)
    weight = np.where(toxic, sizes[True] / n[True], sizes[False] / n[False])
    w, thresholds = fit(row, col, grades, weight, len(names))
    return OrdinalModel({bytes.fromhex(f): float(w[i]) for f, i in names.items()}, thresholds.tolist())


def severities(
    docs: DataFrame, model: OrdinalModel, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Expected severity (0 to 3), likeliest grade, and whether the text is likelier toxic than not."""

    def make():
        features = _WordFeatures(model.weights)

        def work(texts):
            sums = np.zeros(len(texts))
            for i, value in enumerate(texts):
                words = set(value.translate(_WORD_BYTES).split()) if value else ()
                held = {f for w in words for f in features[w]}
                # In order, so that equal texts get equal sums.
                sums[i] = sum(model.weights[f] for f in sorted(held))
            severity, above = model.chances(sums)
            chances = np.diff(np.concatenate((np.ones((len(sums), 1)), above, np.zeros((len(sums), 1))), axis=1))
            return severity, (-chances).argmax(axis=1).astype(np.int32), above[:, 0]

        return work

    fields = [
        StructField("severity", DoubleType()),
        StructField("grade", IntegerType()),
        StructField("chance", DoubleType()),
    ]
    return map_texts(docs, text, fields, make, [doc_id]).select(
        F.col(f"doc.`{doc_id}`").alias("doc_id"),
        "severity",
        "grade",
        (F.col("chance") >= 0.5).alias("toxic"),
    )
