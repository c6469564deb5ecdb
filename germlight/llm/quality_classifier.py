"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

`document_statistics` turns every whole text into a short vector. `fit` needs only each class's count, vector sum and sum of outer products, which
partitions add up on their own, so it learns from all labelled rows; `score` compares the classes' Gaussian log densities, Mahalanobis
distances by way of Cholesky factors that are computed once and cached in the model.

Defined cases: null and empty texts are scored like texts of no words; repeated rows are scored each on its own and weigh in the fit as often
as they occur; labels that are null, or whose document is held out, are not learnt from, and a document labelled twice counts with its larger
label; without rows of one class (an empty table, say) every score is the smoothed prior; a null doc_id is never learnt from and not held out;
columns other than the named ones are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from germlight.llm._shared import checkpointed, fold, held_out, table

THRESHOLD = 0.3
#: Shrinkage of a class covariance towards the pooled one, and of that towards a multiple of the identity.
TO_POOLED, TO_IDENTITY = 0.25, 0.05
FEATURES = ("log_words", "word_length", "upper", "digits", "symbols", "punctuation", "pipes", "bangs", "adjacent_repeats", "distinct_words", "line_breaks", "entropy")

_BYTES = np.arange(256)
_ASCII = {name: np.isin(_BYTES, np.frombuffer(chars, np.uint8)) for name, chars in {"symbols": b"#*$%&<>~^=+_@{}[]\\", "punctuation": b".,;:?'\"()-", "digits": b"0123456789"}.items()}
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)


def statistics_of(text: str | None) -> list[float]:
    """The transformed statistics of one whole text; rates are smoothed so that very short texts stay near the middle."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = int(counts[_LETTER].sum())
    chars = letters + int(counts[33:65].sum())
    rate = lambda hits, of, prior, weight=20.0: math.sqrt((hits + prior * weight) / (of + weight))
    p = counts[counts > 0] / max(len(data), 1)
    entropy = -float((p * np.log2(p)).sum()) if len(p) else 0.0
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    fresh = len(set(words)) / max(n, 1)
    return [
        math.log1p(n),
        math.log1p((chars + 5 * 20) / (n + 20)),
        rate(int(counts[_UPPER].sum()), letters, 0.03, 60.0),
        rate(int(counts[_ASCII["digits"]].sum()), chars, 0.002, 60.0),
        rate(int(counts[_ASCII["symbols"]].sum()), n, 0.01),
        rate(int(counts[_ASCII["punctuation"]].sum()), n, 0.15),
        rate(int(counts[124]), n, 0.01),
        rate(int(counts[33]), n, 0.01),
        rate(repeats, n, 0.01),
        fresh * n / (n + 20) + 0.7 * 20 / (n + 20),
        rate(int(counts[10]), n, 0.02),
        entropy * n / (n + 20) + 4.2 * 20 / (n + 20),
    ]


def document_statistics(text: Column) -> Column:
    """array<double> in the order of FEATURES."""

    @F.arrow_udf("array<double>")
    def each(texts: pa.Array) -> pa.Array:
        return pa.array([statistics_of(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return each(text)


@dataclass
class Discriminant:
    """Per class: log prior, mean, inverse Cholesky factor of the shrunk covariance, and log determinant."""

    prior: float
    classes: dict[int, tuple[float, np.ndarray, np.ndarray, float]] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        """P(label 1) of each row of x."""
        if len(self.classes) < 2:
            return np.full(len(x), self.prior)
        dens = {}
        for label, (log_prior, mean, inverse, log_det) in self.classes.items():
            z = (x - mean) @ inverse.T
            dens[label] = log_prior - 0.5 * log_det - 0.5 * np.einsum("ij,ij->i", z, z)
        return 1.0 / (1.0 + np.exp(np.clip(dens[0] - dens[1], -700, 700)))


def moments(labelled: DataFrame, vector: str = "stats", label: str = "quality") -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Count, sum and sum of outer products by label: a task sends one short row a label, and partial sums meet before the driver gets two rows."""
    d = len(FEATURES)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if len(batch):
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), d)
                x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
                y = batch.column(1).to_numpy(zero_copy_only=False)
                for k in np.unique(y):
                    rows = x[y == k]
                    sums[int(k)] = sums.get(int(k), 0) + rows.T @ rows
        for k, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([m.ravel().tolist()], pa.list_(pa.float64()))], names=["label", "m"])

    parts = labelled.select(vector, F.col(label).cast("int").alias(label)).mapInArrow(partial, "label int, m array<double>")
    summed = parts.select("label", F.posexplode("m").alias("at", "value")).groupBy("label", "at").agg(F.sum("value").alias("value"))
    out: dict[int, np.ndarray] = {}
    for row in summed.collect():  # two classes of (d + 1)^2 numbers, whatever the input
        out.setdefault(row["label"], np.zeros((d + 1) * (d + 1)))[row["at"]] = row["value"]
    return {k: (round(m[0]), m.reshape(d + 1, d + 1)[0, 1:], m.reshape(d + 1, d + 1)[1:, 1:]) for k, m in out.items()}


def discriminant(by_label: dict[int, tuple[int, np.ndarray, np.ndarray]]) -> Discriminant:
    n = {k: by_label[k][0] if k in by_label else 0 for k in (0, 1)}
    model = Discriminant((n[1] + 1) / (n[0] + n[1] + 2))
    if min(n.values()) < 2:
        return model
    cov = {k: m2 / c - np.outer(s / c, s / c) for k, (c, s, m2) in by_label.items() if k in n}
    pooled = sum(n[k] * cov[k] for k in n) / sum(n.values())
    for k in n:
        shrunk = (1 - TO_POOLED) * cov[k] + TO_POOLED * pooled
        # Towards the identity in units of each statistic's pooled variance, so that no scale dominates.
        shrunk = (1 - TO_IDENTITY) * shrunk + TO_IDENTITY * np.diag(np.maximum(np.diag(pooled), 1e-6))
        factor = np.linalg.cholesky(shrunk)
        model.classes[k] = (math.log(n[k] / sum(n.values())), by_label[k][1] / n[k], np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum()))
    return model


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", vector: str = "stats", label: str = "quality") -> Discriminant:
    """Learns from the rows of stats (id, vector) whose document is labelled and not held out; only ids and vectors are joined, never texts."""
    train = labels.where((fold(F.col(id_col)) != 0) & F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    rows = stats.select(F.col(id_col).alias("_id"), F.col(vector).alias(vector)).join(train, "_id").select(vector, F.col("_label").alias(label))
    return discriminant(moments(rows, vector, label))


def score(vector: Column, model: Discriminant) -> Column:
    @F.arrow_udf("double")
    def each(vectors: pa.Array) -> pa.Array:
        x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), len(FEATURES))
        return pa.array(model.score(x), pa.float64())

    return each(vector)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, held_out, score and predicted of every row. The statistics are computed once, into the shared folder (some 100 bytes a document)."""
    stats = checkpointed(docs.select(F.col(id_col), document_statistics(F.col(text_col)).alias("stats")))
    scored = stats.select(id_col, held_out(F.col(id_col)).alias("held_out"), score(F.col("stats"), fit(stats, labels, id_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op3_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
