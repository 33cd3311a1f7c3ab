"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text becomes a vector of statistics, transformed towards normality (log of
sizes, arcsine square root of shares).  Spark sums counts, vectors and outer products
per class over all labelled training rows; the driver turns those sums (a few hundred
numbers) into class means and shrunken covariances.  With D the pooled standard
deviations as a diagonal matrix,

    S_k' = (1 - ridge) * ((1 - pool) * S_k + pool * S) + ridge * D^2

(computed on the scale of D, as D^-1 S_k' D^-1), and one Cholesky factor per class, made once and sent with the scoring tasks.  The
score is the logistic of the log-density difference of the classes plus the log prior
ratio, divided by a fixed temperature (a quadratic discriminant is overconfident).

Defined cases: null text counts as empty, and empty texts are scored; a null doc_id is
never a training row and not held out; labels that are null, not 0 or 1, or that
contradict each other for one doc_id are not used; equal label rows count once;
repeated documents are scored one by one and each counts in training; without labels of
both classes every score is 0.5; an empty table gives an empty result; extra columns
are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from spindle.llm.common import body, free_name, keep
from spindle.operators.joins import checked_broadcast

N_FEATURES = 16
POOL, RIDGE, TEMPERATURE = 0.1, 0.02, 4.0
ACCEPT = 0.7

_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_STOP = [ord(c) for c in ".?;:"]
_SYMBOL = [ord(c) for c in "#$%&*@^~+<>{}\\_"]


def text_features(text: str) -> list[float]:
    """Transformed statistics of one whole text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(len(raw), 1)
    count = np.bincount(raw, minlength=256)
    words = text.split()
    lines = text.split("\n")
    n_words, n_lines = max(len(words), 1), len(lines)
    letters = int(count[_UPPER].sum() + count[_LOWER].sum() + count[128:].sum())
    seen = count[count > 0] / n
    share = lambda x, of: float(np.arcsin(np.sqrt(min(1.0, x / max(of, 1)))))
    shouted = sum(map(str.isupper, words))
    return [
        float(np.log1p(len(words))),
        float(np.log1p(len(raw) / n_words)),
        float(np.log1p(n_words / n_lines)),
        share(len(set(words)), n_words),
        share(len(set(lines)), n_lines),
        share(letters, n),
        share(int(count[_UPPER].sum()), letters),
        share(shouted, n_words),
        share(int(count[_DIGIT].sum()), n),
        share(int(count[_STOP].sum()), n_words),
        share(int(count[ord(",")]), n_words),
        share(int(count[ord("!")]), n),
        share(int(count[ord("|")] + count[ord("=")]), n),
        share(int(count[_SYMBOL].sum()), n),
        share(int(count[32] + count[9]), n),
        float(-(seen * np.log(seen)).sum()),
    ]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_features(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(rows, pa.list_(pa.float64()))],
            names=[*(c for c in batch.schema.names if c != "text"), "features"])


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log normalisers of both classes."""

    means: np.ndarray
    whiteners: np.ndarray
    offsets: np.ndarray
    temperature: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability-like score of class 1 for each row of ``x``."""
        log_density = [self.offsets[k] - 0.5 * (((x - self.means[k]) @ self.whiteners[k].T) ** 2).sum(axis=1)
                       for k in (0, 1)]
        z = np.clip((log_density[1] - log_density[0]) / self.temperature, -700, 700)
        return 1 / (1 + np.exp(-z))


def discriminant(n: np.ndarray, total: np.ndarray, outer: np.ndarray, pool: float, ridge: float,
                 temperature: float) -> Discriminant:
    """From counts (2,), sums (2, d) and sums of outer products (2, d, d) of the classes."""
    means = total / n[:, None]
    cov = outer / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (cov * n[:, None, None]).sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 0) + 1e-8)  # a constant statistic has no variance
    whiteners, offsets = [], []
    for k in (0, 1):
        own = ((1 - pool) * cov[k] + pool * pooled) / np.outer(scale, scale)
        own = (1 - ridge) * own + ridge * np.eye(len(scale))
        factor = np.linalg.cholesky(own)
        whiteners.append(np.linalg.inv(factor) / scale)
        offsets.append(np.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(whiteners), np.array(offsets), temperature)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def document_features(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``features`` of every document, written once: texts are read a single time."""
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))
    return keep(narrow.mapInArrow(_features, "doc_id bigint, features array<double>"), "quality-features")


def fit(features: DataFrame, labels: DataFrame, pool: float = POOL, ridge: float = RIDGE,
        temperature: float = TEMPERATURE) -> Discriminant | None:
    """The model of the labelled rows that are not held out; None without both classes."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .filter("doc_id is not null and quality in (0, 1)")
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
             .filter("quality = most").drop("most").filter(~held_out()))
    train = features.join(known, "doc_id")
    x = [F.col("features")[i] for i in range(N_FEATURES)]
    pairs = [(i, j) for i in range(N_FEATURES) for j in range(i, N_FEATURES)]
    sums = train.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.array(*(F.sum(v) for v in x)).alias("total"),
        F.array(*(F.sum(x[i] * x[j]) for i, j in pairs)).alias("outer")).collect()
    if len(sums) < 2:
        return None
    sums = sorted(sums, key=lambda r: r["quality"])
    outer = np.zeros((2, N_FEATURES, N_FEATURES))
    for k, r in enumerate(sums):
        for (i, j), v in zip(pairs, r["outer"], strict=True):
            outer[k, i, j] = outer[k, j, i] = v
    return discriminant(np.array([r["n"] for r in sums], float), np.array([r["total"] for r in sums]), outer,
                        pool, ridge, temperature)


def _scorer(model: Discriminant | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.drop_columns(["features"])
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            score = np.full(len(x), 0.5) if model is None else model.score(x)
            yield rest.append_column("score", pa.array(score, pa.float64()))

    return run


def score_documents(documents: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    features = document_features(documents)
    model = fit(features, labels)
    scored = features.mapInArrow(_scorer(model), "doc_id bigint, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= accept).cast("int").alias("predicted"))


def _scored_rows(batches: Iterator[pa.RecordBatch], model: Discriminant | None, text: str, score: str
                 ) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([text_features(t or "") for t in batch.column(text).to_pylist()]).reshape(-1, N_FEATURES)
        values = np.full(len(rows), 0.5) if model is None else model.score(rows)
        yield batch.append_column(score, pa.array(values, pa.float64()))


def accepted_documents(documents: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``documents``, all columns, that score ``accept`` or more.

    Texts are read twice: labelled training rows for the fit, all rows for the scores.
    """
    wanted = labels.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    train = documents.filter(~held_out()).join(checked_broadcast(wanted, "doc_id"), "doc_id", "left_semi")
    model = fit(document_features(train), labels)
    score = free_name(documents, "score")
    schema = StructType([*documents.schema.fields, StructField(score, DoubleType())])
    return (documents.mapInArrow(lambda batches: _scored_rows(batches, model, "text", score), schema)
            .filter(F.col(score) >= accept).drop(score))
