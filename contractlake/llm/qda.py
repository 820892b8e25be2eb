"""Quality classifier: regularised quadratic discriminant over statistics of the text."""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from contractlake.llm.common import give_back, map_batches

# Kinds of bytes of UTF-8 text.
KINDS = ("upper", "lower", "digit", "space", "line", "stop", "mark", "high")


def _kinds() -> np.ndarray:
    kind = np.full(256, KINDS.index("mark"), np.int64)
    for name, chars in (
        ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("lower", b"abcdefghijklmnopqrstuvwxyz"),
        ("digit", b"0123456789"), ("space", b" \t\v\f\r"), ("line", b"\n"), ("stop", b".,;:'\"()-"),
    ):
        kind[list(chars)] = KINDS.index(name)
    kind[128:] = KINDS.index("high")
    return kind


KIND_OF = _kinds()
STATISTICS = 11


# What a share is drawn to in a short text, and by how many letters, words or lines of evidence.
TYPICAL = {
    "upper": 0.03, "mark": 0.005, "stop": 0.02, "digit": 0.005, "high": 0.02,
    "repeats": 0.25, "twice": 0.01, "lines": 0.02, "loud": 0.003,
}
EVIDENCE = 40


def statistics(text: str | None) -> np.ndarray:
    """Transformed statistics of a whole text, each roughly even in scale; null is empty.

    Shares enter by the logit, which spreads out what lies near 0 and 1. Each share is drawn to
    a typical one first, so that a short text, which says little, is not far from anything and
    an empty one has defined statistics. Means enter by the logarithm, drawn likewise.
    """
    data = (text or "").encode()
    counts = np.bincount(KIND_OF[np.frombuffer(data, np.uint8)], minlength=len(KINDS))
    upper, lower, digit, space, line, stop, mark, high = counts.tolist()
    words = data.split()
    n = len(words)
    letters = upper + lower + high
    lines = [x for x in data.split(b"\n") if x]
    twice = sum(map(operator.eq, words, words[1:]))

    def logit(name: str, part: float, whole: float) -> float:
        typical = TYPICAL[name] * EVIDENCE
        return float(np.log((part + typical) / (whole - part + EVIDENCE - typical)))

    return np.array([
        np.log((len(data) - space - line + 5 * EVIDENCE) / (n + EVIDENCE)),
        logit("upper", upper, letters),
        logit("mark", mark, len(data)),
        logit("stop", stop, len(data)),
        logit("digit", digit, len(data)),
        logit("high", high, len(data)),
        logit("repeats", n - len(set(words)), n),
        logit("twice", twice, n),
        np.log((len(data) + 60 * EVIDENCE) / (len(lines) + EVIDENCE)),
        logit("lines", len(lines) - len(set(lines)), len(lines)),
        logit("loud", data.count(b"!") + data.count(b"|"), len(data)),
    ])


@dataclass(frozen=True)
class QdaModel:
    """Per class 0 and 1: mean, Cholesky factor of the shrunk covariance and its log determinant."""

    means: tuple[np.ndarray, np.ndarray]
    inverse_factors: tuple[np.ndarray, np.ndarray]
    log_dets: tuple[float, float]
    log_prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 per row of statistics, from the difference of log densities."""
        margin = np.full(len(x), self.log_prior)
        for sign, mean, inverse, log_det in zip((-1, 1), self.means, self.inverse_factors, self.log_dets):
            away = (x - mean) @ inverse.T
            margin += sign * -0.5 * (np.einsum("ij,ij->i", away, away) + log_det)
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def document_statistics(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and ``statistics``, a row of numbers per text; nothing is shuffled.

    Null and empty texts have the statistics of nothing, which are finite. Rows stay one to one, with
    null and repeated keys; an empty table gives an empty one; other columns are not read.
    """
    named = documents.select(F.col(f"`{key}`").alias("key"), F.col("text").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = [statistics(text.as_py()) for text in batch.column("text")]
            yield {"key": batch.column("key"), "statistics": rows}

    found = map_batches(named, work, f"key {dict(named.dtypes)['key']}, statistics array<double>")
    return found.withColumnRenamed("key", key)


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Per task and class: number, sum and sum of products of the statistics."""
    sums = {c: np.zeros((STATISTICS + 1, STATISTICS + 1)) for c in (0, 1)}
    for batch in batches:
        x = _matrix(batch.column("statistics"))
        x = np.hstack([x, np.ones((len(x), 1))])
        labels = batch.column("quality").to_numpy(zero_copy_only=False)
        for c in (0, 1):
            mine = x[labels == c]
            sums[c] += mine.T @ mine
    yield {"quality": [0, 1], "products": [sums[c].ravel() for c in (0, 1)]}


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never fitted on: a quarter, by the key; none with a null key."""
    quarter = F.crc32(F.col(key).cast("string").cast("binary")) % 4
    return F.coalesce(quarter == 2, F.lit(False))


def fit_quality(
    documents: DataFrame, labels: DataFrame, shrinkage: float = 0.05, key: str = "doc_id"
) -> QdaModel:
    """:func:`fit_statistics` on the texts of the labelled documents; texts are not shuffled."""
    return fit_statistics(document_statistics(documents, key), labels, shrinkage, key)


def fit_statistics(
    found: DataFrame, labels: DataFrame, shrinkage: float = 0.05, key: str = "doc_id"
) -> QdaModel:
    """Fit on the statistics of every document with a label of 0 or 1 in ``quality``.

    Label rows with a null key or another label are left out, a document with several label rows
    counts once per row. Each class covariance is drawn to the pooled one, and that to its
    diagonal, by ``shrinkage``, which also keeps it invertible when a class has few documents.
    Tasks send sums of products, 12 by 12 numbers per class, however many rows there are. Both
    classes must occur, but that a table without documents has a model by which all texts are alike.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col(key).isNotNull())
    rows = found.join(known.select(key, F.col("quality").cast("int").alias("quality")), key)
    parts = map_batches(rows.select("statistics", "quality"), _moments, "quality int, products array<double>")
    size = (STATISTICS + 1) ** 2
    added = parts.groupBy("quality").agg(
        F.array(*[F.sum(F.get("products", F.lit(i))) for i in range(size)]).alias("products")
    )
    sums = {row.quality: np.array(row.products).reshape(STATISTICS + 1, -1) for row in added.collect()}
    counts = {c: sums[c][-1, -1] if c in sums else 0 for c in (0, 1)}
    if max(counts.values()) == 0 and found.isEmpty():
        return QdaModel((np.zeros(STATISTICS),) * 2, (np.eye(STATISTICS),) * 2, (0.0, 0.0), 0.0)
    if min(counts.values()) < 2:
        raise ValueError(f"both classes need labelled documents, got {counts}")
    means = {c: sums[c][-1, :-1] / counts[c] for c in (0, 1)}
    scatter = {c: sums[c][:-1, :-1] - counts[c] * np.outer(means[c], means[c]) for c in (0, 1)}
    pooled = (scatter[0] + scatter[1]) / (counts[0] + counts[1])
    pooled = (1 - shrinkage) * pooled + shrinkage * np.diag(np.diag(pooled)) + 1e-6 * np.eye(STATISTICS)
    factors, log_dets = [], []
    for c in (0, 1):
        weight = min(1.0, shrinkage + STATISTICS / (counts[c] + STATISTICS))
        factor = np.linalg.cholesky((1 - weight) * scatter[c] / counts[c] + weight * pooled)
        factors.append(np.linalg.inv(factor))
        log_dets.append(2 * float(np.log(np.diag(factor)).sum()))
    return QdaModel(
        (means[0], means[1]), tuple(factors), tuple(log_dets), float(np.log(counts[1] / counts[0]))
    )


def score_column(model: QdaModel, text: Column) -> Column:
    """The score of each text, 0 to 1; null counts as empty."""

    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        rows = np.array([statistics(t) for t in texts]).reshape(-1, STATISTICS)
        give_back()
        return pd.Series(model.scores(rows))

    return score(text)


def score_statistics(model: QdaModel, found: Column) -> Column:
    """The score of each row of statistics, null where there are none."""

    @pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        known = rows.notna()
        scores = model.scores(np.array(rows[known].tolist()).reshape(-1, STATISTICS))
        return pd.Series(scores, rows.index[known]).reindex(rows.index)

    return score(found)


def score_documents(documents: DataFrame, model: QdaModel, threshold: float = 0.7) -> DataFrame:
    """``documents`` with ``score`` and ``predicted`` (1 from ``threshold`` on); columns of those
    names are replaced. Rows stay one to one and nothing is shuffled."""
    scored = documents.withColumn("score", score_column(model, F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
