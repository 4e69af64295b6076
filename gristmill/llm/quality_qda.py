"""Quality classifier: regularised quadratic discriminant over document statistics.

Every whole text becomes a vector of transformed statistics.  The labelled rows give
each class a mean and a covariance; a covariance is shrunk towards the pooled one and
then towards a multiple of the identity, and its Cholesky factor is kept.  The score
is the logistic function of the difference of the two log densities (Mahalanobis
distances and log determinants) plus the log prior odds.

The fit uses all labelled rows it is given: each task sends one row of counts, sums
and products per class, so the work grows with the input and the driver gets a table
whose size depends on the number of statistics alone.

Defined results: null and empty texts have the statistics of a text without words and
get a score like any other; labels other than 0 and 1 or null are not learned from; a
doc_id with several labels counts once per label row; with no labelled row of a class
the score is 0.5 for all.  Extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import pick, raw_bytes

_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_UPPER, _DIGIT, _SPACE = bytes(range(65, 91)), bytes(range(48, 58)), b" \t\n\r\x0b\x0c"
_STOP = b".!?;:,"
#: Words to a block for the share of distinct words, so that long texts are not taken for repetitive ones.
BLOCK = 200
_SYMBOL = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-()?")

STATISTICS = (
    "repeated neighbours", "distinct words", "upper case", "symbols", "digits", "commas and stops", "spaces", "word length",
    "short words", "words with symbols",
)


def statistics(text: bytes) -> tuple[float, ...]:
    """Transformed statistics of one whole text.

    Shares are smoothed by a few pseudo-counts at usual values, so that a short text says little, and go through a
    square root; none grows with the length.
    """
    size = len(text)
    words = text.split()
    n = len(words)

    def count(delete: bytes) -> int:
        return size - len(text.translate(None, delete))

    def share(part: float, whole: float, usual: float, weight: float) -> float:
        return max(0.0, (part + usual * weight) / (whole + weight)) ** 0.5

    letters = count(_LETTERS)
    blocks = [words[i : i + BLOCK] for i in range(0, n, BLOCK)]
    marked = len([w for w in words if w.translate(None, _SYMBOL) != w])
    return (
        share(sum(map(eq, words, words[1:])), n, 0.005, 40),
        share(sum(len(set(block)) for block in blocks), n, 0.75, 40),
        share(count(_UPPER), letters, 0.02, 250),
        share(count(_SYMBOL), size, 0.002, 250),
        share(count(_DIGIT), size, 0.002, 250),
        share(count(_STOP), size, 0.02, 250),
        share(count(_SPACE), size, 0.18, 250),
        math.log((letters + 5.0 * 40) / (n + 40)),
        share(len([w for w in words if len(w) <= 3]), n, 0.4, 40),
        share(marked, n, 0.01, 40),
    )


def statistics_column(text: Column) -> Column:
    """Array of the statistics of each whole text."""

    @F.arrow_udf("array<double>")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            yield pa.array([statistics(raw) for raw in raw_bytes(values)], pa.list_(pa.float64()))

    return measured(text)


@dataclass(frozen=True)
class Model:
    """Means, Cholesky factors, log determinants (halved) and log prior of the classes 0 and 1; empty: no class is known."""

    means: tuple = ()
    factors: tuple = ()
    half_log_dets: tuple = ()
    log_priors: tuple = ()

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), 0.5)
        density = [
            log_prior - half - 0.5 * (np.linalg.solve(factor, (x - mean).T) ** 2).sum(axis=0)
            for mean, factor, half, log_prior in zip(self.means, self.factors, self.half_log_dets, self.log_priors)
        ]
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -700.0, 700.0)))

    def text_column(self, text: Column) -> Column:
        """Score of each whole text, measured and scored in one go."""
        model = self

        @F.arrow_udf("double")
        def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for values in batches:
                x = np.array([statistics(raw) for raw in raw_bytes(values)]).reshape(len(values), len(STATISTICS))
                yield pa.array(model.scores(x), pa.float64())

        return scored(text)

    def column(self, measured: Column) -> Column:
        """Score from 0 to 1 of an array of statistics; higher means that label 1 is likelier."""
        model = self

        @F.arrow_udf("double")
        def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for values in batches:
                x = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), len(STATISTICS))
                yield pa.array(model.scores(x), pa.float64())

        return scored(measured)


def fit(measured: DataFrame, labels: DataFrame, label_column: str, id_column: str = "doc_id", toward_pooled: float = 0.2,
        toward_identity: float = 0.02, least: float = 1e-6) -> Model:
    """Fit on all rows of ``measured`` (id, ``statistics``) that have a label 0 or 1."""
    d = len(STATISTICS)
    label = F.col(label_column).cast("int")
    marks = pick(labels, id_column, label_column).select(id_column, label.alias("__label")).where(F.col("__label").isin(0, 1))
    rows = measured.select(id_column, "statistics").join(marks, id_column).select("__label", "statistics")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {0: np.zeros((d + 1, d + 1)), 1: np.zeros((d + 1, d + 1))}
        for batch in batches:
            x = batch.column("statistics").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)
            x = np.hstack([np.ones((len(x), 1)), x])
            own = batch.column("__label").to_numpy(zero_copy_only=False)
            for k in total:
                total[k] += x[own == k].T @ x[own == k]
        n = (d + 1) ** 2
        yield pa.RecordBatch.from_pydict({
            "label": np.repeat(np.array([0, 1], np.int32), n), "cell": np.tile(np.arange(n, dtype=np.int32), 2),
            "value": np.concatenate([total[0].ravel(), total[1].ravel()]),
        })

    cells = rows.mapInArrow(sums, "label int, cell int, value double").groupBy("label", "cell").agg(F.sum("value").alias("value"))
    moments = np.zeros((2, (d + 1) ** 2))
    for row in cells.collect():  # 2 * (statistics + 1) squared numbers, whatever the input
        moments[row["label"], row["cell"]] = row["value"]
    moments = moments.reshape(2, d + 1, d + 1)
    counts = moments[:, 0, 0]
    if not counts.all():
        return Model()
    means = moments[:, 0, 1:] / counts[:, None]
    spread = moments[:, 1:, 1:] / counts[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (counts[:, None, None] * spread).sum(axis=0) / counts.sum()
    factors = []
    for own in spread:
        own = (1 - toward_pooled) * own + toward_pooled * pooled
        own = (1 - toward_identity) * own + (toward_identity * np.trace(own) / d + least) * np.eye(d)
        factors.append(np.linalg.cholesky(own))
    halves = [np.log(np.diag(factor)).sum() for factor in factors]
    return Model(tuple(means), tuple(factors), tuple(halves), tuple(np.log(counts / counts.sum())))


def held_out(id_column: Column, folds: int = 5) -> Column:
    """True for ids whose CRC-32 (of the id as text) is divisible by ``folds``; such rows are never learned from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds == 0, F.lit(False))


def measure(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and ``statistics`` of every document."""
    own = pick(docs, id_column, text_column)
    return own.select(id_column, statistics_column(F.col(text_column)).alias("statistics"))
