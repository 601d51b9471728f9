"""Quality classifier: regularised quadratic discriminant analysis (operator 3).

Features are transformed statistics of a whole text: logarithms of shares, smoothed
towards ordinary prose so that a text of a few words is not odd by chance. Each class has its mean and its covariance, shrunk
towards the pooled covariance and towards its own diagonal; a text's score is the
logistic function of the difference of the two log densities (Mahalanobis distances by
the cached Cholesky factors, log determinants, log priors).

The sums that means and covariances need are ordinary aggregates over all training
rows; only they (about a hundred numbers a class) reach the driver.

Defined cases: a null or empty text has the features of no words and gets a score;
a null id is never a training row and not held out; repeated rows score alike; without
training rows of both labels every score is 0.5; an empty table gives an empty result;
columns other than id and text are never inputs. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import shared_table, texts
from urbanlens.llm.shingles import Shingler

FEATURES = ("words", "word_length", "upper", "digit", "stop", "symbol", "bar", "other", "repeat",
            "distinct", "top", "line", "bare")
PRIOR_WEIGHT = 16  # words' worth of ordinary prose that every share is smoothed with
TO_POOLED, TO_DIAGONAL, RIDGE = 0.1, 0.1, 1e-3


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    out[list(chars)] = 1
    return out


_KINDS = np.stack([
    _table(bytes(range(65, 91))), _table(bytes(range(97, 123)) + bytes(range(128, 256))), _table(b"0123456789"),
    _table(b".,;:?'\"()-"), _table(b"!#$%&*@^~+=<>"), _table(b"|"), _table(b"\\/[]{}_`"), _table(b"\n"),
], axis=1)


def features(shingle: Shingler, text: str | None) -> list[float]:
    data = (text or "").encode("utf-8", "surrogatepass")
    upper, letters, digit, stop, symbol, bar, other, lines = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _KINDS
    words = shingle.words(data)
    n = len(words)
    repeats = int((words[1:] == words[:-1]).sum()) if n else 0
    _, counts = np.unique(words, return_counts=True)
    distinct, top = len(counts), int(counts.max()) if n else 0
    marks = int(stop + symbol + bar + other)

    def share(part, whole, usual):
        return float(np.log((part + PRIOR_WEIGHT * usual) / (whole + PRIOR_WEIGHT)))

    cased = upper + letters
    return [float(np.log1p(n)), share(cased, n, 5.0), share(upper, cased, 0.04), share(digit, n, 0.05), share(stop, n, 0.15),
            share(symbol, n, 0.01), share(bar, n, 0.01), share(other, n, 0.01), share(repeats, n, 0.01),
            share(distinct, n, 0.9), share(top, n, 0.1), share(lines, n, 0.08), share(marks, cased, 0.03)]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingle = Shingler()
    for batch in batches:
        rows = [features(shingle, t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])


@dataclass(frozen=True)
class Model:
    """Means, Cholesky factors and constants of the two classes; none: no training rows."""

    means: tuple = ()
    factors: tuple = ()
    constants: tuple = ()

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means or not len(x):
            return np.full(len(x), 0.5)
        logs = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(constant - 0.5 * (z * z).sum(0))
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(training: DataFrame, d: int = len(FEATURES)) -> Model:
    """``training``: ``x`` (array of d doubles), ``label`` (0 or 1)."""
    x = [F.col("x")[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = (training.groupBy("label")
            .agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(x)],
                 *[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs]).collect())
    by = {int(r["label"]): r for r in sums}
    if set(by) != {0, 1} or min(r["n"] for r in by.values()) < 2:
        return Model()
    means, scatter, counts = {}, {}, {k: r["n"] for k, r in by.items()}
    for k, r in by.items():
        means[k] = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        s = np.zeros((d, d))
        for i, j in pairs:
            s[i, j] = s[j, i] = r[f"p{i}_{j}"]
        scatter[k] = s / r["n"] - np.outer(means[k], means[k])
    total = sum(counts.values())
    pooled = sum(counts[k] * scatter[k] for k in by) / total
    factors, constants = [], []
    for k in (0, 1):
        s = (1 - TO_POOLED) * scatter[k] + TO_POOLED * pooled
        s = (1 - TO_DIAGONAL) * s + TO_DIAGONAL * np.diag(np.diag(s)) + RIDGE * np.eye(d)
        factor = np.linalg.cholesky(s)
        factors.append(factor)
        constants.append(float(np.log(counts[k] / total) - np.log(np.diag(factor)).sum()))
    return Model((means[0], means[1]), tuple(factors), tuple(constants))


def _held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> tuple[Model, DataFrame]:
    """The model, and the features of all documents (``doc_id, x``)."""
    x = shared_table(texts(docs, id_col, text_col).mapInArrow(_features, "doc_id long, x array<double>"), "quality-features")
    known = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~_held_out(F.col("doc_id")))
    return fit(x.join(known, "doc_id")), x


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per document."""
    model, x = train(docs, labels, id_col, text_col, label_col)

    def run(batches):
        for batch in batches:
            rows = np.array(batch.column(1).to_pylist(), dtype=float).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(rows))], names=["doc_id", "score"])

    return x.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` that score 0.5 or more, each judged by its own text, without a
    shuffle of texts."""
    model, _ = train(docs, labels, id_col, text_col, label_col)
    at = docs.columns.index(text_col)

    def run(batches):
        shingle = Shingler()
        for batch in batches:
            rows = np.array([features(shingle, t.as_py()) for t in batch.column(at)]).reshape(batch.num_rows, len(FEATURES))
            yield batch.filter(pa.array(model.scores(rows) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
