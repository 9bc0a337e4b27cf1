"""Quality classifier: regularised quadratic discriminant on document statistics.

Every text becomes a short vector of transformed statistics (logs and
logits).  Per class the mean and the covariance come from one distributed sum
of x and x x^T over all labelled training rows; the covariance is shrunk
towards the pooled one and towards a scaled identity, its Cholesky factor is
kept in the model, and the score is the logistic of the difference of the two
Gaussian log densities (Mahalanobis distances and log determinants) plus the
log prior odds.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

FEATURES = [
    "log_words", "log_word_len", "log_line_len", "upper", "digit", "mark", "space", "distinct_words", "top_word",
    "repeated_lines", "repeated_pairs", "compressed", "word_end_marks", "long_words", "stops",
]
_MARKS = re.compile(r"[^\w\s]")
_RUNS = re.compile(r"[^\w\s]{2,}")
_SENT = re.compile(r"[.!?](?=\s|$)")


def _logit(part: float, whole: float) -> float:
    p = (part + 0.5) / (whole + 1.0)
    return math.log(p / (1.0 - p)) if p < 1.0 else 8.0


def _compressed(raw: bytes) -> float:
    """Share of bytes left by deflate, over the whole text."""
    if not raw:
        return 1.0
    return len(zlib.compress(raw, 1)) / (len(raw) + 20.0)


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text; null counts as empty."""
    t = text or ""
    n = len(t)
    words = t.split()
    w = len(words)
    lines = [x for x in t.split("\n") if x.strip()]
    seen = Counter(words)
    pairs = set(zip(words, words[1:]))
    upper = sum(map(str.isupper, words))
    letters_run = len(_RUNS.findall(t))
    marks = len(_MARKS.findall(t))
    digits = sum(t.count(c) for c in "0123456789")
    spaces = w - 1 + t.count("\n") if w else n
    return [
        math.log1p(w),
        math.log1p(n / (w + 1.0)),
        math.log1p(n / (len(lines) + 1.0)),
        _logit(upper, w),
        _logit(digits, n),
        _logit(marks, n),
        _logit(max(spaces, 0), n),
        _logit(len(seen), w),
        _logit(max(seen.values(), default=0), w),
        _logit(len(lines) - len(set(lines)), len(lines)),
        _logit(max(w - 1 - len(pairs), 0), max(w - 1, 0)),
        math.log(_compressed(t.encode("utf-8", "surrogatepass")) + 0.01),
        _logit(letters_run, w),
        _logit(sum(len(x) > 20 for x in words), w),
        _logit(len(_SENT.findall(t)), w),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x array<double>) of every row; each whole text is read once."""
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "x": [statistics(t) for t in pdf["text"]]})

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInPandas(run, "id long, x array<double>")


@dataclass
class QuadraticModel:
    """Class means, Cholesky factors and log determinants, with the log prior odds of class 1."""

    mean: list[np.ndarray]
    chol: list[np.ndarray]
    logdet: list[float]
    log_odds: float
    centre: np.ndarray
    scale: np.ndarray

    def log_density_difference(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8.0, 8.0)
        logs = []
        for m, c, d in zip(self.mean, self.chol, self.logdet):
            y = np.linalg.solve(c, (z - m).T)
            logs.append(-0.5 * (np.einsum("ij,ij->j", y, y) + d))
        return logs[1] - logs[0] + self.log_odds

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_density_difference(x), -40.0, 40.0)))


def fit(labelled: DataFrame, to_pooled: float = 0.3, to_identity: float = 0.05) -> QuadraticModel | None:
    """The model of ``labelled`` (x array<double>, y int 0/1); rows with another y are ignored.

    One aggregation sums the class counts, x and the upper triangle of x x^T
    over all rows, so the driver gets 2 x (1 + d + d (d + 1) / 2) numbers at any
    input size.  None when a class has no row.
    """
    d = len(FEATURES)
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]
    prods = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    got = {
        r["y"]: r
        for r in labelled.filter(F.col("y").isin(0, 1)).groupBy("y").agg(F.count(F.lit(1)).alias("n"), *sums, *prods).collect()
    }
    if set(got) != {0, 1}:
        return None
    n = np.array([got[y]["n"] for y in (0, 1)], float)
    s = np.array([[got[y][f"s{i}"] for i in range(d)] for y in (0, 1)])
    p = np.zeros((2, d, d))
    for y in (0, 1):
        for i in range(d):
            for j in range(i, d):
                p[y, i, j] = p[y, j, i] = got[y][f"p{i}_{j}"]
    centre = s.sum(0) / n.sum()
    var = np.diag(p.sum(0)) / n.sum() - centre**2
    scale = np.sqrt(np.maximum(var, 1e-6))
    means, covs = [], []
    for y in (0, 1):
        m = s[y] / n[y]
        c = (p[y] / n[y] - np.outer(m, m)) / np.outer(scale, scale)
        means.append((m - centre) / scale)
        covs.append(c)
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / n.sum()
    chols, dets = [], []
    for c in covs:
        c = (1 - to_pooled) * c + to_pooled * pooled
        c = (1 - to_identity) * c + to_identity * (np.trace(c) / d + 1e-3) * np.eye(d)
        low = np.linalg.cholesky(c)
        chols.append(low)
        dets.append(2.0 * float(np.log(np.diag(low)).sum()))
    return QuadraticModel(means, chols, dets, float(np.log(n[1] / n[0])), centre, scale)


def score(stats: DataFrame, model: QuadraticModel | None) -> DataFrame:
    """(id, score) of every row of ``document_statistics``; 0.5 everywhere without a model."""
    @F.pandas_udf("double")
    def of(x: pd.Series) -> pd.Series:
        if model is None or not len(x):
            return pd.Series(np.full(len(x), 0.5))
        return pd.Series(model.score(np.vstack(x.to_numpy())))

    return stats.select("id", of("x").alias("score"))


THRESHOLD = 0.3


def _trained(stats: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> QuadraticModel | None:
    y = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
    train = stats.filter(F.crc32(F.col("id").cast("string")) % 5 != 0)
    return fit(train.join(y.filter(F.col("y").isin(0, 1)), "id").select("x", "y"))


def accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """The rows of ``docs`` with a score of ``THRESHOLD`` or more, with all their columns.

    The statistics are computed once for the training join and once more in the
    filter: cheaper at scale than a shuffle that carries every text.
    """
    stats = stored(document_statistics(docs, id_col, text_col), "quality-stats")
    model = _trained(stats, labels, id_col, label_col)

    @F.pandas_udf("boolean")
    def keep(text: pd.Series) -> pd.Series:
        if model is None or not len(text):
            return pd.Series(np.ones(len(text), bool))
        return pd.Series(model.score(np.array([statistics(t) for t in text])) >= THRESHOLD)

    return docs.filter(keep(F.col(text_col)))


def train_and_score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Labels count where crc32(doc_id) mod 5 is not 0 and a label of 0 or 1 is
    there; a document with several labels counts once for each, a label without
    document not at all.  Null and empty texts get the score of their (empty)
    statistics; a null doc_id is scored, is never trained on, and counts as
    not held out.  Repeated rows each get a row.  Without labels of both classes
    every score is 0.5.
    """
    stats = stored(document_statistics(docs, id_col, text_col), "quality-stats")
    part = F.crc32(F.col("id").cast("string")) % 5
    return score(stats, _trained(stats, labels, id_col, label_col)).select(
        F.col("id").alias("doc_id"),
        F.coalesce(part == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= F.lit(THRESHOLD)).cast("int").alias("predicted"),
    )


def op8_quality_rda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
