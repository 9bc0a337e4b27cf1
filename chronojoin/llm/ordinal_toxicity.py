"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = logistic(t_k - w.x): one weight vector for all grades, shared
by the ordered thresholds t_0 < t_1 < ...  A text's features are the hashed
words, and hashed word beginnings, that it contains.  How many labelled texts
hold each feature is counted over a large bounded sample; every feature of enough texts
whose odds differ at all between the grades gets a weight of either sign, held
down by an L2 penalty relative to that difference.  No feature is cut for being
rare, so a wide vocabulary of rare words counts as much as a few common ones.
The fit is a limited-memory quasi-Newton search on a sample that is bounded in
rows and in entries.  The output is the expected grade.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, chunks_of_texts, small_batches, stored, table
from .shingles import word_hashes

BITS = 18
PREFIX = 5
COUNTED = 40_000
SAMPLE = 4_000
ENTRIES = 8_000_000
SUPPORT = 3
L2 = 1e-4
CHUNK_CHARS = 1_000_000
GRADES = 3
MOST_GRADES = 100


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


def features(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(doc, feature): hashed words and word beginnings of each text, sorted by doc and feature."""
    doc, h, p = word_hashes(texts, PREFIX)
    top = np.uint64(64 - BITS)
    f = np.concatenate([(h >> top), (p >> top) + np.uint64(1 << BITS)]).astype(np.int64)
    key = np.concatenate([doc, doc]) * (2 << BITS) + f
    key = np.unique(key)
    return key >> (BITS + 1), key & ((2 << BITS) - 1)


@dataclass
class OrdinalModel:
    """Shared weights, increasing thresholds between the grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def linear(self, texts: list) -> np.ndarray:
        """w.x of every text."""
        doc, h, p = word_hashes(texts, PREFIX)
        top = np.uint64(64 - BITS)
        out = np.zeros(len(texts))
        for part, shift in ((h, 0), (p, 1 << BITS)):
            f = (part >> top).astype(np.int64) + shift
            used = self.weights[f] != 0.0
            key = np.unique(doc[used] * (2 << BITS) + f[used])
            out += np.bincount(key >> (BITS + 1), weights=self.weights[key & ((2 << BITS) - 1)], minlength=len(texts))
        return out

    def grades(self, linear: np.ndarray) -> np.ndarray:
        """texts x grades: probabilities."""
        c = _logistic(self.thresholds[None, :] - linear[:, None])
        c = np.hstack([np.zeros((len(linear), 1)), c, np.ones((len(linear), 1))])
        return np.diff(c, axis=1)


def lowest(f, x: np.ndarray, rounds: int = 300, memory: int = 10, flat: float = 1e-6) -> np.ndarray:
    """The minimum of a smooth convex function; ``f`` gives (value, gradient).  L-BFGS with a halving line search."""
    value, g = f(x)
    past: list = []
    for _ in range(rounds):
        d = -g
        steps = []
        for s, y, r in reversed(past):
            a = r * (s @ d)
            d = d - a * y
            steps.append(a)
        if past:
            s, y, _ = past[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y, r), a in zip(past, reversed(steps)):
            d = d + (a - r * (y @ d)) * s
        slope = g @ d
        if slope >= 0:
            past, d, slope = [], -g, -(g @ g)
        size = 1.0 if past else min(1.0, 1.0 / max(np.abs(g).sum(), 1e-12))
        while size > 1e-12:
            new_value, new_g = f(x + size * d)
            if new_value <= value + 1e-4 * size * slope:
                break
            size *= 0.5
        else:
            break
        s, y = size * d, new_g - g
        if s @ y > 1e-12 * (y @ y):
            past = [*past[-memory + 1 :], (s, y, 1.0 / (s @ y))]
        x, done = x + s, np.abs(new_g).max() < flat
        value, g = new_value, new_g
        if done:
            break
    return x


def loss(x: np.ndarray, doc: np.ndarray, col: np.ndarray, scale: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float):
    """(penalised mean negative log likelihood, gradient) at ``x``: the weights over ``scale``, the first threshold, log steps to the next.

    ``weight`` sums to one.
    """
    top, n_cols = int(y.max()), len(scale)
    u, steps = x[:n_cols], np.exp(x[n_cols + 1 :])
    w = scale * u
    t = x[n_cols] + np.concatenate([[0.0], np.cumsum(steps)])
    z = np.bincount(doc, weights=w[col], minlength=len(y))
    upper = np.where(y < top, _logistic(t[np.minimum(y, top - 1)] - z), 1.0)
    lower = np.where(y > 0, _logistic(t[np.maximum(y - 1, 0)] - z), 0.0)
    p = np.maximum(upper - lower, 1e-300)
    du, dl = weight * upper * (1 - upper) / p, weight * lower * (1 - lower) / p
    gt = np.zeros(top)
    np.add.at(gt, np.minimum(y, top - 1), np.where(y < top, -du, 0.0))
    np.add.at(gt, np.maximum(y - 1, 0), np.where(y > 0, dl, 0.0))
    gw = scale * np.bincount(col, weights=(du - dl)[doc], minlength=n_cols) + l2 * u
    later = np.cumsum(gt[::-1])[::-1]
    return -(weight @ np.log(p)) + 0.5 * l2 * (u @ u), np.concatenate([gw, [gt.sum()], later[1:] * steps])


def signal(held: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How far each feature's odds differ between grade 0 and the others, beyond one standard error, at least 0.

    ``held``: features x 2, the texts of grade 0 and of the others that hold the
    feature, counted over marked texts; ``n`` the texts of either kind.  The
    fit penalises a weight relative to it: words that show nothing cost much,
    rare words that only one side has cost little.
    """
    a, b = held[:, 1] + 0.5, held[:, 0] + 0.5
    odds = np.log(a / (n[1] + 1.0)) - np.log(b / (n[0] + 1.0))
    return np.maximum(np.abs(odds) - np.sqrt(1.0 / a + 1.0 / b), 0.0)


def fit(
    doc: np.ndarray,
    feature: np.ndarray,
    y: np.ndarray,
    weight: np.ndarray,
    scale: np.ndarray | None = None,
    l2: float = L2,
    rounds: int = 120,
) -> OrdinalModel:
    """The model of documents 0 ... len(y) - 1 with sorted binary features and grades 0 ... K - 1 (K >= 2).

    ``scale`` (default: one for all) is the size a feature's weight is penalised
    by; at 0 it has no weight.  ``weight`` is how many documents each one stands for.
    """
    top = int(y.max())
    scale = np.ones(2 << BITS) if scale is None else scale
    names = np.unique(feature[scale[feature] > 0])
    keep = scale[feature] > 0
    doc, col = doc[keep], np.searchsorted(names, feature[keep])
    weight = weight / weight.sum()
    at = np.clip(np.cumsum([weight[y == k].sum() for k in range(top)]), 1e-6, 1 - 1e-6)
    t = np.log(at / (1 - at))
    start = np.concatenate([np.zeros(len(names)), t[:1], np.log(np.maximum(np.diff(t), 1e-3))])
    x = lowest(lambda v: loss(v, doc, col, scale[names], y, weight, l2), start, rounds)
    out = np.zeros(2 << BITS)
    out[names] = scale[names] * x[: len(names)]
    return OrdinalModel(out, x[len(names)] + np.concatenate([[0.0], np.cumsum(np.exp(x[len(names) + 1 :]))]))


def severity_grades(doc: np.ndarray, feature: np.ndarray, toxic: np.ndarray, two: OrdinalModel, grades: int) -> np.ndarray:
    """Grades of documents that are only marked toxic or not: 0 for clean ones, 1 ... ``grades`` by evidence.

    A toxic document's evidence is the sum of its words' positive weights in
    the model ``two`` of both marks; quantiles of it cut the toxic documents into
    grades of about equal size (ties stay together, so there may be fewer).
    """
    word = feature < (1 << BITS)
    gain = np.maximum(two.weights[feature[word]], 0.0)
    evidence = np.bincount(doc[word], weights=gain, minlength=len(toxic)).round(6)
    y = np.zeros(len(toxic), int)
    if toxic.any():
        cuts = np.quantile(evidence[toxic], np.arange(1, grades) / grades)
        y[toxic] = 1 + np.searchsorted(cuts, evidence[toxic], side="left")
    return np.unique(y, return_inverse=True)[1] if len(y) else y


def feature_counts(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(features x 2, 2): the texts with y = 0 and with another y that hold each feature, and all of either, over ``texts`` (text, y).

    At most one row of sums a feature reaches the driver.
    """

    def counted(batches):
        total, n = np.zeros((2, 2 << BITS), np.int64), np.zeros(2, np.int64)
        for pdf in batches:
            rows, y = pdf["text"].tolist(), pdf["y"].to_numpy()
            n += np.bincount(y != 0, minlength=2)
            for a, b in chunks_of_texts(rows, CHUNK_CHARS):
                d, f = features(rows[a:b])
                for k in (0, 1):
                    total[k] += np.bincount(f[(y[a:b][d] != 0) == k], minlength=2 << BITS)
        some = np.flatnonzero(total.sum(0))
        yield pd.DataFrame({"f": [-1, *some], "n0": [n[0], *total[0, some]], "n1": [n[1], *total[1, some]]})

    got = texts.select("text", "y").mapInPandas(counted, "f int, n0 long, n1 long")
    got = got.groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    got = got.filter((F.col("f") < 0) | (F.col("n0") + F.col("n1") >= SUPPORT)).toPandas()
    out, n = np.zeros((2 << BITS, 2), np.int64), np.zeros(2, np.int64)
    of_texts = got["f"].to_numpy() < 0
    out[got["f"].to_numpy()[~of_texts]] = got[["n0", "n1"]].to_numpy()[~of_texts]
    return out, n + got[["n0", "n1"]].to_numpy()[of_texts].sum(0)


def learn(
    texts: DataFrame, marks: DataFrame, grades: int = GRADES, sample: int = SAMPLE, entries: int = ENTRIES, counted: int = COUNTED
) -> OrdinalModel | None:
    """The model of ``texts`` (_id, text) marked by ``marks`` (_id, y).

    Features are counted over the texts of at most about ``2 counted`` marks of
    each y; one of at least ``SUPPORT`` of them can get a weight (see :func:`signal`).  The fit takes at most about ``2 sample`` marks of each
    y, chosen by a hash of the id, and fewer where their texts are so long that
    they would hold more than ``entries`` such features; only these reach the
    driver.  y of 0 and 1 are turned into ``severity_grades``; with other values
    (at most ``MOST_GRADES`` different ones) y is the grade itself.  None without
    two different grades.
    """

    counts = marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).limit(MOST_GRADES + 1).collect()
    if len(counts) > MOST_GRADES:
        raise ValueError(f"more than {MOST_GRADES} grades")
    every = {r["y"]: r["n"] for r in counts}
    if len(every) < 2:
        return None
    # ids and marks of a bounded sample meet the texts where these are, so no text is shuffled
    held, n = feature_counts(texts.join(F.broadcast(bounded_sample(marks, "y", counted, F.xxhash64("_id"))), "_id"))
    scale = np.where(held.sum(1) > 0, signal(held, n), 0.0)
    good = scale > 0
    k = min(sample, max(100, int(entries / len(every) / max(1.0, held[good].sum() / max(1, n.sum())))))

    def kept(batches):
        for pdf in batches:
            rows = pdf["text"].tolist()
            for a, b in chunks_of_texts(rows, CHUNK_CHARS):
                d, f = features(rows[a:b])
                d, f = d[good[f]], f[good[f]]
                cut = np.searchsorted(d, np.arange(b - a + 1))
                yield pd.DataFrame({"y": pdf["y"].to_numpy()[a:b], "f": [f[i:j].astype(np.int32) for i, j in zip(cut, cut[1:])]})

    taken = texts.join(F.broadcast(bounded_sample(marks, "y", k, F.xxhash64("_id"))), "_id").select("text", "y")
    got = stored(taken.mapInPandas(kept, "y int, f array<int>"), "toxicity-train").toPandas()
    if not len(got) or got["y"].nunique() < 2:
        return None
    y = got["y"].to_numpy()
    weight = got["y"].map(every).to_numpy() / got["y"].map(got["y"].value_counts()).to_numpy()
    doc = np.repeat(np.arange(len(got), dtype=np.int32), got["f"].map(len).to_numpy())
    feature = np.concatenate(got["f"].tolist()).astype(np.int32)
    del got
    if set(np.unique(y)) <= {0, 1}:
        two = fit(doc, feature, y, weight, scale, rounds=60)
        y = severity_grades(doc, feature, y == 1, two, grades)
    else:
        y = np.unique(y, return_inverse=True)[1]
    return fit(doc, feature, y, weight, scale)


def grade(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    grades: int = GRADES,
) -> DataFrame:
    """(doc_id, held_out, expected_severity, severity, p_toxic, toxic) of every row.

    expected_severity is the mean of the grade's distribution, severity its
    mode, p_toxic the probability of a grade above 0, and toxic whether that is
    0.5 or more.  Labels count where crc32(doc_id) mod 5 is not 0.  Whole texts
    are scored.  Null and empty texts have no features and get the grades of the
    thresholds alone; a null doc_id is scored but not learned from; repeated rows
    each get a row.  Without two different labels every severity is 0.
    """
    small_batches(docs.sparkSession)
    part = F.crc32(F.col(id_col).cast("long").cast("string")) % 5
    y = labels.filter(F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("y")
    )
    y = y.filter(F.crc32(F.col("_id").cast("string")) % 5 != 0)
    model = learn(docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")), y, grades)

    def run(batches):
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in chunks_of_texts(texts, CHUNK_CHARS):
                out = pdf[["doc_id", "held_out"]].iloc[a:b].copy()
                p = model.grades(model.linear(texts[a:b])) if model else np.ones((b - a, 1))
                out["expected_severity"] = p @ np.arange(p.shape[1])
                out["severity"] = p.argmax(1)
                out["p_toxic"] = 1.0 - p[:, 0]
                out["toxic"] = p[:, 0] <= 0.5
                yield out

    src = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(part == 0, F.lit(False)).alias("held_out"), F.col(text_col).alias("text")
    )
    return src.mapInPandas(
        run, "doc_id long, held_out boolean, expected_severity double, severity int, p_toxic double, toxic boolean"
    )


def op3_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
