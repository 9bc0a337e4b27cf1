"""Shared by the vector operators: distinct vectors, small fits, and block-wise meetings."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """True for a vector with only finite components, not all zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def as_matrix(column, dim: int | None = None) -> np.ndarray:
    """Arrays of numbers as a float64 matrix; shorter ones are padded with zeros to ``dim``."""
    rows = list(column)
    dim = dim or max((len(r) for r in rows), default=0)
    if all(len(r) == dim for r in rows):
        return np.array(rows, np.float64).reshape(len(rows), dim)
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, so nothing overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows (or one vector) times a power of two that brings the largest component to 0.5 up to 1.

    Exact, so no cosine changes, and squares neither overflow nor vanish.
    """
    _, e = np.frexp(np.abs(x).max(axis=-1, keepdims=True))
    return np.ldexp(x, -e)


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Of vectors from :func:`scaled`, with correctly rounded sums: equal vectors give equal scores wherever they are compared."""
    return math.fsum((a * b).tolist()) / (math.sqrt(math.fsum((a * a).tolist())) * math.sqrt(math.fsum((b * b).tolist())))


def square_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", c, c)[None, :] - 2.0 * (x @ c.T)
    return np.maximum(d, 0.0)


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """At most ``k`` centroids of the rows of ``x`` (Lloyd's rounds from distinct random rows)."""
    x0 = np.unique(x, axis=0)
    c = x0[np.random.default_rng(seed).permutation(len(x0))[:k]].copy()
    for _ in range(rounds):
        a = square_distances(x, c).argmin(1)
        n = np.bincount(a, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, a, x)
        c[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return c


def meetings(entries: DataFrame, queries: DataFrame, rows: int):
    """Group entries and queries that share ``key`` into blocks of about ``rows`` rows of each.

    Both tables have the same columns, with ``key`` and a long ``id``; ``role``
    is 0 for entries and 1 for queries.  A key with many rows is cut into blocks
    on either side and every pair of blocks is one group, so no group grows
    with a key and nothing is dropped.  The caller applies a function to the
    grouped result.
    """

    def blocks(t, name):
        return t.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))

    n = blocks(entries, "ne").join(blocks(queries, "nq"), "key")
    h = F.xxhash64("id")
    e = entries.join(n, "key").withColumn("eb", F.pmod(h, F.col("ne")).cast("int"))
    e = e.withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))).withColumn("role", F.lit(0))
    q = queries.join(n, "key").withColumn("qb", F.pmod(h, F.col("nq")).cast("int"))
    q = q.withColumn("eb", F.explode(F.sequence(F.lit(0), F.col("ne") - 1))).withColumn("role", F.lit(1))
    return e.unionByName(q).drop("ne", "nq").groupBy("key", "eb", "qb")
