"""Approximate nearest neighbours by an inverted multi-index.

Unit vectors are cut into two halves with a codebook each; a pair of centroids
is a cell.  A query walks the cells by the sum of its two distances with a heap
until it has met enough entries, whose exact cosines give a fifth-best
distance.  A second round visits every further cell whose bound (distance to
each centroid less the cell's radius in that half) does not exclude a better
entry, so the result is exact; on data without structure that is most cells.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_sample, stored, table
from .vectors import as_matrix, cosine, kmeans, meetings, scaled, square_distances, unit, usable

SAMPLE = 20_000
SHARD = 4_096
QUERIES = 1_024


class Cells:
    """Codebooks of both halves, and what every cell that is not empty holds."""

    def __init__(self, x: np.ndarray, per_half: int):
        self.half = (x.shape[1] + 1) // 2
        self.books = [kmeans(x[:, : self.half], per_half), kmeans(x[:, self.half :], per_half)]
        self.cells = np.zeros((0, 2), int)

    def halves(self, x):
        return [square_distances(h, c) for h, c in zip((x[:, : self.half], x[:, self.half :]), self.books)]

    def assign(self, x):
        d = self.halves(x)
        a, b = d[0].argmin(1), d[1].argmin(1)
        at = np.arange(len(x))
        return a, b, np.sqrt(d[0][at, a]), np.sqrt(d[1][at, b])

    def fill(self, stats) -> None:
        """``stats``: rows (a, b, n, ra, rb), one for each cell; sets shards of about SHARD entries."""
        stats = sorted((r["a"], r["b"], r["n"], r["ra"], r["rb"]) for r in stats)
        self.cells = np.array([s[:2] for s in stats], int).reshape(-1, 2)
        self.n = np.array([s[2] for s in stats], np.int64)
        self.radius = np.array([s[3:] for s in stats], float).reshape(-1, 2)
        self.shard = (np.cumsum(self.n) - self.n) // SHARD
        self.number = {(a, b): i for i, (a, b) in enumerate(self.cells.tolist())}

    def walk(self, da: np.ndarray, db: np.ndarray, enough: int) -> list[int]:
        """Cells by summed distance, until they hold ``enough`` entries."""
        oa, ob = np.argsort(da, kind="stable"), np.argsort(db, kind="stable")
        heap, seen, out, got = [(da[oa[0]] + db[ob[0]], 0, 0)], {(0, 0)}, [], 0
        while heap and got < enough:
            _, i, j = heapq.heappop(heap)
            c = self.number.get((int(oa[i]), int(ob[j])))
            if c is not None:
                out.append(c)
                got += int(self.n[c])
            for k, m in ((i + 1, j), (i, j + 1)):
                if k < len(oa) and m < len(ob) and (k, m) not in seen:
                    seen.add((k, m))
                    heapq.heappush(heap, (da[oa[k]] + db[ob[m]], k, m))
        return out

    def bounds(self, da: np.ndarray, db: np.ndarray) -> np.ndarray:
        """Least squared distance of the query to an entry of every cell."""
        a = np.maximum(np.sqrt(da)[self.cells[:, 0]] - self.radius[:, 0] - 1e-9, 0.0)
        b = np.maximum(np.sqrt(db)[self.cells[:, 1]] - self.radius[:, 1] - 1e-9, 0.0)
        return a * a + b * b


_ROW = "id long, key long, cell int, size int, vec binary, names array<long>, cells array<int>"


def _found(k: int, n_cells: int):
    def run(key, pdf):
        e, q = pdf[pdf["role"] == 0], pdf[pdf["role"] == 1]
        out = []
        if len(e) and len(q):
            ev = [np.frombuffer(v, "<f8") for v in e["vec"]]
            dim = max(max(map(len, ev)), max(len(v) // 8 for v in q["vec"]))
            ex = unit(as_matrix(ev, dim))
            cell, size, names = e["cell"].to_numpy(int), e["size"].to_numpy(), e["names"].tolist()
            for qid, qv, qs, cells in zip(q["id"], q["vec"], q["size"], q["cells"]):
                may = np.zeros(n_cells, bool)
                may[np.asarray(cells, int)] = True
                at = np.flatnonzero(may[cell] & (size == qs))
                if not len(at):
                    continue
                v = np.frombuffer(qv, "<f8")
                near = ex[at, : len(v)] @ unit(v[None, :])[0]
                if len(at) > k + 1:
                    least = np.partition(near, -(k + 1))[-(k + 1)] - 1e-9
                    at = at[near >= least]
                for i in at:
                    out.append((qid, names[i], cosine(v, ev[i])))
        return pd.DataFrame(out, columns=["qid", "names", "score"])

    return run


def _best(found: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(qid, query_id, rank, vec_id, score): the best ``k`` of each query, its own id left out."""
    w = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.join(queries.select(F.col("id").alias("qid"), "query_id"), "qid")
        .select("qid", "query_id", F.explode("names").alias("vec_id"), "score")
        .filter(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
    )


def search(
    vectors: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 5,
    per_half: int | None = None,
    first_share: float = 0.05,
    sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each row that ``is_query`` (a Column) marks.

    Nearness is the cosine in double precision on the vectors as given, ties go
    to the smaller vec_id, and all candidates are returned where there are
    fewer.  Null, empty or zero vectors, vectors with null or non-finite
    components and rows with a null id take no part; vectors are compared with
    those of their own length only.  Equal vectors are one entry that carries
    its k + 1 smallest ids, all that a result can use.  A query that repeats
    with the same id and vector is answered once; a candidate with the query's
    own id is left out.

    Codebooks are fitted on at most about ``2 sample`` distinct vectors; all
    vectors are indexed.  ``per_half`` defaults to the square root of a
    fiftieth of the entries, 4 to 128, which bounds the table of cells that the
    driver keeps.  The first round walks until ``first_share`` of the entries,
    and 100 at least, are met.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"), is_query.alias("q")
    ).filter(usable(F.col("v")) & F.col("vec_id").isNotNull())
    once = rows.select("v", "vec_id").distinct()
    low = once.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    entries = stored(
        low.groupBy("v")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("names"))
        .withColumn("id", F.monotonically_increasing_id()),
        "imi-vectors",
    )
    queries = stored(
        rows.filter("q").select("v", F.col("vec_id").alias("query_id")).distinct().withColumn("id", F.monotonically_increasing_id()),
        "imi-queries",
    )
    total = entries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    empty = queries.select("query_id", F.lit(0).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    if not total["n"] or not queries.take(1):
        return empty
    dim = total["d"]
    taken = bounded_sample(entries, None, sample, F.xxhash64("v"), total["n"]).select("v")
    index = Cells(unit(as_matrix([r["v"] for r in taken.collect()], dim)), per_half or int(min(128, max(4, (total["n"] / 50) ** 0.5))))

    def assigned(batches):
        for pdf in batches:
            if len(pdf):
                a, b, ra, rb = index.assign(unit(as_matrix(pdf["v"], dim)))
                yield pd.DataFrame({"id": pdf["id"].to_numpy(), "a": a, "b": b, "ra": ra, "rb": rb})

    cells = stored(entries.select("id", "v").mapInPandas(assigned, "id long, a int, b int, ra double, rb double"), "imi-cells")
    index.fill(
        cells.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("ra").alias("ra"), F.max("rb").alias("rb")).collect()
    )

    def put(batches):
        for pdf in batches:
            if len(pdf):
                cell = [index.number[x] for x in zip(pdf["a"].tolist(), pdf["b"].tolist())]
                yield pd.DataFrame(
                    {
                        "id": pdf["id"].to_numpy(),
                        "key": index.shard[cell],
                        "cell": cell,
                        "size": pdf["v"].map(len).to_numpy(),
                        "vec": [scaled(np.asarray(v, "<f8")).tobytes() for v in pdf["v"]],
                        "names": pdf["names"],
                        "cells": None,
                    }
                )

    put_in = stored(entries.join(cells.select("id", "a", "b"), "id").select("id", "v", "names", "a", "b").mapInPandas(put, _ROW), "imi-index")
    enough = max(100, int(first_share * total["n"]))

    def asked(second: bool):
        """A row for each shard that holds a cell which the query visits in this round."""

        def run(batches):
            for pdf in batches:
                out = []
                if len(pdf):
                    x = unit(as_matrix(pdf["v"], dim))
                    da, db = index.halves(x)
                    worst = pdf["worst"].tolist() if second else [None] * len(pdf)
                    for qid, v, a, b, s in zip(pdf["id"], pdf["v"], da, db, worst):
                        visit = np.array(index.walk(a, b, enough), int)
                        if second:
                            more = np.ones(len(index.n), bool)
                            if s is not None and s == s:
                                more = index.bounds(a, b) <= 2.0 - 2.0 * s + 1e-9
                            more[visit] = False
                            visit = np.flatnonzero(more)
                        raw = scaled(np.asarray(v, "<f8")).tobytes()
                        for shard in np.unique(index.shard[visit]):
                            out.append((qid, int(shard), None, len(v), raw, None, visit[index.shard[visit] == shard].tolist()))
                yield pd.DataFrame(out, columns=["id", "key", "cell", "size", "vec", "names", "cells"])

        return run

    def round_of(asking: DataFrame) -> DataFrame:
        both = meetings(put_in, asking, max(SHARD, QUERIES))
        return stored(both.applyInPandas(_found(k, len(index.n)), "qid long, names array<long>, score double"), "imi-found")

    first = round_of(stored(queries.select("id", "v").mapInPandas(asked(False), _ROW), "imi-first"))
    reached = (
        _best(first, queries, k).groupBy("qid").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("s"))
    ).select("qid", F.when(F.col("c") >= k, F.col("s")).alias("worst"))
    again = queries.join(reached, F.col("id") == F.col("qid"), "left").select("id", "v", "worst")
    second = round_of(stored(again.mapInPandas(asked(True), _ROW), "imi-second"))
    return _best(first.unionByName(second), queries, k).select("query_id", "rank", "vec_id", "score")


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
