"""Near duplicates of embeddings by product quantisation.

Distinct unit vectors are put into coarse inverted lists; the residual to the
list's centroid is coded in subspaces.  A vector probes every lower-numbered list
whose bisector lies within the length of the longest link.  Inside a list the asymmetric
distances of the probing vectors to the codes, looked up in the codebooks, are one
matrix product; with the length of what the code leaves out they bound the true
distance from below, so the filter loses nothing, and what passes is decided by
the exact cosine.  Neighbouring lists share a shelf, and a vector is sent once to
each shelf with a list that it probes, not once to each list.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, drop_stored, stored, table
from .graph import connected_components
from .vectors import as_matrix, cosine, kmeans, meetings, scaled, square_distances, unit, usable

SAMPLE = 20_000
# rows of a shelf and of a block of queries: at most BLOCK and BLOCK_BYTES of numbers; fewer of small tables, to keep cores busy
BLOCK = 32_768
BLOCK_BYTES = 16 << 20
MAX_LISTS = 2_048


class Quantiser:
    """Coarse centroids and subspace codebooks, fitted on a bounded sample."""

    def __init__(self, x: np.ndarray, lists: int, radius: float, parts: int = 8, codes: int = 256):
        self.dim = x.shape[1]
        self.radius = radius
        self.coarse = kmeans(x, lists)
        near = square_distances(x, self.coarse).argmin(1)
        self.share = np.bincount(near, minlength=len(self.coarse)) / len(x)
        rest = x - self.coarse[near]
        self.cuts = np.linspace(0, self.dim, min(parts, self.dim) + 1).astype(int)
        self.books = [kmeans(rest[:, a:b], codes) for a, b in zip(self.cuts, self.cuts[1:])]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "between"}  # tasks compute it themselves

    @functools.cached_property
    def between(self) -> np.ndarray:
        """Distances of the centroids of every two lists."""
        return np.sqrt(square_distances(self.coarse, self.coarse))

    def shelves(self, n: int, rows: int) -> np.ndarray:
        """The shelf of every list: lists that follow each other, about ``rows`` of ``n`` vectors by the sample's shares."""
        before = np.cumsum(self.share) - self.share
        return (before * n / rows + 1e-9).astype(np.int64)

    def probes(self, x: np.ndarray, home: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """rows x lists: whether a row looks into the list, its own one or a lower-numbered one that may hold a link."""
        own = x - self.coarse[home]
        d = square_distances(x, self.coarse[lists]) - np.einsum("ij,ij->i", own, own)[:, None]
        # a link no longer than the radius crosses a bisector only from within the radius of it; the slack is for rounding
        near = d <= 2.0 * self.between[:, lists][home] * self.radius + 1e-6
        return (near & (lists[None, :] < home[:, None])) | (lists[None, :] == home[:, None])

    def encode(self, x: np.ndarray):
        """List, codes, length of what the code leaves out, and the mask of probed lists of every row."""
        home = square_distances(x, self.coarse).argmin(1)
        rest = x - self.coarse[home]
        codes = np.empty((len(x), len(self.books)), np.uint8)
        left = np.zeros(len(x))
        for m, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            dm = square_distances(rest[:, a:b], self.books[m])
            codes[:, m] = dm.argmin(1)
            left += dm.min(1)
        return home, codes, np.sqrt(left), self.probes(x, home, np.arange(len(self.coarse)))

    def decode(self, home: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What the codes stand for: the centroids of the lists and the codewords of all subspaces."""
        out = self.coarse[home]
        for m, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            out[:, a:b] += self.books[m][codes[:, m]]
        return out


_ROW = "id long, shelf long, reach array<long>, home long, n long, size int, vec binary, codes binary, beyond double"


def _links(quantiser: Quantiser, threshold: float, kind: str):
    """Grouped function: (kind, id, other, n): links counted for each vector, and a spanning set of the links."""

    def vectors(pdf):
        return scaled(np.frombuffer(b"".join(pdf["vec"]), kind).reshape(len(pdf), -1).astype(np.float64))

    def run(key, pdf):
        e, q = pdf[pdf["role"] == 0], pdf[pdf["role"] == 1]
        eid, qid = e["id"].to_numpy(), q["id"].to_numpy()
        e_links, q_links, edges = np.zeros(len(e), np.int64), np.zeros(len(q), np.int64), []
        if len(e) and len(q):
            given_e, given_q = vectors(e), vectors(q)
            ex, qx = unit(given_e), unit(given_q)
            eh, qh = e["home"].to_numpy(), q["home"].to_numpy()
            en, qn = e["n"].to_numpy(), q["n"].to_numpy()
            es, qs = e["size"].to_numpy(), q["size"].to_numpy()
            shown = quantiser.decode(eh, np.frombuffer(b"".join(e["codes"]), np.uint8).reshape(len(e), -1))
            lengths = np.einsum("ij,ij->i", shown, shown)
            # |q - y|^2 = 1 + |y|^2 - 2 q.y <= limit; single precision is right to within the slack
            limit = (quantiser.radius + e["beyond"].to_numpy() + 1e-7) ** 2
            slack = 4 * (quantiser.dim + 8) * float(np.finfo(np.float32).eps) * (1 + np.sqrt(lengths)) ** 2
            least = ((1 + lengths - limit - slack) / 2).astype(np.float32)
            q32, e32 = qx.astype(np.float32), shown.astype(np.float32)
            lists = np.unique(eh)
            asked = quantiser.probes(qx, qh, lists)
            for at, probing in zip(lists, asked.T):
                mine, theirs = np.flatnonzero(eh == at), np.flatnonzero(probing)
                for j0 in range(0, len(mine), 2_048):
                    js = mine[j0 : j0 + 2_048]
                    own = np.ascontiguousarray(e32[js].T)
                    for i0 in range(0, len(theirs), 512):
                        rows = theirs[i0 : i0 + 512]
                        i, j = np.divmod(np.flatnonzero(q32[rows] @ own >= least[js]), len(js))
                        i, j = rows[i], js[j]
                        # inside the home list each pair is met twice: once as (smaller, larger)
                        ok = (qs[i] == es[j]) & ((qh[i] != at) | (qid[i] < eid[j]))
                        i, j = i[ok], j[ok]
                        keep = [np.zeros(0, bool)]
                        for c in range(0, len(i), 50_000):
                            s = slice(c, c + 50_000)
                            near = np.einsum("ij,ij->i", qx[i[s]], ex[j[s]])
                            keep.append(near >= threshold)
                            # so close to the threshold the cosine of the vectors as given decides, not that of their rounded units
                            for t in np.flatnonzero(np.abs(near - threshold) < 1e-12):
                                keep[-1][t] = cosine(given_q[i[s][t]], given_e[j[s][t]]) >= threshold
                        keep = np.concatenate(keep)
                        i, j = i[keep], j[keep]
                        if len(i):
                            q_links += np.bincount(i, weights=en[j], minlength=len(q)).astype(np.int64)
                            e_links += np.bincount(j, weights=qn[i], minlength=len(e)).astype(np.int64)
                            edges.append(_forest(qid[i], eid[j]))
        if not edges:
            return pd.DataFrame({"kind": [], "id": [], "other": [], "n": []}, dtype="int64")
        edges = pd.concat(edges)
        return pd.concat([_counted(qid, q_links), _counted(eid, e_links), _forest(edges["id"].to_numpy(), edges["other"].to_numpy())], ignore_index=True)

    return run


def _counted(ids, total) -> pd.DataFrame:
    some = np.flatnonzero(total)
    return pd.DataFrame({"kind": 0, "id": ids[some], "other": 0, "n": total[some]})


def _forest(u: np.ndarray, v: np.ndarray) -> pd.DataFrame:
    """At most one edge for each vector: every vector with the smallest that its links reach here."""
    names, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    low = np.arange(len(names))
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            break
        low = new
    other = names[low]
    far = other != names
    return pd.DataFrame({"kind": 1, "id": names[far], "other": other[far], "n": 0})


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = 0.95,
    lists: int | None = None,
    sample: int = SAMPLE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Rows are linked at a cosine of ``threshold`` or more (double precision, on
    the vectors as given, which may be very large or small);
    n_links counts the other rows linked directly, component_id is the smallest
    id reachable by links, kept says whether it is the row's own.  Vectors that
    are null, empty, zero or hold null or non-finite components, and vectors of
    different lengths, link with nothing.  Equal vectors are one entry with a
    count, whatever their ids.  A null id is ignored by component_id.

    The index is fitted on at most about ``2 sample`` distinct vectors; every
    vector is coded and searched.  ``lists`` defaults to half the square root
    of the number of distinct vectors, 8 to ``MAX_LISTS``; give more for billions of vectors.  A list is probed where the
    bisector to it lies within the length of the longest link, so no link is lost;
    vectors without structure are then compared with most of the others.
    """
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("v"))
    good = usable(F.col("v"))
    distinct = (
        rows.filter(good).groupBy("v").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"))
    ).withColumn("id", F.monotonically_increasing_id())
    distinct = stored(distinct, "pq-vectors")
    total = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    if not total["n"]:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    dim = total["d"]
    taken = bounded_sample(distinct, None, sample, F.xxhash64("v"), total["n"]).select("v")
    x = unit(as_matrix([r["v"] for r in taken.collect()], dim))
    k = lists or int(min(MAX_LISTS, max(8, np.sqrt(total["n"]) / 2)))
    quantiser = Quantiser(x, k, float(np.sqrt(max(2.0 - 2.0 * threshold, 0.0))))

    rows_a_block = min(BLOCK, max(2_048, total["n"] // 16), max(256, BLOCK_BYTES // (8 * dim)))
    shelf = quantiser.shelves(total["n"], rows_a_block)
    # numbers of single precision travel as such
    element = vectors.select(vec_col).schema[0].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"

    def coded(batches):
        first = np.flatnonzero(np.diff(shelf, prepend=-1))
        for pdf in (whole.iloc[a : a + 1024] for whole in batches for a in range(0, len(whole), 1024)):
            given = as_matrix(pdf["v"], dim)
            home, codes, beyond, probes = quantiser.encode(unit(given))
            reach = np.logical_or.reduceat(probes, first, axis=1)
            yield pd.DataFrame(
                {
                    "id": pdf["id"].to_numpy(),
                    "shelf": shelf[home],
                    "reach": [shelf[first[r]] for r in reach],
                    "home": home,
                    "n": pdf["n"].to_numpy(),
                    "size": pdf["v"].map(len).to_numpy(),
                    "vec": [r.tobytes() for r in given.astype(kind)],
                    "codes": [r.tobytes() for r in codes],
                    "beyond": beyond,
                }
            )

    index = stored(distinct.select("id", "v", "n").mapInPandas(coded, _ROW), "pq-index")
    rest = ["id", "home", "n", "size", "vec", "codes", "beyond"]
    entries = index.select(F.col("shelf").alias("key"), *rest)
    queries = index.select(F.explode("reach").alias("key"), *rest)
    found = stored(
        meetings(entries, queries, rows_a_block).applyInPandas(
            _links(quantiser, threshold, kind), "kind long, id long, other long, n long"
        ),
        "pq-links",
    )
    drop_stored(index)
    comps = connected_components(found.filter("kind = 1").select(F.col("id").alias("u"), F.col("other").alias("v")))
    counts = found.filter("kind = 0").groupBy("id").agg(F.sum("n").alias("links"))
    named = (
        distinct.select("id", "low", "n", "v")
        .join(counts, "id", "left")
        .join(comps, F.col("id") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    label = named.join(lowest, "component").select(
        "v", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    return rows.join(label, "v", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("n_links").isNull(), F.lit(True)).otherwise(F.col("vec_id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )


def op1_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
