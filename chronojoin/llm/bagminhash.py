"""Near duplicates by BagMinHash: weighted-Jaccard signatures, bands, exact check.

A text is the multiset of its five-word shingles.  A shingle of count ``w``
covers the weight axis (0, w], cut into the dyadic intervals (0, 1], (1, 2],
(2, 4], (4, 8] ...  Each (shingle, interval) owns one Poisson process with a
rate of ``m`` times the interval's length, all of whose draws depend on the
shingle's hash and the interval alone: every point has a time, one of ``m``
components and a discrete level inside the interval, and counts only where the
level lies under ``w``.  A component keeps its smallest time, so two texts
agree in a component with probability sum(min) / sum(max) of their counts, the
weighted Jaccard similarity.  Times of a process only grow, so it stops as
soon as it passes the largest time that its text still keeps.

Bands of signature rows give candidates, which are verified by the exact
overlap of the two multisets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GOLDEN, chunks_of_texts, maybe_in, mix64, spread, stored, table
from .graph import connected_components
from .shingles import multisets

BANDS, ROWS = 24, 5
CHUNK_CHARS = 1_000_000
THRESHOLD = 0.8
BLOCK_ROWS, BLOCK_BYTES = 256, 32_000_000


def signatures(doc: np.ndarray, h: np.ndarray, w: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """n_docs x m smallest times; infinite for a document without shingles."""
    best = np.full(n_docs * m, np.inf)
    limit = np.full(n_docs, np.inf)
    if not len(doc):
        return best.reshape(n_docs, m)
    at_doc, at_lo, at_len, at_w, seed = [doc], [np.zeros(len(doc))], [np.ones(len(doc))], [w], [mix64(h + GOLDEN)]
    lo = 1
    while True:
        more = w > lo
        if not more.any():
            break
        k = int(more.sum())
        at_doc.append(doc[more])
        at_lo.append(np.full(k, float(lo)))
        at_len.append(np.full(k, float(lo)))
        at_w.append(w[more])
        with np.errstate(over="ignore"):
            seed.append(mix64(h[more] ^ mix64(np.full(k, lo, np.uint64) * GOLDEN)))
        lo *= 2
    d, lo_, length, wt, s = map(np.concatenate, (at_doc, at_lo, at_len, at_w, seed))
    x = np.zeros(len(d))
    step = np.uint64(1)
    while len(d):
        with np.errstate(over="ignore"):
            r1 = mix64(s + step * GOLDEN)
            r2 = mix64(r1 ^ GOLDEN)
        step += np.uint64(1)
        u = ((r1 >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))
        x = x - np.log(u) / (m * length)
        live = x < limit[d]
        if not live.all():
            d, lo_, length, wt, s, x, r2 = d[live], lo_[live], length[live], wt[live], s[live], x[live], r2[live]
        comp = ((r2 >> np.uint64(40)) % np.uint64(m)).astype(np.int64)
        level = lo_ + np.floor((r2 & np.uint64((1 << 40) - 1)).astype(np.float64) / (1 << 40) * length)
        counts = level < wt
        np.minimum.at(best, (d * m + comp)[counts], x[counts])
        limit = best.reshape(n_docs, m).max(axis=1)
    return best.reshape(n_docs, m)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """n x bands hashes (int64) of the signature's bands."""
    bits = mix64(sig.view(np.uint64).reshape(len(sig), bands, rows))
    with np.errstate(over="ignore"):
        odd = mix64(np.arange(1, rows + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
        key = (bits * odd).sum(axis=2, dtype=np.uint64)
        return mix64(key + np.arange(bands, dtype=np.uint64) * GOLDEN).view(np.int64)


def _class_of(h: np.ndarray, w: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(h.tobytes() + w.tobytes())


def _texts_to(fn):
    """mapInPandas over rows with a text, in chunks of bounded size; fn(rows, texts) -> DataFrame."""

    def run(batches):
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in chunks_of_texts(texts, CHUNK_CHARS):
                yield fn(pdf.iloc[a:b], texts[a:b])

    return run


def _signed(part, texts, bands, rows):
    d, h, w = multisets(texts)
    n = len(texts)
    cut = np.searchsorted(d, np.arange(n + 1))
    sig = signatures(d, h, w, n, bands * rows)
    keys = band_keys(sig, bands, rows)
    has = cut[1:] > cut[:-1]
    return pd.DataFrame(
        {
            "id": part["id"].to_numpy(),
            "text_hash": part["text_hash"].to_numpy(),
            "class": [_class_of(h[cut[i] : cut[i + 1]], w[cut[i] : cut[i + 1]]) if has[i] else None for i in range(n)],
            "bands": [keys[i] if has[i] else None for i in range(n)],
        }
    )


def signed_documents(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """(id, text_hash, class, bands) of every row; class and bands are null for a text without a word."""
    src = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")
    )
    run = _texts_to(lambda p, t: _signed(p, t, bands, rows))
    return src.mapInPandas(run, "id long, text_hash long, class binary, bands array<long>")


def _elements(_, texts):
    """One row per text: its class and the sorted hashes of its (shingle, occurrence) elements."""
    d, h, w = multisets(texts)
    n = len(texts)
    cut = np.searchsorted(d, np.arange(n + 1))
    out = []
    for i in range(n):
        hi, wi = h[cut[i] : cut[i + 1]], w[cut[i] : cut[i + 1]]
        if len(hi):
            occ = np.arange(int(wi.sum())) - np.repeat(np.cumsum(wi) - wi, wi)
            with np.errstate(over="ignore"):
                e = np.sort(mix64(np.repeat(hi, wi) + occ.astype(np.uint64) * GOLDEN))
            out.append((_class_of(hi, wi), e.tobytes()))
    return pd.DataFrame(out, columns=["class", "e"])


def _similarity(a: bytes, b: bytes, threshold: float = 0.0) -> float:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    if len(x) < threshold * len(y):
        return len(x) / len(y)  # an upper bound, already too low
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return both / (len(x) + len(y) - both)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, component_id, kept, text_hash) of every row.

    Rows are linked where the weighted Jaccard similarity of their shingle
    multisets is at least ``threshold``; component_id is the smallest doc_id
    reachable by links and ``kept`` marks the group's one document that stays:
    the smallest doc_id (null last), then the smallest text_hash (xxhash64 of
    the text).  Texts that are null, empty or have no word link with nothing
    and are kept.  Rows equal in doc_id and text share the decision, see
    ``without_near_duplicates``.  A null doc_id takes its partners' component,
    null when all of them are null.

    Equal multisets form a class at once, and only one representative of a
    class goes on.  In every bucket of a band the member that meets most others
    leads, and the rest are verified against it; members that are still in
    different components are then verified with each other in blocks, so no
    candidate pair is lost and a large group of copies costs one pair for each
    member.
    """
    signed = stored(signed_documents(docs, id_col, text_col, bands, rows), "bag-signatures")
    classes = stored(
        signed.filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("low"),
            F.first("bands").alias("bands"),
        )
        .withColumn("cid", F.monotonically_increasing_id()),
        "bag-classes",
    )
    entries = classes.select("cid", F.explode("bands").alias("band")).repartition(spread(docs), "band")
    sizes = entries.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(entries.join(sizes, "band"), "bag-members")
    meets = members.groupBy("cid").agg(F.sum("n").alias("meets"))
    leaders = members.join(meets, "cid").groupBy("band").agg(F.max(F.struct("meets", "cid")).alias("l"))
    first = (
        members.join(leaders, "band")
        .filter(F.col("cid") != F.col("l.cid"))
        .select(F.least("cid", "l.cid").alias("a"), F.greatest("cid", "l.cid").alias("b"))
        .distinct()
    )
    sets = _sets(docs, classes.join(meets, "cid", "left_semi"), id_col, text_col)
    edges = _linked(first, sets, threshold)
    comps = stored(connected_components(edges), "bag-components")
    more = _between(members, classes, sets, comps, threshold)
    if more.take(1):
        comps = stored(connected_components(edges.union(more)), "bag-components")
    by_class = classes.select("class", "cid", "low").join(comps, F.col("cid") == F.col("node"), "left").select(
        "class", "low", F.coalesce("component", "cid").alias("component")
    )
    lowest = by_class.groupBy("component").agg(F.min("low").alias("low"))
    label = by_class.select("class", "component").join(lowest, "component").select("class", "low")
    alone = F.col("class").isNull()
    return (
        signed.select("id", "text_hash", "class")
        .join(label, "class", "left")
        .select(
            F.col("id").alias("doc_id"),
            F.when(alone, F.col("id")).otherwise(F.col("low.id")).alias("component_id"),
            (alone | (F.col("id").eqNullSafe(F.col("low.id")) & (F.col("text_hash") == F.col("low.text_hash")))).alias(
                "kept"
            ),
            "text_hash",
        )
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns.

    Of rows that are equal in doc_id and text one stays.  Only texts that may
    have to go are shuffled, to a join by plain equality on (doc_id, text_hash).
    """
    found = stored(near_duplicates(docs, id_col, text_col, **how), "bag-found")
    once = found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("__llm_n"), F.max("kept").alias("__llm_kept"))
    # documents to drop, and those of which one of several equal rows stays
    marked = stored(
        once.filter("not __llm_kept or __llm_n > 1").select(F.col("doc_id").alias("__llm_d"), F.col("text_hash").alias("__llm_h"), "__llm_kept"), "bag-marked"
    )
    key, th = F.col(id_col).cast("long"), F.xxhash64(text_col)
    may = maybe_in(F.xxhash64(key, th), marked.select(F.xxhash64("__llm_d", "__llm_h").alias("k")))
    on = key.eqNullSafe(F.col("__llm_d")) & (th == F.col("__llm_h"))
    some = docs.filter(may)
    rest = some.join(marked, on, "left_anti")
    again = some.join(marked.filter("__llm_kept"), on, "left_semi").dropDuplicates([id_col, text_col])
    return docs.filter(~may).unionByName(rest).unionByName(again)


def _sets(docs, classes, id_col, text_col) -> DataFrame:
    """Stored (cid, e) of the given classes, from the text of each class's representative.

    A bitmap of the representatives keeps most other texts out of the join's shuffle.
    """
    reps = stored(classes.select(F.col("low.id").alias("__llm_r")).distinct(), "bag-reps")
    key = F.col(id_col).cast("long")
    texts = (
        docs.filter(maybe_in(key, reps))
        .join(reps, key.eqNullSafe(F.col("__llm_r")), "left_semi")
        .select(key.alias("id"), F.col(text_col).alias("text"))
    )
    return stored(
        texts.mapInPandas(_texts_to(_elements), "class binary, e binary")
        .join(classes.select("class", "cid"), "class")
        .dropDuplicates(["cid"])
        .select("cid", "e"),
        "bag-sets",
    )


def _linked(pairs, sets, threshold) -> DataFrame:
    """Stored (u, v): the pairs (a, b) of classes that are similar enough."""

    def verify(batches):
        for pdf in batches:
            ok = [_similarity(a, b, threshold) >= threshold for a, b in zip(pdf["ea"], pdf["eb"])]
            yield pdf.loc[ok, ["a", "b"]].rename(columns={"a": "u", "b": "v"})

    both = pairs.join(sets.select(F.col("cid").alias("a"), F.col("e").alias("ea")), "a").join(
        sets.select(F.col("cid").alias("b"), F.col("e").alias("eb")), "b"
    )
    return stored(both.mapInPandas(verify, "u long, v long"), "bag-links")


def _between(members, classes, sets, comps, threshold) -> DataFrame:
    """Stored (u, v): links that join different components inside a band's bucket.

    Buckets with one component only are done.  The others are cut into blocks
    of bounded size; every pair of blocks is one group, which verifies pairs of
    different components (each pair in the first bucket that both share) and
    returns a link for each merge it finds, never the pairs themselves.
    """
    where = members.join(comps, F.col("cid") == F.col("node"), "left").select(
        "band", "cid", F.coalesce("component", "cid").alias("c")
    )
    mixed = where.groupBy("band").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 != c1").select("band")
    left = stored(where.join(mixed, "band", "left_semi"), "bag-mixed")
    size = (
        left.join(sets.select("cid", F.length("e").alias("bytes")), "cid")
        .groupBy("band")
        .agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS + F.sum("bytes") / BLOCK_BYTES).cast("int").alias("nb"))
    )
    left = left.join(size, "band").withColumn("k", F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int"))
    rows = (
        left.join(sets, "cid")
        .join(classes.select("cid", "bands"), "cid")
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        .select("band", F.least("k", "o").alias("i"), F.greatest("k", "o").alias("j"), "k", "cid", "c", "e", "bands")
    )

    def pairs(key, pdf):
        return _merges(key[0], key[1], key[2], pdf, threshold)

    return stored(rows.groupBy("band", "i", "j").applyInPandas(pairs, "u long, v long"), "bag-links")


def _merges(band, i, j, pdf, threshold) -> pd.DataFrame:
    keys = np.vstack(pdf["bands"].to_numpy())
    at = int(np.flatnonzero(keys[0] == band)[0])
    cls, e, k = pdf["cid"].tolist(), pdf["e"].tolist(), pdf["k"].to_numpy()
    size = np.array([len(x) for x in e], float)
    root, names = pd.factorize(pdf["c"])
    out = []
    for x in range(len(pdf)):
        ok = root != root[x]
        if i == j:
            ok[: x + 1] = False
        elif k[x] == i:
            ok &= k == j
        else:
            continue
        ok &= np.minimum(size, size[x]) >= threshold * np.maximum(size, size[x])
        ok &= ~(keys[:, :at] == keys[x, :at]).any(axis=1)
        for y in np.flatnonzero(ok):
            if root[y] != root[x] and _similarity(e[x], e[y], threshold) >= threshold:
                out.append((cls[x], cls[y]))
                root[root == root[y]] = root[x]
    return pd.DataFrame(out, columns=["u", "v"], dtype="int64")


def op6_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
