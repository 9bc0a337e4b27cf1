"""Embedding near-dedup, nearest neighbours and components against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronojoin.llm import multi_index as M
from chronojoin.llm import pq_dedup as P
from chronojoin.llm.graph import connected_components

SCHEMA = "vec_id long, embedding array<double>, label int, id long, v string, n int"


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, 1, "v", 2) for i, v in zip(ids, x)], SCHEMA)


def clusters(seed, n=400, dim=16, spread=0.03):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(n // 8, dim))
    return np.vstack([c[rng.integers(len(c), size=n)] + spread * rng.normal(size=(n, dim)), rng.normal(size=(n // 4, dim))])


def brute_links(x, threshold):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T >= threshold
    np.fill_diagonal(s, False)
    low = np.arange(len(x))
    while True:
        new = np.array([min(low[i], *low[s[i]]) if s[i].any() else low[i] for i in range(len(x))])
        if (new == low).all():
            return s.sum(1), low
        low = new


@pytest.mark.parametrize("spread", [0.03, 0.08])
def test_links_match_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 40)
    x = clusters(3, spread=spread)
    x = np.vstack([x, x[:30], x[:10] * 2.5])  # equal vectors, and equal directions
    n, low = brute_links(x, 0.95)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in P.near_duplicates(frame(spark, x)).collect())
    assert got == [(i, int(n[i]), int(low[i]), bool(low[i] == i)) for i in range(len(x))]


def test_few_dimensions_lose_no_link(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 3))
    n, low = brute_links(x, 0.95)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in P.near_duplicates(frame(spark, x)).collect())
    assert got == [(i, int(n[i]), int(low[i])) for i in range(len(x))]


def test_hot_group_of_few_dimensions_loses_no_link(spark):
    """A third of the rows varies in two directions only, the rest in all: links there are long across the bisectors."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(2400, 64))
    x[:800] = rng.normal(size=(800, 2)) @ rng.normal(size=(2, 64))
    n, low = brute_links(x, 0.95)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in P.near_duplicates(frame(spark, x), lists=60).collect())
    assert got == [(i, int(n[i]), int(low[i])) for i in range(len(x))]


@pytest.mark.parametrize("number, width", [("float", 4), ("double", 8)])
def test_a_vector_is_sent_to_shelves_not_to_every_list_it_probes(spark, monkeypatch, number, width):
    """Vectors without structure probe most lists; lists that follow each other share a shelf (F1)."""
    sent, meetings = [], P.meetings
    monkeypatch.setattr(P, "meetings", lambda e, q, rows: sent.append((e, q, e.count(), q.count())) or meetings(e, q, rows))
    x = np.random.default_rng(2).normal(size=(2500, 24)).astype(np.float32).astype(float)
    x[2400:] = (x[:100] + np.float32(0.05) * x[100:200]).astype(np.float32)
    n, low = brute_links(x, 0.95)
    frame_ = frame(spark, x).withColumn("embedding", F.col("embedding").cast(f"array<{number}>"))
    drop = P.drop_stored
    monkeypatch.setattr(P, "drop_stored", lambda df: sent.append(sent[0][1].select(F.max(F.length("vec"))).first()[0]) or drop(df))
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in P.near_duplicates(frame_, lists=60).collect())
    assert got == [(i, int(n[i]), int(low[i])) for i in range(len(x))] and n.sum() >= 200
    (_, _, entries, queries), bytes_each = sent
    assert entries == 2500 and queries < 2.5 * 2500 and bytes_each == 24 * width


def test_numbers_far_apart_travel_in_single_precision(spark):
    """Single-precision components at the ends of their range, whose scaling is exact in double precision only."""
    x = [[3e38, 1e-44], [3e38, 0.0], [1e-44, 3e38], [1e-44, 1e-44], [1e-44, 0.0], [1.5e-45, 1.5e-45]]
    x = np.array(x, np.float32).astype(float).tolist()
    df = frame(spark, x).withColumn("embedding", F.col("embedding").cast("array<float>"))
    got = {r["vec_id"]: r["n_links"] for r in P.near_duplicates(df).collect()}
    u = [np.ldexp(np.array(r), -np.frexp(max(r))[1]) for r in x]
    assert [got[i] for i in range(6)] == [sum(plain_cosine(a, b) >= 0.95 for j, b in enumerate(u) if j != i) for i, a in enumerate(u)]


ODD = [[1.0, 0.0], [1.0, 0.0], None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 0.0, 0.0], [1e200, 1.0], [-0.0, 1.0]]


def test_odd_vectors(spark):
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in P.near_duplicates(frame(spark, ODD)).collect()}
    assert got[0] == (2, 0, True) and got[1] == (2, 0, False) and got[9] == (2, 0, False)
    assert all(got[i] == (0, i, True) for i in (2, 3, 4, 5, 6, 7, 8, 10))
    assert P.near_duplicates(frame(spark, [])).count() == 0
    assert P.near_duplicates(frame(spark, [None, [0.0]])).count() == 2
    nulls = P.near_duplicates(frame(spark, [[1.0, 2.0], [1.0, 2.0], [1.0, 2.0]], [None, 7, 7])).collect()
    assert sorted((r["n_links"], r["component_id"]) for r in nulls) == [(2, 7)] * 3


def plain_cosine(a, b):
    return math.fsum(x * y for x, y in zip(a, b)) / (math.sqrt(math.fsum(x * x for x in a)) * math.sqrt(math.fsum(x * x for x in b)))


def test_links_at_the_very_threshold(spark):
    """(380, 41, ...) and (1, 0, ...): 380 / 400 is 0.95 in double precision, though not by their rounded units."""
    a = [380, 41, 105, 14, 12, 36, 22, 27, 6, 3]
    b = [1] + [0] * 9
    below = [379.9999999999] + a[1:]
    x = [a, b, [2.0**600 * v for v in a], [2.0**-600 * v for v in b], below]
    got = {r["vec_id"]: r["n_links"] for r in P.near_duplicates(frame(spark, x)).collect()}
    want = [sum(plain_cosine(u, v) >= 0.95 for j, v in enumerate(y) if j != i) for y in [[a, b, a, b, below]] for i, u in enumerate(y)]
    assert plain_cosine(a, b) == 0.95 and plain_cosine(below, b) < 0.95
    assert [got[i] for i in range(5)] == want


def test_many_pairs_at_the_threshold(spark):
    """Whole numbers whose cosine with an axis is 19 / 20 by exact arithmetic, at many scales."""
    rng, x = np.random.default_rng(1), []
    while len(x) < 120:
        k = int(rng.integers(1, 60))
        rest = 39 * k * k  # (20 k)^2 - (19 k)^2, as a sum of squares
        parts = []
        while rest and len(parts) < 11:
            v = int(rng.integers(1, math.isqrt(rest) + 1)) if len(parts) < 6 else math.isqrt(rest)
            parts.append(v)
            rest -= v * v
        if not rest:
            x.append([0.0, 19.0 * k, *map(float, parts)] + [0.0] * (11 - len(parts)))
    x = [[v * 2.0**e for v in r] for r, e in zip(x, rng.integers(-300, 300, len(x)).tolist())]
    x.append([0.0, 3.0] + [0.0] * 11)
    got = {r["vec_id"]: r["n_links"] for r in P.near_duplicates(frame(spark, x)).collect()}
    u = [np.ldexp(np.array(r), -np.frexp(max(r))[1]) for r in x]
    want = [sum(plain_cosine(a, b) >= 0.95 for j, b in enumerate(u) if j != i) for i, a in enumerate(u)]
    assert [got[i] for i in range(len(x))] == want and want[-1] > 60


def test_search_of_extreme_values(spark):
    x = [[1e-200, 1e-200], [1e200, 1e200], [1.0, 2.0], [2e-308, 0.0], [5e-324, 5e-324], [1.7e308, -1.7e308]]
    got = M.search(frame(spark, x), F.lit(True)).collect()
    y = [np.ldexp(np.array(v), -np.frexp(max(map(abs, v)))[1]) for v in x]
    want = []
    for i, a in enumerate(y):
        near = sorted((-plain_cosine(a, b), j) for j, b in enumerate(y) if j != i)
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)
    assert abs(plain_cosine(y[1], y[2]) - 3 / math.sqrt(10)) < 1e-15


def brute_nearest(x, ids, queries, k=5):
    out = []
    u = x / np.linalg.norm(x, axis=1)[:, None]
    for q in queries:
        s = u @ u[q]
        order = [i for i in np.lexsort((ids, -np.round(s, 12))) if ids[i] != ids[q]][:k]
        out += [(int(ids[q]), r + 1, int(ids[i])) for r, i in enumerate(order)]
    return sorted(out)


def test_nearest_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD", 64)
    monkeypatch.setattr(M, "QUERIES", 64)
    x = clusters(4)
    x = np.vstack([x, np.repeat(x[:1], 40, axis=0)])  # one vector in many rows: ties by id
    ids = np.arange(len(x))[::-1].copy()
    got = M.search(frame(spark, x, [int(i) for i in ids]), F.col("vec_id") % 50 == 0)
    want = brute_nearest(x, ids, [i for i in range(len(x)) if ids[i] % 50 == 0])
    rows = got.collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in rows) == want
    at = {int(i): v for i, v in zip(ids, x)}
    for r in rows:
        a, b = at[r["query_id"]], at[r["vec_id"]]
        assert abs(r["score"] - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_odd_searches(spark):
    got = M.search(frame(spark, ODD), F.col("vec_id") == 0).collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(1, 1), (2, 9), (3, 10)]
    assert M.search(frame(spark, []), F.col("vec_id") == 0).count() == 0
    assert M.search(frame(spark, ODD), F.col("vec_id") == 4).count() == 0
    assert M.search(frame(spark, [[1.0], [2.0]], [None, 3]), F.lit(True)).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(1000, 1200)] + [(1000, 3), (5, 5), (None, 4)]
    e = spark.createDataFrame(chain + hub, "u long, v long")
    got = {r["node"]: r["component"] for r in connected_components(e).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 3 for i in [3, 7, *range(1000, 1200)]}
    assert got == want
    assert connected_components(e.limit(0)).count() == 0
