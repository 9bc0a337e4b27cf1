"""Language, quality and toxicity: exact parts against brute force, models on held-out rows."""

import random

import numpy as np
import pytest

from chronojoin.llm import cross_parsing as C
from chronojoin.llm import ordinal_toxicity as T
from chronojoin.llm import quality_rda as Q

SF = "/root/testdata/sf0.01"


def test_phrases_match_a_plain_parse():
    r = random.Random(3)
    for _ in range(60):
        ref = "".join(r.choice("abc ") for _ in range(r.randint(1, 60)))
        text = "".join(r.choice("abcd ") for _ in range(r.randint(0, 80)))
        p = C.Parser({"x": [ref], "y": ["abab"]}, 10**6)
        rs, ts = bytes(C.symbols([ref], p.of)[0]), bytes(C.symbols([text], p.of)[0])
        i = n = 0
        while i < len(ts):
            k = 0
            while i + k < len(ts) and ts[i : i + k + 1] in rs:
                k += 1
            i, n = i + max(k, 1), n + 1
        assert p.phrases(*C.symbols([text], p.of))[0, 0] == n


def test_long_texts_are_parsed_whole():
    p = C.Parser({"a": ["abcabcabd"], "b": ["xyzxyzxyw"]}, 10**6)
    head, tail = "xyz " * 100, "abc " * 2000
    assert p.predict([head, head + tail])[0] == ["b", "a"]


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = C.identify(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert len(got) == docs.count() and (held["lang"] == held["lang_pred"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_language_odd_rows(spark, odd_docs, no_docs):
    got = C.identify(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0.0 for i in (1, 2, 5))
    assert by[3]["lang_pred"] == "en"
    assert C.identify(no_docs).count() == 0


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = Q.train_and_score(docs, labels).toPandas()
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    assert ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()
    held = got[got["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert (held["quality"] == held["predicted"]).mean() > 0.95


def test_discriminant_matches_dense_formula():
    rng = np.random.default_rng(1)
    d = len(Q.FEATURES)
    a = rng.normal(size=(d, d))
    cov = [a @ a.T / d + np.eye(d), np.eye(d) * 2]
    mean = [rng.normal(size=d), rng.normal(size=d)]
    m = Q.QuadraticModel(mean, [np.linalg.cholesky(c) for c in cov], [float(np.linalg.slogdet(c)[1]) for c in cov], 0.4, np.zeros(d), np.ones(d))
    x = rng.normal(size=(20, d))
    logs = [-0.5 * (np.einsum("ij,jk,ik->i", x - u, np.linalg.inv(c), x - u) + np.linalg.slogdet(c)[1]) for u, c in zip(mean, cov)]
    assert np.allclose(m.log_density_difference(x), logs[1] - logs[0] + 0.4)


def test_quality_odd_rows(spark, odd_docs, no_docs, no_labels):
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 1), (3, 0, 0), (4, 1, None), (None, 1, 0), (99, 0, 1), (5, None, 1), (6, 7, 0)], "doc_id long, quality int, toxic int")
    for lab in (labels, no_labels):
        got = Q.train_and_score(odd_docs, lab).collect()
        assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
        assert Q.accepted(odd_docs, lab).columns == odd_docs.columns
        t = T.grade(odd_docs, lab).collect()
        assert len(t) == odd_docs.count() and all(0 <= r["p_toxic"] <= 1 for r in t)
    assert Q.train_and_score(no_docs, labels).count() == 0 and Q.accepted(no_docs, labels).count() == 0
    assert T.grade(no_docs, labels).count() == 0
    assert Q.accepted(odd_docs, no_labels).count() == odd_docs.count()


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(4)
    y = rng.integers(0, 3, 600)
    doc, feature = [], []
    for i, k in enumerate(y):
        for f in range(3):  # one more marker for each grade
            if rng.random() < (0.9 if f < k else 0.03):
                doc.append(i)
                feature.append(f)
        doc.append(i)
        feature.append(10 + int(rng.integers(20)))
    m = T.fit(np.array(doc), np.array(feature), y, np.ones(len(y)))
    assert (np.diff(m.thresholds) > 0).all()
    z = np.bincount(doc, weights=m.weights[feature], minlength=len(y))
    p = m.grades(z)
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()
    means = [(p @ np.arange(3))[y == k].mean() for k in range(3)]
    assert means[0] + 0.3 < means[1] < means[2] - 0.2


def test_toxic_words_are_found(spark):
    r = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    rows, marks = [], []
    for i in range(500):
        t = [r.choice(words) for _ in range(60)]
        toxic = int(i % 5 == 0)
        for _ in range(r.randint(1, 9) if toxic else 0):
            t.insert(r.randrange(60), r.choice(["vile1", "vile2", "vile3", "vile4"]))
        rows.append((i, " ".join(t)))
        marks.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    got = {x["doc_id"]: x for x in T.grade(docs, labels).collect()}
    held = [(i, t) for i, t in marks if got[i]["held_out"]]
    assert len(held) > 50
    assert sum(got[i]["toxic"] == bool(t) for i, t in held) / len(held) > 0.97
    assert all(got[i]["expected_severity"] >= 0 for i, _ in marks)


@pytest.mark.parametrize("words, per", [(60, 1), (100, 2), (200, 2)])
def test_a_wide_vocabulary_of_rare_toxic_words(spark, words, per):
    """Each toxic word is in one or two of a hundred toxic texts, and none is more telling than the rest."""
    r = random.Random(words)
    base, bad = [f"w{i}" for i in range(800)], [f"slur{i}x" for i in range(words)]
    rows = []
    for i in range(8000):
        text = r.choices(base, k=30) + (r.choices(bad, k=per) if i % 2 else [])
        r.shuffle(text)
        rows.append((i, " ".join(text), i % 2))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")
    held = [x for x in T.grade(docs, labels).collect() if x["held_out"]]
    toxic = [x["toxic"] for x in held if x["doc_id"] % 2]
    clean = [x["toxic"] for x in held if not x["doc_id"] % 2]
    assert sum(toxic) / len(toxic) >= 0.95 and sum(clean) / len(clean) < 0.01


def test_fit_equals_a_dense_optimum():
    """Against plain gradient descent on the written-out likelihood, three grades."""
    rng = np.random.default_rng(4)
    n, k = 300, 6
    x = (rng.random((n, k)) < 0.4).astype(float)
    y = np.digitize(x @ np.array([2.0, -1.5, 1.0, 0.0, 0.5, -0.5]) + rng.logistic(size=n), [0.5, 2.0])
    scale, l2, weight = np.array([1.0, 2.0, 0.5, 1.0, 1.5, 1.0]), 1e-2, rng.random(n) + 0.5
    weight /= weight.sum()
    full = np.zeros(2 << T.BITS)
    full[:k] = scale
    doc, col = np.nonzero(x)
    m = T.fit(doc, col, y, weight, full, l2=l2, rounds=500)

    def nll(u, t):
        c = np.hstack([np.zeros((n, 1)), 1 / (1 + np.exp(-(t[None, :] - (x @ (scale * u))[:, None]))), np.ones((n, 1))])
        return -(weight * np.log(np.diff(c, axis=1)[np.arange(n), y])).sum() + 0.5 * l2 * u @ u

    v = np.concatenate([np.zeros(k), [0.0, 1.0]])
    for step in range(6000):
        g = np.array([(nll(*np.split(v + h, [k])) - nll(*np.split(v - h, [k]))) / 2e-5 for h in 1e-5 * np.eye(k + 2)])
        v -= 0.5 * g
        if np.abs(g).max() < 1e-7:
            break
    assert np.abs(m.weights[:k] - scale * v[:k]).max() < 1e-3 and np.abs(m.thresholds - v[k:]).max() < 1e-3


def test_features_are_counted_over_all_marked_texts(spark):
    rows = [("a b b", 0), ("a c", 1), ("a b", 2), ("a", 0), (None, 1), ("", 0)]
    got, n = T.feature_counts(spark.createDataFrame(rows * 3, "text string, y int").repartition(4))
    want = np.zeros((2 << T.BITS, 2), int)
    for text, y in rows * 3:
        want[T.features([text])[1], int(y != 0)] += 1
    want[want.sum(1) < T.SUPPORT] = 0
    assert (got == want).all() and want.sum() and n.tolist() == [9, 9]
