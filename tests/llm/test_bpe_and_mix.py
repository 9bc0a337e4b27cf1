"""BPE against the library's own encoder, Pfair orders against the fluid schedule, secrets against a plain scan."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from chronojoin.llm import bpe_words as W
from chronojoin.llm import pfair_mix as P
from chronojoin.llm import secret_forest as S

SF = "/root/testdata/sf0.001"


def encoder(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes_match_the_library(spark, odd_docs):
    ranks = W.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    enc, r = encoder(ranks), random.Random(1)
    chars = [chr(c) for c in [*range(0, 0x300), 0x85, 0x1C, 0x2028, 0x3000, 0xFEFF, 0x1F600, 0x4E2D, 0x660, 0xBD, 0x300, 0x10FFFF]]
    texts = ["".join(r.choice(chars) if r.random() < 0.4 else r.choice("ab 's\n\t1,") for _ in range(r.randint(0, 60))) for _ in range(300)]
    texts += [x["text"] for x in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [None, "", "x" * 5000, "<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    ids = W.encode(docs, ranks, public_tokenizers.PATTERN, block_chars=20_000)
    got = {x["doc_id"]: x["ids"] for x in ids.collect()}
    assert got == {i: enc.encode_ordinary(t or "") for i, t in enumerate(texts)}
    back = {x["doc_id"]: bytes(x["bytes"]) for x in W.decode(ids, ranks).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)}


def test_digests_and_odd_rows(spark, odd_docs, no_docs):
    ranks = W.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    enc = encoder(ranks)

    def line(doc, text):
        e = enc.encode_ordinary(text or "")
        return doc, len(e), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    got = sorted(map(repr, (tuple(x) for x in W.tokenised(odd_docs).collect())))
    assert got == sorted(repr(line(x["doc_id"], x["text"])) for x in odd_docs.collect())
    assert W.tokenised(no_docs).count() == 0


def fluid_gap(order, weights, blocks):
    """The largest distance of a source from its fluid share after any slot, by the weights as given."""
    names = list(blocks)
    at = {s: k for k, s in enumerate(names)}
    w = np.array([weights[s] for s in names], float)
    left = np.array([blocks[s] for s in names], float)
    fluid, got, worst = np.zeros(len(names)), np.zeros(len(names)), 0.0
    for s in order:
        got[at[s]] += 1
        need = 1.0
        while need > 1e-9 and (live := left > 1e-9).any():
            rate = np.where(live, w, 0) / w[live].sum()
            step = min(need, (left[live] / rate[live]).min())
            fluid += step * rate
            left -= step * rate
            need -= step
        worst = max(worst, np.abs(got - fluid).max())
    return worst


def test_schedules_deviate_by_less_than_a_block():
    r = random.Random(2)
    for _ in range(60):
        w = [r.choice([1.0, r.random(), 10 ** r.uniform(-4, 2)]) for _ in range(r.randint(1, 9))]
        blocks = [r.randint(0, 60) for _ in w]
        order = list(P.schedule(w, blocks))
        assert [order.count(s) for s in range(len(w))] == blocks
        live = {s: b for s, b in enumerate(blocks) if b}
        assert not live or fluid_gap(order, dict(enumerate(w)), live) < 1 + 1e-6


def test_a_large_target_among_two_thousand_sources():
    """0.9 is served as 0.9 and 0.0001 as 0.0001, whatever the number of sources."""
    weights = {"hot": 0.9, "rare": 0.0001} | {f"s{i}": 0.0999 / 1998 for i in range(1998)}
    blocks = {"hot": 7200, "rare": 2} | {f"s{i}": 2 for i in range(1998)}
    names = list(weights)
    order = [names[k] for k in P.schedule([weights[x] for x in names], [blocks[x] for x in names])]
    assert len(order) == sum(blocks.values())
    assert abs(order[:5000].count("hot") - 4500) < 1
    assert fluid_gap(order[:9000], weights, blocks) < 1 + 1e-6


def test_mixture_follows_its_targets(spark):
    r = random.Random(3)
    sizes = {"a": 700, "b": 90, "c": 333, "d": 5, None: 40}
    rows = [(i, s) for i, s in enumerate(x for s, n in sizes.items() for x in [s] * n)]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    targets = {"a": 0.9, "b": 0.0999, "c": 0.0001, None: 0.07}
    as_table = spark.createDataFrame(list(targets.items()), "s string, w double")
    got = P.mixed(docs, targets, block_rows=4).toPandas()
    again = P.mixed(docs, as_table, block_rows=4).toPandas()
    assert sorted(map(repr, got.values.tolist())) == sorted(map(repr, again.values.tolist()))
    assert len(got) == len(rows) and got["mix_order"].nunique() == len(rows) and set(got["doc_id"]) == {i for i, _ in rows}
    got["source"] = got["source"].where(got["source"].notna(), "")
    assert (got.groupby(["source", "mix_block"]).size() <= 4).all()
    slots = got.drop_duplicates(["source", "mix_block"]).sort_values("mix_slot")
    assert slots["mix_slot"].tolist() == list(range(len(slots)))
    order = slots["source"].tolist()
    assert order[-2:] == ["d", "d"]  # without a target: after all others
    blocks = {s or "": -(-n // 4) for s, n in sizes.items() if s != "d"}
    assert fluid_gap(order[:-2], {s or "": w for s, w in targets.items()}, blocks) < 1 + 1e-6
    ordered = [x["doc_id"] for x in P.in_order(docs, targets=targets, block_rows=4).collect()]
    assert ordered == got.sort_values("mix_order")["doc_id"].tolist()


def test_two_thousand_sources_through_a_table(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), (F.col("id") % 2000).alias("source"))
    got = P.mixed(docs, block_rows=1).toPandas()
    assert sorted(got["mix_slot"]) == list(range(6000))
    # equal weights: every source once in each third
    assert all(got[got["mix_slot"] // 2000 == k]["source"].nunique() == 2000 for k in range(3))


def test_mixture_odd_rows(spark, odd_docs, no_docs):
    got = P.mixed(odd_docs, block_rows=2)
    assert got.columns == [*odd_docs.columns, "mix_block", "mix_slot", "mix_order"]
    assert sorted(repr(tuple(x)[:10]) for x in got.collect()) == sorted(repr(tuple(x)) for x in odd_docs.collect())
    assert P.mixed(got, block_rows=2).columns == got.columns
    assert P.mixed(no_docs).count() == 0 and P.in_order(no_docs).columns == no_docs.columns


def test_candidates_match_a_plain_scan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    run = re.compile(r"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{14,}={0,2}")
    want = [(x["doc_id"], n, m.group(0), x["text"][: m.start()][-40:]) for x in docs.collect() for n, m in enumerate(run.finditer(x["text"]))]
    got = [(x["id"], x["n"], x["value"]) for x in S.candidates(docs).collect()]
    assert sorted(got) == sorted(w[:3] for w in want)


LONG_NAMES = [
    'aws_secret_access_key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCY1234567890"',
    "aws_secret_access_key=wJalrXUtnFEMI/K7MDENG/bPxRfiCY1234567890",
    "x github_access_token: 0123456789abcdef0123 and client_secret_key='abcdefghij0123456789'; more text after all of it",
    "0123456789abcdef 0123456789abcdeg 0123456789abcdeh 0123456789abcdei 0123456789abcdej== end",
]


def test_contexts_match_a_plain_scan(spark):
    """before and after are the characters of the text, whether or not other candidates are among them."""
    texts = LONG_NAMES + [x["text"] for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    run = re.compile(S.RUN)
    want = [(i, n, m.group(0), t[: m.start()][-40:], t[m.end() :][:40]) for i, t in enumerate(texts) for n, m in enumerate(run.finditer(t))]
    got = S.candidates(docs).collect()
    assert sorted((x["id"], x["n"], x["value"], x["before"], x["after"]) for x in got) == sorted(want)


def test_values_of_long_names_are_secrets(spark):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(LONG_NAMES)], "doc_id long, text string, source string")
    found = S.known_labels(S.with_features(S.candidates(docs), S.dictionary(docs))).collect()
    values = {(x["id"], x["value"]): x for x in found}
    for i, v in [(0, "wJalrXUtnFEMI/K7MDENG/bPxRfiCY1234567890"), (1, "wJalrXUtnFEMI/K7MDENG/bPxRfiCY1234567890"), (2, "0123456789abcdef0123"), (2, "abcdefghij0123456789")]:
        assert values[i, v]["y"] == values[i, v]["keyword"] == values[i, v]["assigned"] == 1.0
    assert (1, "aws_secret_access_key") in values and (3, "0123456789abcdej==") in values


def secrets(n):
    r = random.Random(7)
    rows = []
    for i in range(n):
        key = "".join(r.choice("0123456789abcdef") for _ in range(40))
        cloud = "AKIA" + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16))
        plain = " ".join("".join(r.choice(["the", "ing", "er", "on", "at"]) for _ in range(r.randint(1, 8))) for _ in range(40))
        text = [f'{plain} token = "{key}" {plain}', f"{plain} {cloud} {plain}", plain, f"{plain} 4929{r.randint(10**11, 10**12 - 1)} {plain}"][i % 4]
        rows.append((i, text, "src0", len(text)))
    return rows


def test_secrets_are_found_and_replaced(spark):
    rows = secrets(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    found = S.scan(docs).collect()
    bad = {x["doc_id"] for x in found if x["is_secret"]}
    assert bad == {i for i, *_ in rows if i % 4 < 2}
    out = {x["doc_id"]: x for x in S.redacted(docs).collect()}
    assert len(out) == len(rows)
    for i, text, _, _ in rows:
        new = out[i]["text"]
        assert out[i]["n_chars"] == len(new)
        if i % 4 >= 2:
            assert new == text
        else:
            assert "[SECRET]" in new and not re.search(r"[0-9a-f]{40}|AKIA", new) and new.split("[SECRET]")[0] == text[: len(new.split("[SECRET]")[0])]


def test_given_labels_train_the_forest(spark):
    rows = secrets(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    found = S.candidates(docs).collect()
    marks = [(x["id"], x["n"], x["value"].startswith("AKIA")) for x in found if x["id"] % 3]
    labelled = spark.createDataFrame(marks, "doc_id long, n long, is_secret boolean")
    got = S.scan(docs, labelled).collect()
    held = [x for x in got if x["doc_id"] % 3 == 0]
    assert sum(x["is_secret"] == x["value"].startswith("AKIA") for x in held) / len(held) > 0.95


def test_secret_odd_rows(spark, odd_docs, no_docs):
    assert S.scan(no_docs).count() == 0 and S.redacted(no_docs).count() == 0
    S.scan(odd_docs).collect()
    out = S.redacted(odd_docs)
    assert out.columns == odd_docs.columns
    assert sorted(repr(tuple(x)) for x in out.collect()) == sorted(repr(tuple(x)) for x in odd_docs.collect())
