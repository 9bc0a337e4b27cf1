"""License scan, source divergence and token alignment against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import plan_text

from chronojoin.llm import license_scan, source_divergence, token_alignment

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def _plan(df):
    return plan_text(df)


def _duck(spark, docs, sql):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source").toPandas())
    got = con.execute(sql)
    cols = [d[0] for d in got.description]
    return cols, sorted(got.fetchall(), key=repr)


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# -- license scan ---------------------------------------------------------------
NOTICE = {t.name: t.text for t in license_scan.TEMPLATES}
TEXTS = [
    "Released under the MIT License.",
    "MIT--LICENSE, mit license; MIT\nLicense mit licenses",
    "mİt license, miK license, émit license",
    "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "x " * 40_000 + "Licensed under the Apache License, Version 2.0.",
    NOTICE["mit-notice"],
    NOTICE["mit-notice"].replace("without restriction", "with restrictions"),
    "intro words " + NOTICE["mit-notice"].title() + " mit license",
    " ".join(NOTICE["mit-notice"].split()[:14]),
    NOTICE["bsd-notice"].upper(),
    # the template's end only: its words before the file's begin are missing
    " ".join(NOTICE["gpl-notice"].split()[11:]),
    "general public license apache license general public license",
    "license mit general public",
    "",
    None,
]


@pytest.fixture(scope="module")
def licensed(spark):
    docs = [(i, t, "en", "s") for i, t in enumerate(TEXTS)]
    docs += [docs[0], docs[0], (None, TEXTS[0], None, None), (None, None, None, None)]
    docs += [(100 + i, f"plain words of a text number {i} for any use", "en", "s") for i in range(20)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")


def test_license_scan_equals_sql(spark, licensed):
    cols, want = _duck(spark, licensed, license_scan.OP11_SQL)
    got = license_scan.license_scan(license_scan.scanned(licensed))
    assert sorted(got.columns) == sorted(cols)
    assert _rows(got, cols) == want


def test_license_scan_labels(spark, licensed):
    got = {r["doc_id"]: r for r in license_scan.license_scan(license_scan.scanned(licensed)).collect()}
    assert got[0]["labels"] == "mit" and got[0]["first_word"] == 3
    assert got[1]["n_base"] == 3 and (got[1]["first_word"], got[1]["last_word"]) == (0, 4)
    assert got[2]["n_base"] == 0 and got[2]["n_words"] == 6
    assert got[3]["base_labels"] == "" and got[3]["labels"] == "cc-by-nc"
    assert got[4]["labels"] == "gpl,gpl-3.0"
    assert got[5]["labels"] == "apache,apache-2.0" and got[5]["first_word"] == 40_003
    assert got[6]["labels"] == "mit" and got[6]["base_labels"] == "" and got[6]["score"] == 1.0
    assert got[7]["labels"] == ""  # one of its key phrases is missing
    assert got[8]["labels"] == "mit" and got[8]["n_base"] == 1
    assert got[10]["labels"] == "bsd"
    assert got[12]["base_labels"] == "apache,gpl" and got[12]["n_base"] == 3
    assert got[13]["n_base"] == 0 and got[13]["score"] == 0.0
    assert got[14]["n_words"] == 0 and got[15]["n_words"] == 0


def test_license_scan_is_native(spark, licensed):
    plan = _plan(license_scan.license_scan(license_scan.scanned(licensed)))
    assert not any(x in plan for x in ("EvalPython", "InPandas", "InArrow", "Exchange"))


def test_license_scan_odd_tables(spark, odd_docs, no_docs):
    got = license_scan.license_scan(license_scan.scanned(odd_docs)).collect()
    assert len(got) == odd_docs.count() and all(r["n_base"] == 0 and r["labels"] == "" for r in got)
    assert license_scan.license_scan(license_scan.scanned(no_docs)).count() == 0


def test_template_without_its_key_phrase_is_rejected():
    with pytest.raises(ValueError, match="key phrase"):
        license_scan.key_places(license_scan.Template("t", "t", "some words", ("other words",)))


# -- source divergence ------------------------------------------------------------
def _divergence_plain(rows, min_documents, top):
    rows = [tuple(x if x is not None else "" for x in r) for r in rows]
    df, n, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        groups.add((lang, source))
        terms = [t.decode() for t in source_divergence.terms_of(text) if t]
        for t in set(terms):
            df[lang, t] += 1
        for t in terms:
            n[lang, source, t] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), c in df.items() if x == lang and c >= min_documents)
        sources = sorted(s for x, s in groups if x == lang)

        def shares(count):
            total = sum(count.values())
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares({t: n[lang, s, t] for t in kept}) for s in sources}
        q = shares({t: sum(n[lang, s, t] for s in sources) for t in kept})
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if n[lang, s, t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(found[:most])]
    return sorted(out, key=repr)


COLS = ["lang", "source", "part", "item", "value", "rank"]


@pytest.fixture(scope="module")
def mixed_docs():
    r = random.Random(3)
    vocab = ["the", "The", "of", "été", "日本", "x1y", "a-b", "\U0001f600", "zz"] + [f"w{chr(97 + i)}" for i in range(20)]
    out = []
    for i in range(300):
        lang = r.choice(["en", "en", "fr", None, ""])
        source = "hot" if r.random() < 0.4 else r.choice([f"s{k}" for k in range(7)] + [None, "ü"])
        out.append((i, " ".join(r.choices(vocab, k=r.randint(0, 25))) if r.random() < 0.95 else None, lang, source))
    out += [(900, "only here", "de", "a"), (901, None, "de", "b"), (902, "lone", "it", "a")]
    return out + out[:7]


SCHEMA = "doc_id long, text string, lang string, source string"


def test_divergence_equals_plain(spark, mixed_docs):
    docs = spark.createDataFrame(mixed_docs, SCHEMA).repartition(5)
    got = _rows(source_divergence.divergence(docs, 4, 6), COLS)
    want = _divergence_plain([r[1:] for r in mixed_docs], 4, 6)
    assert got == want
    assert {r[0] for r in got if r[2] == "pair"} >= {"de", "en", "fr", ""}  # de keeps no term: values are 0


def test_divergence_small_blocks_and_bands(spark, mixed_docs):
    docs = spark.createDataFrame(mixed_docs, SCHEMA)
    counts = source_divergence.stored(source_divergence.term_counts(docs, 4), "t")
    f = source_divergence.F

    def sums(**kw):
        groups = source_divergence.stored(source_divergence.group_totals(counts, **kw), "t")
        p = source_divergence.smoothed(f.col("n"), f.col("total"), f.col("terms")).alias("p")
        shares = counts.filter("term != ''").join(groups, ["lang", "source"]).select("lang", "no", "term", "blocks", "bands", p)
        return groups.agg(f.max("blocks"), f.max("bands")).first(), _rows(
            source_divergence.pair_sums(shares, groups), ["lang", "no", "peer", "value"]
        )

    (one, whole), (many, cut) = sums(), sums(block_postings=7, cells=20)
    assert tuple(one) == (1, 1) and min(many) > 1 and whole == cut


def test_divergence_equals_sql(spark, mixed_docs):
    docs = spark.createDataFrame(mixed_docs * 12, SCHEMA)
    cols, want = _duck(spark, docs, source_divergence.OP12_SQL)
    assert _rows(source_divergence.divergence(docs), cols) == want


def test_divergence_large_counts_stay_exact(spark):
    one = spark.createDataFrame([(8_000_000_000_000, 9_100_000_000_001, 3_000_000)], "n long, total long, v long")
    f = source_divergence.F
    got = one.select(source_divergence.smoothed(f.col("n"), f.col("total"), f.col("v"))).first()[0]
    assert got == 1 + 10**9 * (8_000_000_000_005) // (9_100_000_000_001 + 15_000_000)


def test_row_accumulation_against_dense():
    r = np.random.default_rng(5)
    groups, terms = 9, 200
    dense = r.integers(0, 4, (groups, terms)) * r.integers(0, 2, (groups, terms))
    dense[4] = 0
    z = r.integers(1, 50, groups)
    p = np.where(dense > 0, dense * 1000 + r.integers(0, 900, (groups, terms)), z[:, None])
    no, term = np.nonzero(dense)
    want = np.abs(p[:, None, :] - p[None, :, :])[:, :, np.unique(term)].sum(2)
    got = source_divergence.accumulate(no, term, p[no, term], z, np.arange(groups))
    assert (got == want).all()
    assert (source_divergence.accumulate(no, term, p[no, term], z, np.array([2, 7])) == want[[2, 7]]).all()


def test_divergence_odd_tables(spark, odd_docs, no_docs):
    got = source_divergence.divergence(odd_docs, 1)
    want = _divergence_plain([(r["text"], r["lang"], r["source"]) for r in odd_docs.collect()], 1, 50)
    assert _rows(got, COLS) == want
    assert source_divergence.divergence(no_docs).count() == 0


# -- token alignment ----------------------------------------------------------------
def test_align_equals_plain():
    r = random.Random(1)
    for _ in range(800):
        n, pa, pb = r.randint(1, 80), r.random(), r.random()
        a = sorted({*[x for x in range(1, n) if r.random() < pa], n})
        b = sorted({*[x for x in range(1, n) if r.random() < pb], n})
        if r.random() < 0.4:  # long equal stretches
            b = sorted({*[x for x in a if r.random() < 0.97], n})
        ga, gb, la, lb = token_alignment.align(a, b)
        common = sorted(set(a) & set(b))
        assert [a[i - 1] for i in ga] == common and [b[i - 1] for i in gb] == common
        sa, sb = [0, *a], [0, *b]
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(sa[i], sb[j]) < min(sa[i + 1], sb[j + 1])]
        assert list(zip(la.tolist(), lb.tolist())) == want


ALIGN = [
    "a plain text of some words here", "", None, "the the the", " two  spaces\n\ttab \r\n end ", "été naïve \U0001f600 日本語",
    "<|endoftext|> and </s> <s> <unk> <0x41>", "▁ lower block", "\x00 nul", "1234567 12,5 $$$ !!", "\U00031234 far", "x" * 3000, "ﬁ ½ Å",
]


def _plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    ta = Tokenizer.from_file(A)
    ta.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = token_alignment.byte_letters()

    def spans(ids, byte):
        at, out = 0, []
        for i in ids:
            out.append((i, at, at + len(byte(i))))
            at = out[-1][2]
        return out

    def bytes_a(i):
        return bytes(letters[c] for c in ta.id_to_token(i))

    def bytes_b(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    docs, count = [], Counter()
    for t in texts:
        a = ta.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        whole = (" " + t).encode() if t else b""
        if b"".join(map(bytes_a, a)) != whole or b"".join(map(bytes_b, b)) != whole:
            a = b = []
        a, b = spans(a, bytes_a), spans(b, bytes_b)
        links = [(x[0], y[0]) for x in a for y in b if max(x[1], y[1]) < min(x[2], y[2])]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, lo = [], 0
        for hi in cuts:
            part = [",".join(str(x[0]) for x in s if lo < x[2] <= hi) for s in (a, b)]
            groups.append("|".join(part))
            lo = hi
        docs.append((a, b, groups, links))
        count.update(links)
    most = defaultdict(int)
    for (_, y), c in count.items():
        most[y] = max(most[y], c)
    out = []
    for a, b, groups, links in docs:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        best = sum(count[x] == most[x[1]] for x in links)
        out.append((len(a), len(b), len(groups), len(links), best, sum(count[x] for x in links), sha))
    return out


DIGEST = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("chars", [20, 4_000_000])
def test_alignment_equals_plain(spark, chars):
    texts = ALIGN + ALIGN[:3]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in DIGEST) for r in token_alignment.alignment_digest(docs, A, B, chars).collect()}
    want = _plain_alignment(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert got[1] == got[2] == (0, 0, 0, 0, 0, 0, "")


def test_fast_and_slow_byte_tokenizer_agree():
    t = token_alignment.ByteTokenizer(A)
    assert t.fast is not None
    for text in filter(None, ALIGN):
        assert t.encode(text)[0].tolist() == t.slow.encode(text, add_special_tokens=False).ids


def test_alignment_groups_cover_the_text(spark):
    docs = spark.createDataFrame([(1, "some words, aligned"), (None, None)], "doc_id int, text string")
    got = {r["doc_id"]: r for r in token_alignment.aligned(docs, A, B).collect()}
    one = got[1]
    assert one["ends_a"][-1] == len(one["ids_a"]) and one["ends_b"][-1] == len(one["ids_b"]) and got[None]["ids_a"] == []


def test_alignment_odd_tables(spark, odd_docs, no_docs):
    rows = odd_docs.collect()
    got = token_alignment.alignment_digest(odd_docs, A, B)
    want = [(r["doc_id"], *w) for r, w in zip(rows, _plain_alignment([(r["text"] or "")[:0] if len(r["text"] or "") > 10_000 else r["text"] for r in rows]))]
    keep = [w for r, w in zip(rows, want) if len(r["text"] or "") <= 10_000]
    found = [tuple(r[c] for c in ["doc_id", *DIGEST]) for r in got.collect()]
    assert len(found) == len(rows)
    # the long text's own pairs add to the counts: compare what does not depend on them
    assert sorted((f[:5] + f[7:] for f in found if f[1] < 10_000), key=repr) == sorted((w[:5] + w[7:] for w in keep), key=repr)
    assert token_alignment.alignment_digest(no_docs, A, B).count() == 0
