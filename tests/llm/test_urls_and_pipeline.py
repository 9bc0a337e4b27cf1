"""URL filter against its SQL, pipeline against the operators, and the registered queries."""

import hashlib
import pathlib

import duckdb
import pandas as pd

import __spark_entry__ as E
import corpus_pipeline
from chronojoin import llm
from chronojoin.llm import bagminhash, pfair_mix, quality_rda, url_alias

from .test_bpe_and_mix import fluid_gap

SF = "/root/testdata/sf0.001"


def link(t):
    return f'<html><head><LINK rel="canonical" href="{t}"></head>'


def move(t):
    return f'<meta http-equiv="refresh" content="0; url={t}">'


PAGES = [
    (1, "http://a.io/x", link("http://b.net/q")),
    (2, "http://c.io/y", move("http://a.io/x#f")),
    (3, "http://WWW.example.NET/en/1", link("http://b.net/q")),
    (4, None, None),
    (5, "nourl", link("/x")),
    (6, "http://d.io", link("//c.io/y")),
    (7, "http://e.org/fr/a/b", link("../z?u=1&amp;v=2")),
    (8, "http://f.io/?q#x", link("?q")),
    (9, "http://net/abc", ""),
    (10, "http://xnet/abc", None),
    (11, "http://example.com?/de/", None),
    (12, "http://a.example.com/de/x?y://z", None),
    (None, "http://a.io/x", None),
    (1, "http://a.io/x", None),
    (13, "", ""),
]


BLOCKED = "http://x.example.com/de/z"
# (url, html, whether a block of BLOCKED reaches the page)
ALIASES = [
    ("http://x.example.com/a/b/c", link("../../de/z"), True),
    ("http://x.example.com/a/b", link("./.././de/q/../z"), True),
    ("http://p1.io/", f'<link rel="alternate canonical" href="{BLOCKED}">', True),
    ("http://p2.io/", f'<link title="a > b" rel=canonical href={BLOCKED}>', True),
    ("http://p3.io/", '<base href="http://x.example.com/de/"><link rel="canonical" href="z">', True),
    ("http://p4.io/", f'<meta content="5; URL={BLOCKED}" http-equiv=Refresh>', True),
    ("http://p5.io/", '<link rel="canonical" href="http:&#x2F;&#x2F;x.example.com&#x2F;de/z">', True),
    ("http://p6.io/", f'<link rel="canonical" data-href="{BLOCKED}" href="http://fine.io/">', False),
    ("http://p7.io/", f'<!-- <link rel="canonical" href="{BLOCKED}"> -->', False),
    ("http://p8.io/", f"<script>var t = '<link rel=canonical href={BLOCKED}>';</script>", False),
    ("http://p9.io/", f'<link rel="noncanonical" href="{BLOCKED}"><a rel="canonical" href="{BLOCKED}">x</a>', False),
    ("http://p10.io/", '<meta http-equiv="refresh" content="30">', False),
    (BLOCKED, "", False),
]


def test_links_of_a_page(spark):
    """Attributes by whole names, tokens of rel, no tags in comments or scripts, base addresses and dot segments."""
    rows = [(i, u, h) for i, (u, h, _) in enumerate(ALIASES)]
    got = url_alias.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).toPandas().set_index("page_id")
    assert got["by_alias"].to_dict() == {i: hit for i, (_, _, hit) in enumerate(ALIASES)}
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    want = con.execute(url_alias.OP2_SQL).df().set_index("page_id")
    assert want["by_alias"].to_dict() == got["by_alias"].to_dict()


def test_targets_seen_from_an_address():
    base = "a.io/b/c/d;p?q"
    for goal, want in [
        ("g", "a.io/b/c/g"), ("./g", "a.io/b/c/g"), ("g/", "a.io/b/c/g/"), ("/g", "a.io/g"), ("//h", "h"), ("?y", "a.io/b/c/d;p?y"),
        ("g?y/./x", "a.io/b/c/g?y/./x"), ("#s", "a.io/b/c/d;p?q"), ("..", "a.io/b/"), ("../g", "a.io/b/g"), ("../../../g", "a.io/g"),
        ("./../g", "a.io/b/g"), ("g/../h", "a.io/b/c/h"), ("https://H.io/x/../y#z", "H.io/y"), ("g?u=http://k", "a.io/b/c/g?u=http://k"),
    ]:
        assert url_alias.resolved(goal, base) == want, goal
    assert url_alias.head_targets("<![odd [ <link rel=canonical href=x>")[1] in ([], ["x"])


def lines(df):
    return sorted(map(str, df[["page_id", "host", "path", "rule", "verdict", "by_alias"]].astype(object).where(df.notna(), None).itertuples(index=False, name=None)))


def test_urls_match_sql(spark):
    con = duckdb.connect()
    pages = pd.DataFrame(PAGES, columns=["page_id", "url", "html"])
    pages["page_id"] = pages["page_id"].astype("Int64")
    con.register("pages", pages)
    df = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, host string, node string")
    got = url_alias.judge(df).toPandas()
    got["page_id"] = got["page_id"].astype("Int64")
    want = con.execute(url_alias.OP2_SQL).df()
    want["page_id"] = want["page_id"].astype("Int64")
    assert lines(got) == lines(want)
    by = got.dropna(subset=["page_id"]).drop_duplicates("page_id").set_index("page_id")
    assert by.loc[[1, 2, 6], "by_alias"].all() and by.loc[3, "verdict"] == "allow" and by.loc[4, "host"] == ""


def test_given_redirects_and_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.io/1", None), (2, "http://b.io/2", None)], "page_id long, url string, html string")
    hops = spark.createDataFrame([("http://a.io/1", "https://x.io/"), ("http://x.io/", "http://bad.io/z"), (None, "q")], "from_url string, to_url string")
    rules = spark.createDataFrame([("block", "bad.io", "/")], "action string, host string, path string")
    got = {r["page_id"]: r["verdict"] for r in url_alias.judge(pages, rules, hops).collect()}
    assert got == {1: "block", 2: "allow"}
    assert url_alias.judge(pages.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_dir):
    """Every stage over what its predecessor wrote, against the operators called directly."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_dir}/{name}")
        seen.append((name, docs, spark.read.parquet(f"{tmp_dir}/{name}")))
        docs = seen[-1][2]
    (_, raw, good), (_, _, alone), (_, _, clean), (_, _, mixed), (_, _, tokens) = seen
    assert all(d.columns == raw.columns for d in (good, alone, clean, mixed))
    scores = quality_rda.train_and_score(raw, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r[0] for r in good.select("doc_id").collect()} == {r["doc_id"] for r in scores.collect() if r["predicted"] == 1}
    kept = {r["doc_id"] for r in bagminhash.near_duplicates(good).collect() if r["kept"]}
    assert sorted(r[0] for r in alone.select("doc_id").collect()) == sorted(kept)
    ids = sorted(kept)
    assert [sorted(r[0] for r in d.select("doc_id").collect()) for d in (clean, mixed, tokens)] == [ids] * 3
    assert clean.filter("text rlike 'AKIA[0-9A-Z]{16}'").count() == 0
    ran = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, ran.collect())) == sorted(map(tuple, tokens.collect()))


def test_tokens_keep_the_mixture(spark, tmp_dir):
    """By the position in the last stage's rows, every prefix holds the sources' shares, in the order of the written files."""
    sizes = {"a": 1500, "b": 700, "c": 333, None: 70}
    names = [s for s, n in sizes.items() for _ in range(n)]
    docs = spark.createDataFrame(
        [(None if i % 50 == 0 else i // 2, f"text {i}", "en", s, 6) for i, s in enumerate(names)], "doc_id long, text string, lang string, source string, n_chars long"
    )
    corpus_pipeline.mixing_stage(spark, docs, SF).write.parquet(f"{tmp_dir}/mixture")
    files = sorted(pathlib.Path(f"{tmp_dir}/mixture").glob("*.parquet"))
    wrote = pd.concat([pd.read_parquet(f) for f in files], ignore_index=True)
    rows = corpus_pipeline.token_stage(spark, spark.read.parquet(f"{tmp_dir}/mixture"), SF).collect()
    got = sorted(rows, key=lambda r: r["mix_order"])
    assert len({r["mix_order"] for r in got}) == len(got) == len(names)
    assert [r["decoded_sha256"] for r in got] == [hashlib.sha256(t.encode()).hexdigest() for t in wrote["text"]]
    assert [r["doc_id"] for r in got] == [None if pd.isna(d) else int(d) for d in wrote["doc_id"]]
    source = [None if pd.isna(s) else s for s in wrote["source"]]
    slots = list(dict.fromkeys((r["mix_slot"], s) for r, s in zip(got, source)))
    assert [k for k, _ in slots] == list(range(len(slots)))
    assert fluid_gap([s for _, s in slots], {s: n**0.5 for s, n in sizes.items()}, {s: -(-n // pfair_mix.BLOCK_ROWS) for s, n in sizes.items()}) < 1 + 1e-6


def test_pipeline_on_no_rows(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs.select("doc_id", "text", "lang", "source", "n_chars"), SF).count() == 0


def test_every_query_is_registered():
    q = E.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in q) == 1
    assert "pipeline" in q and set(llm.oracle_sql()) <= set(q)
