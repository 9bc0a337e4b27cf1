"""Divergence between the sources of a language, by Gustavson's row accumulation.

Terms are counted for each (lang, source) group; a language keeps the terms of
enough documents.  A group's smoothed share of a term is the integer
``p = 1 + floor(UNIT * (count + SMOOTH) / (N + SMOOTH * V))``, and the divergence
of two groups the sum of ``|p - q|`` over all V kept terms of the language.

The kept counts form a sparse matrix, groups by terms.  Cut into blocks of terms
it is term-major: each term's postings are the groups that have it.  For each
block a group takes its own terms and scatters them through the postings into a
dense accumulator with one cell for each peer (a row of the product of the matrix
with its transpose, but with ``|p - q|`` in place of the product).  No pair of
postings leaves the task: a block returns its accumulators, one array a group.

A term that a group lacks still has its share there, the *zero baseline*
``z = 1 + floor(UNIT * SMOOTH / (N + SMOOTH * V))``.  For groups i and j a block's
sum over its T terms is therefore

    sum over i's terms |p_i - z_j|  +  sum over j's terms |z_i - p_j|
    + sum over shared terms (|p_i - p_j| - |p_i - z_j| - |z_i - p_j| + |z_i - z_j|)
    + (T - T_i - T_j) * |z_i - z_j|

in which only the third sum needs the postings; the first two come from sorted
shares and their running sums.  All arithmetic is in whole numbers.

Scale.  Tasks count terms in a dictionary of bounded size before anything is
shuffled, so a source or term that is in every document is one row for each
dictionary.  Blocks are dealt by a hash of the term and hold about
``BLOCK_POSTINGS`` postings, or as many as there are pairs of groups if that is
more, so that accumulators never outweigh postings; groups beyond ``CELLS``
accumulator cells are cut into row blocks, each of which sees the block's
postings.

Results: null texts, languages and sources count as ''; an empty table gives an
empty result; repeated rows and equal ids count as often as they occur; equal
values rank by the item's bytes; other columns are not read.  A very long text
needs memory for its own distinct words.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, stored, table

UNIT = 1_000_000_000
SMOOTH = 5
MIN_DOCUMENTS = 30
TOP_TERMS = 50
BLOCK_POSTINGS = 25_000
CELLS = 4_000_000
DICTIONARY = 500_000

# bytes of a text that belong to no term become spaces, A-Z becomes a-z
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """The runs of ASCII letters and characters beyond ASCII, A-Z lower-cased, in UTF-8."""
    return text.encode().translate(_TERM_BYTES).split()


_COUNTS = "lang string, source string, term string, n long, d long"


def _counted(batches):
    """(lang, source, term, occurrences, documents) of a task's rows, one row for each dictionary.

    Every group also gets a row with the empty term, so that groups without
    terms are not lost.
    """
    groups: dict = {}
    size = 0
    for batch in batches:
        for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source"))):
            found = terms_of(text)
            n, d = groups.get((lang, source)) or groups.setdefault((lang, source), (Counter({b"": 0}), Counter()))
            size -= len(n)
            n.update(found)
            d.update(set(found))
            size += len(n)
            if size > DICTIONARY:
                yield from _emptied(groups)
                size = 0
    yield from _emptied(groups)


def _emptied(groups: dict):
    for (lang, source), (n, d) in groups.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.repeat(pa.scalar(lang, pa.string()), len(n)),
                pa.repeat(pa.scalar(source, pa.string()), len(n)),
                pa.array(n, pa.binary()).cast(pa.string()),
                pa.array(n.values(), pa.int64()),
                pa.array(map(d.__getitem__, n), pa.int64()),
            ],
            names=["lang", "source", "term", "n", "d"],
        )
    groups.clear()


def term_counts(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Kept counts: lang, source, term, n, lang_n (of the term in the language), first (once for each term).

    A group's row with the empty term and n = 0 says that the group occurs.
    """
    small_batches(docs.sparkSession)
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    parts = named.mapInArrow(_counted, _COUNTS)
    sums = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    w = Window.partitionBy("lang", "term")
    sums = sums.select(
        "lang", "source", "term", "n", F.sum("n").over(w).alias("lang_n"), F.sum("d").over(w).alias("lang_d"),
        (F.col("source") == F.min("source").over(w)).alias("first"),
    )
    return sums.filter((F.col("term") == "") | (F.col("lang_d") >= min_documents)).drop("lang_d")


def smoothed(n: Column, total: Column, terms: Column) -> Column:
    """The integer share ``1 + floor(UNIT * (n + SMOOTH) / (total + SMOOTH * terms))``, without overflow."""
    top = F.lit(UNIT).cast("decimal(10,0)") * (n + F.lit(SMOOTH)).cast("decimal(20,0)")
    below = (total + F.lit(SMOOTH) * terms).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, below)


def group_totals(
    counts: DataFrame, block_postings: int = BLOCK_POSTINGS, cells: int = CELLS
) -> DataFrame:
    """Per (lang, source): its total and z, its place ``no`` among the language's sources, and of the language
    lang_total, terms, blocks (of terms), height (groups of a row block) and bands (row blocks)."""
    is_term = F.col("term") != ""
    groups = counts.groupBy("lang", "source").agg(
        F.sum("n").alias("total"),
        F.sum((is_term & F.col("first")).cast("long")).alias("firsts"),
        F.sum(is_term.cast("long")).alias("own"),
    )
    lang = Window.partitionBy("lang")
    groups = groups.select(
        "lang", "source", "total",
        (F.row_number().over(lang.orderBy("source")) - 1).alias("no"),
        F.count(F.lit(1)).over(lang).alias("groups"),
        F.sum("total").over(lang).alias("lang_total"),
        F.sum("firsts").over(lang).alias("terms"),
        F.sum("own").over(lang).alias("postings"),
    )
    pairs = F.least(F.col("groups") * F.col("groups"), F.lit(cells))
    blocks = F.ceil(F.col("postings") / F.greatest(F.lit(block_postings), pairs))
    groups = groups.withColumn("blocks", F.greatest(F.lit(1), blocks).cast("int")).drop("postings")
    # rows of accumulators that fit: at least one group's
    height = F.greatest(F.lit(1), F.floor(F.lit(cells) / F.col("groups"))).cast("int")
    groups = groups.withColumn("height", height).withColumn("bands", F.ceil(F.col("groups") / F.col("height")).cast("int"))
    # without kept terms nothing is shared out
    return groups.withColumn("z", F.when(F.col("terms") > 0, smoothed(F.lit(0), F.col("total"), F.col("terms"))))


def _spread_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each x of ``at`` the sum of ``|v - x|`` over ``values``, from sorted values and running sums."""
    v = np.sort(values)
    run = np.concatenate([[0], np.cumsum(v)])
    k = np.searchsorted(v, at)
    return (at * k - run[k]) + ((run[-1] - run[k]) - at * (len(v) - k))


def accumulate(no: np.ndarray, term: np.ndarray, p: np.ndarray, z: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of ``|p_i - p_j|`` over a block's terms, for the groups i of ``rows`` and all j.

    ``no``, ``term`` and ``p`` are the postings; ``z`` each group's baseline.
    Every value is a whole number below 2**53, so the sums are exact.
    """
    groups, n_terms = len(z), 0
    acc = np.zeros((len(rows), groups), np.int64)
    if len(term):
        _, code = np.unique(term, return_inverse=True)
        n_terms = int(code[-1] if code.size == 1 else code.max()) + 1
        order = np.argsort(code, kind="stable")  # term-major
        no, code, p = no[order], code[order], p[order]
        start = np.searchsorted(code, np.arange(n_terms + 1))
        by_group = np.argsort(no, kind="stable")
        bounds = np.searchsorted(no[by_group], np.arange(groups + 1))
    own = np.zeros(groups, np.int64)
    row_of = {int(i): k for k, i in enumerate(rows)}
    if n_terms:
        own[:] = np.diff(bounds)
        for j in range(groups):
            mine = by_group[bounds[j] : bounds[j + 1]]
            if not len(mine):
                continue
            p_mine = p[mine]
            acc[:, j] += _spread_sums(p_mine, z[rows])  # sum over j's terms |z_i - p_j|
            k = row_of.get(j)
            if k is None:
                continue
            acc[k] += _spread_sums(p_mine, z)  # sum over i's terms |p_i - z_j|
            # the row's scatter: every posting of every term of the group, one cell for each peer
            first, size = start[code[mine]], np.diff(start)[code[mine]]
            for a, b in _pieces(size):
                f, s = first[a:b], size[a:b]
                at = np.repeat(f - np.concatenate([[0], np.cumsum(s)[:-1]]), s) + np.arange(s.sum())
                peer, pj, pi = no[at], p[at], np.repeat(p_mine[a:b], s)
                d = np.abs(pi - pj) - np.abs(pi - z[peer]) - np.abs(z[j] - pj) + np.abs(z[j] - z[peer])
                acc[k] += np.bincount(peer, weights=d, minlength=groups).astype(np.int64)
    acc += (n_terms - own[rows][:, None] - own[None, :]) * np.abs(z[rows][:, None] - z[None, :])
    return acc


def _pieces(size: np.ndarray, most: int = 1 << 20):
    """Stretches of terms with about ``most`` postings each."""
    cut = np.cumsum(size) // most
    edges = np.concatenate([[0], np.nonzero(np.diff(cut))[0] + 1, [len(size)]])
    return zip(edges[:-1], edges[1:])


def _block(postings: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    groups = groups.rename(columns=lambda c: c.lstrip("_")).sort_values("no")
    rows = groups["no"].to_numpy()[groups["mine"].to_numpy(bool)]
    if not len(rows):
        return pd.DataFrame(columns=["lang", "no", "sums"])
    z = groups["z"].fillna(0).to_numpy(np.int64)
    term = pd.factorize(postings["term"])[0]
    sums = accumulate(postings["no"].to_numpy(np.int64), term, postings["p"].to_numpy(np.int64), z, rows)
    return pd.DataFrame({"lang": groups["lang"].iloc[0], "no": rows, "sums": list(sums)})


def _numbered(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def pair_sums(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Per language and two of its groups (no, peer, both ways): value, the sum of ``|p - q|``."""
    left = (
        shares.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
        .withColumn("band", _numbered("bands"))
        .select(*[F.col(c).alias(c) for c in ("lang", "block", "band", "term", "no", "p")])
    )
    right = (
        groups.withColumn("block", _numbered("blocks"))
        .withColumn("band", _numbered("bands"))
        .withColumn("mine", F.floor(F.col("no") / F.col("height")) == F.col("band"))
        .select(*[F.col(c).alias(f"_{c}") for c in ("lang", "block", "band", "no", "z", "mine")])
    )
    key = ["lang", "block", "band"]
    sums = left.groupBy(*key).cogroup(right.groupBy(*[f"_{c}" for c in key])).applyInPandas(_block, "lang string, no int, sums array<long>")
    return (
        sums.select("lang", "no", F.posexplode("sums").alias("peer", "value"))
        .filter(F.col("no") != F.col("peer"))
        .groupBy("lang", "no", "peer")
        .agg(F.sum("value").alias("value"))
    )


def _ranked(df: DataFrame) -> DataFrame:
    w = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return df.withColumn("rank", F.row_number().over(w))


def divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Rows lang, source, part, item, value, rank: every other source of the language by its
    divergence (part ``pair``), and the terms that most exceed their share in the language (part ``term``)."""
    counts = stored(term_counts(docs, min_documents), "divergence-counts")
    groups = stored(group_totals(counts), "divergence-groups")
    shares = (
        counts.filter(F.col("term") != "")
        .join(groups, ["lang", "source"])
        .select(
            "lang", "source", "no", "term", "blocks", "bands",
            smoothed(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
            smoothed(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
        )
    )
    names = groups.select("lang", "source", "no")
    pairs = (
        pair_sums(shares, groups)
        .join(names, ["lang", "no"])
        .join(names.select(F.col("lang"), F.col("no").alias("peer"), F.col("source").alias("item")), ["lang", "peer"])
        .select("lang", "source", "item", "value")
    )
    terms = shares.filter(F.col("p") > F.col("q")).select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    cols = ["lang", "source", "part", "item", "value", "rank"]
    top = _ranked(terms).filter(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    return _ranked(pairs).withColumn("part", F.lit("pair")).select(*cols).unionByName(top.select(*cols))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP12_SQL = f"""WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
grp AS (SELECT DISTINCT lang, source FROM d),
occ AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM occ GROUP BY 1, 2 HAVING count(DISTINCT r) >= {MIN_DOCUMENTS}),
cnt AS (SELECT lang, source, term, count(*) AS n FROM occ JOIN kept USING (lang, term) GROUP BY ALL),
lang_cnt AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM cnt GROUP BY ALL),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY 1),
lang_total AS (SELECT lang, sum(n)::HUGEINT AS total FROM lang_cnt GROUP BY 1),
total AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM grp LEFT JOIN cnt USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + {SMOOTH})) // (t.total + {SMOOTH} * v.v) AS p
    FROM grp g JOIN kept k USING (lang) JOIN v USING (lang) JOIN total t USING (lang, source)
    LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (
  SELECT lang, term, 1 + ({UNIT}::HUGEINT * (n + {SMOOTH})) // (total + {SMOOTH} * v) AS q
    FROM lang_cnt JOIN lang_total USING (lang) JOIN v USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
   GROUP BY ALL),
term AS (
  SELECT lang, source, term AS item, (p - q)::BIGINT AS value
    FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term', item, value FROM term)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM ranked)
 WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
