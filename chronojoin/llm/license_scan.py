"""License scan by a positional index of rare license words.

The index is made from templates: short license names and notices.  A first
pass over all documents counts in how many of them each template word occurs
(only these counts meet the driver, as many as the templates have words).  Of
each mandatory key phrase the word with the highest IDF becomes its anchor, and
of each template the rarest words become its postings (word, position, weight).

The second pass handles each file within its own row, without a shuffle:

1. the positions of those rare words in the file are looked up;
2. every anchor position minus the anchor's position in a template is a shift,
   the place where the template would begin; the shifts of a template's anchors
   are intersected, so that only shifts on which all agree remain;
3. at each remaining shift all words of the key phrases are compared.  What
   stands is a place of the template.

A key phrase holds its anchor, so no place of a template's key phrases is
missed, whatever the frequencies.  A template without further words (a license
name) is found at each such place; a notice also needs ``min_share`` of the IDF
weight of its rarest words at the very shift.  ``score`` is the best such share.

All work is DataFrame functions in the JVM.  Results: a null text is an empty
one, without words; repeated rows, null ids and equal ids are rows of their own;
an empty table gives an empty result; among equally rare words the smaller text
is the anchor; extra columns of the documents are not read; a very long text
needs memory for its own words only.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE_WORDS = 8
MIN_SHARE = 0.7


@dataclass(frozen=True)
class Template:
    """A license name or notice: ``text`` holds each of ``keys``, phrases that must stand in a file."""

    name: str
    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False


# fixed values: the names that a scan must always report, and passages of public license notices
TEMPLATES = (
    Template("mit-name", "mit", "mit license", ("mit license",), True),
    Template("apache-name", "apache", "apache license", ("apache license",), True),
    Template("gpl-name", "gpl", "general public license", ("general public license",), True),
    Template("apache-2.0-name", "apache-2.0", "apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-3.0-name", "gpl-3.0", "gnu general public license version 3", ("general public license version 3",)),
    Template("lgpl-name", "lgpl", "lesser general public license", ("lesser general public license",)),
    Template("agpl-name", "agpl", "affero general public license", ("affero general public license",)),
    Template("mpl-name", "mpl", "mozilla public license", ("mozilla public license",)),
    Template("cc-by-nc", "cc-by-nc", "licensed under cc by nc", ("cc by nc",)),
    Template("cc-by-sa", "cc-by-sa", "licensed under cc by sa", ("cc by sa",)),
    Template("cc-by", "cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("bsd-name", "bsd", "bsd license", ("bsd license",)),
    Template(
        "mit-notice", "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template(
        "apache-notice", "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ("except in compliance with the license",),
    ),
    Template(
        "gpl-notice", "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        ("under the terms of the gnu general public license", "free software foundation"),
    ),
    Template(
        "bsd-notice", "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "isc-notice", "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Template(
        "unlicense-notice", "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software", "released into the public domain"),
    ),
)


def words_of(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]+", lambda m: m[0].lower(), text))


def key_places(t: Template) -> list[tuple[int, list[str]]]:
    """(position in the template, words) of each mandatory key phrase."""
    words, out = words_of(t.text), []
    for key in t.keys:
        k = words_of(key)
        at = next((i for i in range(len(words) - len(k) + 1) if words[i : i + len(k)] == k), None)
        if not k or at is None:
            raise ValueError(f"template {t.name!r} does not hold its key phrase {key!r}")
        out.append((at, k))
    if not out:
        raise ValueError(f"template {t.name!r} has no key phrase")
    return out


@dataclass(frozen=True)
class Posting:
    word: str
    pos: int
    weight: float


@dataclass(frozen=True)
class Indexed:
    """A template with its anchors (one for each key phrase) and postings of its rarest words."""

    template: Template
    anchors: tuple[Posting, ...]
    postings: tuple[Posting, ...]


def build_index(templates, n_docs: int, df: dict[str, int], rare_words: int = RARE_WORDS) -> list[Indexed]:
    """Anchors and postings by IDF = ln((n + 1) / (df + 1)); equally rare words in order of their text."""

    def rarity(word):
        return df.get(word, 0), word

    out = []
    for t in templates:
        words = words_of(t.text)

        def posting(pos):
            return Posting(words[pos], pos, math.log((n_docs + 1) / (df.get(words[pos], 0) + 1)))

        anchors = [posting(min(range(at, at + len(k)), key=lambda i: (*rarity(words[i]), i))) for at, k in key_places(t)]
        rarest = set(sorted(set(words), key=rarity)[:rare_words])
        out.append(Indexed(t, tuple(anchors), tuple(posting(i) for i, w in enumerate(words) if w in rarest)))
    return out


def _words(text: Column) -> Column:
    # only A-Z become lower case: the Kelvin sign alone would turn into an ASCII letter otherwise, and the
    # lower case of any other letter beyond ASCII is no ASCII word, so it neither ends a word nor equals one
    plain = F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\u00c5")))
    return F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))


def document_counts(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """The number of documents, and in how many of them each word of ``vocabulary`` occurs."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    # an empty word of its own in every document counts the documents
    found = F.concat(F.array(F.lit("")), F.array_intersect(_words(F.col("text")), known))
    rows = docs.select(F.explode(found).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["w"]: r["n"] for r in rows}
    return counts.pop("", 0), counts


def _all(conds) -> Column:
    out = None
    for c in conds:
        out = c if out is None else out & c
    return out


def _shifts(a: Posting) -> Column:
    at = F.filter("_hits", lambda h: h["w"] == F.lit(a.word))
    return F.transform(at, lambda h: h["i"] - F.lit(a.pos))


def _places(x: Indexed) -> Column:
    """The shifts on which all anchors agree and whose key phrases stand in full."""
    shifts = F.array_distinct(_shifts(x.anchors[0]))
    for a in x.anchors[1:]:
        shifts = F.array_intersect(shifts, _shifts(a))
    need = [(at + j, w) for at, k in key_places(x.template) for j, w in enumerate(k)]
    # the template may begin before the file does: only its key phrases have to lie within
    return F.filter(
        shifts, lambda s: _all(F.coalesce(F.get("_words", s + F.lit(i)) == F.lit(w), F.lit(False)) for i, w in need)
    )


def _share(x: Indexed, places: Column) -> Column:
    """The best share of the postings' weight that stands at one of the template's ``places``; null without a place."""
    total = sum(p.weight for p in x.postings)
    if total <= 0:  # its words are in every document: the key phrases alone decide
        return F.when(F.size(places) > 0, F.lit(1.0))

    def share(s):
        got = F.lit(0.0)
        for p in x.postings:
            got = got + F.when(F.get("_words", s + F.lit(p.pos)) == F.lit(p.word), F.lit(p.weight)).otherwise(F.lit(0.0))
        return F.round(got / F.lit(total), 6)

    return F.array_max(F.transform(places, share))


def scanned(docs: DataFrame, templates=TEMPLATES, rare_words: int = RARE_WORDS, min_share: float = MIN_SHARE) -> DataFrame:
    """Per document: doc_id, n_words, and matches, one for each template found.

    ``matches``: array of (template, label, base, places, share), where ``places``
    are the words (from 0) at which the template begins, negative where its first
    words are cut off, and ``share`` the best share of its rare words' weight.
    """
    vocabulary = sorted({w for t in templates for w in words_of(t.text)})
    index = build_index(templates, *document_counts(docs, vocabulary), rare_words)
    rare = sorted({a.word for x in index for a in x.anchors})
    d = docs.select("doc_id", _words(F.col("text")).alias("_words"))
    d = d.withColumn(
        "_hits",
        F.filter(
            F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: h["w"].isin(rare)
        ),
    )
    d = d.withColumns({f"_p{n}": _places(x) for n, x in enumerate(index)})
    matches = [
        F.struct(
            F.lit(x.template.name).alias("template"),
            F.lit(x.template.label).alias("label"),
            F.lit(x.template.base).alias("base"),
            F.col(f"_p{n}").alias("places"),
            _share(x, F.col(f"_p{n}")).alias("share"),
        )
        for n, x in enumerate(index)
    ]
    kept = F.filter(F.array(*matches), lambda m: m["base"] & (F.size(m["places"]) > 0) | (m["share"] >= min_share))
    return d.select("doc_id", F.size("_words").cast("long").alias("n_words"), kept.alias("matches"))


def license_scan(found: DataFrame) -> DataFrame:
    """The digest of ``scanned``: counts and places of the base names, labels and score of each document."""
    base = F.filter("matches", lambda m: m["base"])
    places = F.flatten(F.transform(base, lambda m: m["places"]))

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda m: m["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(scanned(table(spark, sf_dir, "documents")))


def op11_sql(templates=TEMPLATES, rare_words: int = RARE_WORDS, min_share: float = MIN_SHARE) -> str:
    """DuckDB SQL from the rule itself: all words of all key phrases, counted for each place, without anchors."""
    posts = [f"('{t.name}', {i}, '{w}')" for t in templates for i, w in enumerate(words_of(t.text))]
    keys = [f"('{t.name}', {i}, '{w}')" for t in templates for i, w in sorted({(at + j, w) for at, k in key_places(t) for j, w in enumerate(k)})]
    names = [f"('{t.name}', '{t.label}', {t.base})" for t in templates]
    return f"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '{WORD}') AS w FROM documents),
tok AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
posts(name, pos, word) AS (VALUES {", ".join(posts)}),
keys(name, pos, word) AS (VALUES {", ".join(keys)}),
names(name, label, base) AS (VALUES {", ".join(names)}),
known AS (SELECT r, i, word FROM tok WHERE word IN (SELECT word FROM posts)),
seen AS (SELECT word, count(DISTINCT r) AS df FROM known GROUP BY 1),
ranked AS (
  SELECT name, word, coalesce(df, 0) AS df, row_number() OVER (PARTITION BY name ORDER BY coalesce(df, 0), word) AS k
    FROM (SELECT DISTINCT name, word FROM posts) LEFT JOIN seen USING (word)),
rare AS (
  SELECT name, pos, word, ln(((SELECT count(*) FROM d) + 1) / (df + 1)) AS weight
    FROM posts JOIN ranked USING (name, word) WHERE k <= {rare_words}),
place AS (
  SELECT r, name, s FROM (
    SELECT r, name, i - pos AS s, count(*) AS n FROM known JOIN keys USING (word) GROUP BY ALL)
    JOIN (SELECT name, count(*) AS n FROM keys GROUP BY 1) USING (name, n)),
share AS (
  SELECT p.r, p.name, p.s,
         CASE WHEN sum(weight) <= 0 THEN 1.0
              ELSE round(coalesce(sum(weight) FILTER (WHERE known.word = rare.word), 0.0) / sum(weight), 6) END AS share
    FROM place p JOIN rare USING (name) LEFT JOIN known ON known.r = p.r AND known.i = p.s + rare.pos GROUP BY ALL),
found AS (SELECT * FROM share JOIN names USING (name) WHERE base OR share >= {min_share}),
best AS (
  SELECT r, count(*) FILTER (WHERE base) AS n_base, min(s) FILTER (WHERE base) AS first_word,
         max(s) FILTER (WHERE base) AS last_word,
         list_sort(list_distinct(list(label) FILTER (WHERE base))) AS b, list_sort(list_distinct(list(label))) AS l,
         max(share) AS score FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(array_to_string(b, ','), '') AS base_labels,
       coalesce(array_to_string(l, ','), '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
  FROM d LEFT JOIN best USING (r)"""


OP11_SQL = op11_sql()
