"""Language identification by cross-parsing entropy.

For every language a suffix automaton of labelled reference text recognises
all its substrings.  A text is parsed greedily into the longest phrases that
occur in the reference; the language whose parse needs the fewest phrases,
each weighted by the bits of a position in its reference, wins.

The automata are dense tables, and a batch of texts is parsed in step: texts
are cut into pieces of ``PIECE`` symbols (a phrase ends there at the latest, in
every language alike) and all pieces advance by one symbol at a time.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, chunks_of_texts, mix64, small_batches, table

ALPHABET = 64
REFERENCE = 16_000
TABLE_BYTES = 64 << 20
REFERENCE_DOCS = 64
WINDOW = 4_096
PIECE = 1_024
CHUNK_CHARS = 4_000_000


@functools.cache
def _letters() -> np.ndarray:
    """True for every code point that is a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)])


def symbol_map(texts: list[str]) -> np.ndarray:
    """Symbol of every code point: 0 for what is no letter, the commonest letters their own, the others a hashed one."""
    use = Counter()
    for t in texts:
        use.update(t.lower())
    top = [c for c, _ in sorted(use.items(), key=lambda x: (-x[1], x[0])) if _letters()[ord(c)]][: ALPHABET // 2]
    codes = np.arange(sys.maxunicode + 1, dtype=np.uint64)
    out = (len(top) + 1 + (mix64(codes) % np.uint64(ALPHABET - 1 - len(top))).astype(np.int64)).astype(np.uint8)
    out[~_letters()] = 0
    for i, c in enumerate(top):
        out[ord(c)] = i + 1
    return out


def symbols(texts: list, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts in lower case, runs of non-letters as one 0, none at a text's ends; and each text's number of symbols."""
    low = [t.lower() if t else "" for t in texts]
    cp = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    s = of[cp]
    doc = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])
    letter = s > 0
    before = np.concatenate([[False], letter[:-1]])
    # a 0 stays where it follows a letter of the same text, unless no letter follows
    keep = letter | (before & (np.concatenate([[-1], doc[:-1]]) == doc))
    s, doc = s[keep], doc[keep]
    last = np.concatenate([doc[1:] != doc[:-1], [True]]) if len(doc) else np.zeros(0, bool)
    keep = ~(last & (s == 0))
    return s[keep], np.bincount(doc[keep], minlength=len(low))


def suffix_automaton(s: list[int]) -> np.ndarray:
    """states x ALPHABET next states of the automaton of all substrings, -1 where there is none; state 0 is empty."""
    size, link, nxt, last = [0], [-1], [{}], 0
    for c in s:
        cur = len(size)
        size.append(size[last] + 1)
        link.append(0)
        nxt.append({})
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if size[p] + 1 == size[q]:
                link[cur] = q
            else:
                clone = len(size)
                size.append(size[p] + 1)
                link.append(link[q])
                nxt.append(dict(nxt[q]))
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    out = np.full((len(size), ALPHABET), -1, np.int32)
    for i, d in enumerate(nxt):
        for c, j in d.items():
            out[i, c] = j
    return out


def walk_table(automaton: np.ndarray, first: int) -> np.ndarray:
    """For each state and symbol: ALPHABET times the next state (counted from ``first``), plus 1 where a phrase ends before it."""
    alone = len(automaton)  # one more state: after an unseen symbol, which is a phrase by itself
    root = np.where(automaton[0] >= 0, automaton[0], alone)
    to = np.vstack([np.where(automaton >= 0, automaton, root[None, :]), root[None, :]])
    ends = np.vstack([automaton < 0, np.ones((1, ALPHABET), bool)])
    ends[0] = False
    return ((to + first) * ALPHABET + ends).astype(np.int32)


class Parser:
    """Languages with their joined walk tables."""

    def __init__(self, references: dict[str, list[str]], reference: int):
        self.languages = sorted(references)
        texts = [t for l in self.languages for t in references[l]]
        self.of = symbol_map(texts)
        tables, self.roots, self.bits, first = [], [], [], 0
        for l in self.languages:
            s, _ = symbols([" ".join(references[l])], self.of)
            a = suffix_automaton(s[:reference].tolist())
            tables.append(walk_table(a, first))
            self.roots.append(first * ALPHABET)
            self.bits.append(np.log2(max(len(s[:reference]), 2)))
            first += len(a) + 1
        self.table = np.concatenate(tables).ravel()
        self.roots, self.bits = np.array(self.roots, np.int32), np.array(self.bits)

    def phrases(self, s: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """texts x languages: phrases of the greedy parses."""
        n_lang = len(self.languages)
        out = np.zeros((len(sizes), n_lang))
        n_pieces = -(-sizes // PIECE)
        doc = np.repeat(np.arange(len(sizes)), n_pieces)
        if not len(doc):
            return out
        inner = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        start = (np.cumsum(sizes) - sizes)[doc] + inner * PIECE
        length = np.minimum(sizes[doc] - inner * PIECE, PIECE)
        order = np.argsort(-length, kind="stable")
        doc, start, length = doc[order], start[order], length[order]
        base = np.repeat(self.roots[:, None], len(doc), axis=1)
        count = np.ones(base.shape, np.int32)
        active = np.searchsorted(-length, -np.arange(int(length[0])), side="left")
        for t in range(int(length[0])):
            k = active[t]
            v = self.table[base[:, :k] + s[start[:k] + t]]
            e = v & 1
            count[:, :k] += e
            base[:, :k] = v - e
        for l in range(n_lang):
            out[:, l] = np.bincount(doc, weights=count[l], minlength=len(sizes))
        return out

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        """Language and score of every text: ``und`` and 0 without a letter."""
        s, sizes = symbols(texts, self.of)
        cost = self.phrases(s, sizes) * self.bits[None, :]
        best = cost.argmin(1)
        if len(self.languages) > 1:
            two = np.partition(cost, 1, axis=1)[:, :2]
            score = np.where(sizes > 0, two[:, 1] / np.maximum(two.sum(1), 1e-300), 0.0)
        else:
            score = np.where(sizes > 0, 1.0, 0.0)
        return [self.languages[b] if n else "und" for b, n in zip(best, sizes)], score


def learn(labelled: DataFrame, text_col: str, lang_col: str, id_col: str, reference: int = REFERENCE) -> Parser | None:
    """The parser of the rows' languages, from at most about ``2 REFERENCE_DOCS`` windows of ``WINDOW`` characters each.

    References have up to ``reference`` symbols, fewer where there are so many
    languages that the tables would pass ``TABLE_BYTES``.  None without rows.
    """
    h = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    src = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), h.alias("h")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    at = 1 + F.pmod(F.col("h"), F.greatest(F.length("text") - WINDOW, F.lit(1)))
    taken = bounded_sample(src, "lang", REFERENCE_DOCS, F.col("h")).select("lang", "h", F.substr("text", at, F.lit(WINDOW)).alias("t"))
    rows = sorted((r["lang"], r["h"], r["t"]) for r in taken.collect())
    if not rows:
        return None
    by: dict[str, list[str]] = {}
    for lang, _, t in rows:
        by.setdefault(lang, []).append(t)
    fit = TABLE_BYTES // (len(by) * 2 * ALPHABET * 4)
    size = max(64, min(reference, fit))
    for lang, texts in by.items():  # an even share of each document
        share = -(-2 * size // len(texts))
        by[lang] = [t[:share] for t in texts]
    return Parser(by, size)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    Learns from rows with text and language whose crc32(doc_id) mod 3 is not 1;
    held_out marks the others.  Whole texts are parsed.  lang_pred is ``und``
    and the score 0 for a null text, one without a letter, or when nothing was
    learned; ties go to the first language by name.  The score is the second
    best cost's share of the two best costs: 0.5 for a tie, towards 1 the
    clearer.  A null doc_id is not learned from and not held out; repeated rows
    each get a row.
    """
    small_batches(docs.sparkSession)
    part = F.crc32(F.col(id_col).cast("long").cast("string")) % 3
    parser = learn(docs.filter(part != 1), text_col, lang_col, id_col)
    shared = docs.sparkSession.sparkContext.broadcast(parser)

    def run(batches):
        p = shared.value
        for pdf in batches:
            texts, langs, scores = pdf["text"].tolist(), [], []
            if p is None:
                langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            else:
                for a, b in chunks_of_texts(texts, CHUNK_CHARS):
                    l, s = p.predict(texts[a:b])
                    langs += l
                    scores += s.tolist()
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "lang_pred": langs, "score": scores})

    src = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(part == 1, F.lit(False)).alias("held_out"), F.col(text_col).alias("text")
    )
    return src.mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op7_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
