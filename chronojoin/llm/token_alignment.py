"""Alignment of two tokenizers' tokens by skipping along diagonals.

A text is encoded by a byte-level BPE (A) and by a piece vocabulary (B); both
token lists cover the same bytes.  The byte offsets at which tokens of both end
cut them into groups.  With both lists as arrays of ends, a stretch of one-to-one
tokens is a run in which the arrays agree at the current shift of their indexes:
it is passed by probes of doubling length, and its end found by halving.  Where
they differ, the irregular group is walked token by token, always on the side
that ends first, until both end together; that sets the next shift.

Each step of the walk is a *link*, two tokens whose bytes overlap.  How often the
links of all documents join two ids is counted from blocks: a block of documents
of bounded size keeps its distinct id pairs once, with their number, and each
document as places in that list.  The pairs of all blocks are summed, the sums
go back to the blocks that asked, and only there to the documents.  A pair that
is in every document is one row for each block.

Results: a null or empty text, or one that either tokenizer does not give back
byte for byte, has no tokens; repeated rows, null ids and equal ids are rows of
their own; an empty table gives an empty result; equal counts are both the
highest; columns other than doc_id and text are not read.  A very long text is
a block of its own and needs memory for its own tokens.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe_words import _pack, _unpack
from .common import small_batches, stored, table

BLOCK_CHARS = 4_000_000
# above, character classes of the two byte-level implementations have not been compared one by one
_FAR = re.compile("[\U00030000-\U0010ffff]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes themselves, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class ByteTokenizer:
    """Ids of a byte-level BPE given as a ``tokenizers`` file, and each id's bytes.

    Where the merges are in the order of the ids, which makes the ids ranks, the
    same vocabulary runs in ``tiktoken`` with the same split; it gives the same
    ids (compared for every character below U+30000) several times faster.  Any
    other file or character goes to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        letters = byte_letters()
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        vocab = given["model"]["vocab"]
        tokens = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if all(c in letters for c in t)}
        special = {t["id"] for t in given.get("added_tokens", [])}
        self.bytes = [tokens.get(i, b"") for i in range(max([*tokens, *special]) + 1)]
        self.fast = self._ranked(given, vocab, {b: i for i, b in tokens.items() if i not in special})

    def _ranked(self, given: dict, vocab: dict, ranks: dict):
        pre = given.get("pre_tokenizer") or {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in given["model"]["merges"]]
        plain = given["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        if not plain or any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
            return None
        import public_tokenizers
        import tiktoken

        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> tuple[np.ndarray, bool]:
        """Ids, and whether they are known to give the text back: merging ranks only ever joins its bytes."""
        if self.fast is not None and not _FAR.search(text):
            return np.array(self.fast.encode_ordinary(text), np.int64), True
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int64), False


class PieceTokenizer:
    """Ids of a piece vocabulary with byte fallback, and each id's bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.own.get_piece_size()):
            piece = self.own.id_to_piece(i)
            is_byte = self.own.is_byte(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.own.encode(text), np.int64)


def align(ends_a: list[int], ends_b: list[int]):
    """(ends of groups in A, in B, tokens of A and of B that each link joins), as index arrays.

    ``ends_a`` and ``ends_b`` rise strictly and end alike.
    """
    i = j = 0
    n, m = len(ends_a), len(ends_b)
    runs: list = []
    group_a: list = []
    group_b: list = []
    link_a: list = []
    link_b: list = []
    while i < n:
        if ends_a[i] == ends_b[j]:
            most = min(n - i, m - j)
            done, step = 1, 2
            while done < most:
                step = min(step, most - done)
                p, q = i + done, j + done
                if ends_a[p : p + step] != ends_b[q : q + step]:
                    break
                done += step
                step *= 2
            while step > 1 and done < most:  # the first difference lies in the last probe
                step >>= 1
                p, q = i + done, j + done
                if ends_a[p : p + step] == ends_b[q : q + step]:
                    done += min(step, most - done)
            runs.append((i, j, done))
            i += done
            j += done
            continue
        x, y = ends_a[i], ends_b[j]
        while True:
            link_a.append(i)
            link_b.append(j)
            if x < y:
                i += 1
                x = ends_a[i]
            elif y < x:
                j += 1
                y = ends_b[j]
            else:
                break
        i += 1
        j += 1
        group_a.append(i)
        group_b.append(j)
    if runs:
        r = np.array(runs, np.int64)
        length = r[:, 2]
        along = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        run_a, run_b = np.repeat(r[:, 0], length) + along, np.repeat(r[:, 1], length) + along
    else:
        run_a = run_b = np.zeros(0, np.int64)

    def merged(irregular, regular):
        return np.sort(np.concatenate([np.array(irregular, np.int64), regular]))

    # groups and links both rise in A and in B, so each side can be sorted on its own
    return merged(group_a, run_a + 1), merged(group_b, run_b + 1), merged(link_a, run_a), merged(link_b, run_b)


class Aligner:
    """Tokens, groups and links of one text after another."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokenizer(path_a), PieceTokenizer(path_b)
        self.size = [np.array([len(t) for t in x.bytes], np.int64) for x in (self.a, self.b)]
        self.token = [np.array(x.bytes, dtype=object) for x in (self.a, self.b)]
        # each id's decimal digits, with the sign that follows it within and at the end of a group
        self.text = [
            np.array([[b"%d%s" % (i, s) for i in range(len(x.bytes))] for s in signs], dtype=object)
            for x, signs in ((self.a, (b",", b"|")), (self.b, (b",", b";")))
        ]
        self.n_b = len(self.b.bytes)

    def tokens(self, text: str | None):
        """Ids of A and of B; none where a text is not given back byte for byte."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        whole = " " + text
        b = self.b.encode(text)
        if b"".join(self.token[1][b].tolist()) != whole.encode():
            return none, none
        a, exact = self.a.encode(whole)
        if not exact and b"".join(self.token[0][a].tolist()) != whole.encode():
            return none, none
        return a, b

    def __call__(self, text: str | None):
        a, b = self.tokens(text)
        return a, b, *align(np.cumsum(self.size[0][a]).tolist(), np.cumsum(self.size[1][b]).tolist())

    def groups_text(self, a, b, ends_a, ends_b) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the ids of A and of B of each group."""
        if not len(a):
            return b""
        ia, ib = np.arange(len(a)), np.arange(len(b))
        ga, gb = np.searchsorted(ends_a, ia, "right"), np.searchsorted(ends_b, ib, "right")
        out = np.empty(len(a) + len(b), object)
        # before a token of A stand the tokens of B of earlier groups, before one of B also its own group's of A
        out[ia + np.concatenate([[0], ends_b])[ga]] = self.text[0][(ia + 1 == ends_a[ga]).astype(int), a]
        out[ib + ends_a[gb]] = self.text[1][(ib + 1 == ends_b[gb]).astype(int), b]
        return b"".join(out.tolist())[:-1]


_ALIGNER: dict = {}


def _aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _ALIGNER:
        _ALIGNER[paths] = Aligner(*paths)
    return _ALIGNER[paths]


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: doc_id, ids_a, ids_b, and the groups as the places after their last tokens, ends_a and ends_b."""
    small_batches(docs.sparkSession)

    def run(batches):
        one = _aligner((path_a, path_b))
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                a, b, ga, gb, _, _ = one(text)
                yield pd.DataFrame({"doc_id": [doc], "ids_a": [a], "ids_b": [b], "ends_a": [ga], "ends_b": [gb]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, ids_a array<long>, ids_b array<long>, ends_a array<long>, ends_b array<long>"
    )


_BLOCK = (
    "block long, codes array<long>, numbers array<long>, doc_ids array<long>, n_a array<long>, n_b array<long>, "
    "n_groups array<long>, n_links array<long>, sha array<string>, n_pairs array<long>, places binary, times binary"
)


class _Block:
    def __init__(self):
        self.rows: list = []
        self.codes: list = []
        self.times: list = []
        self.chars = 0

    def add(self, one: Aligner, doc, text) -> None:
        a, b, ga, gb, la, lb = one(text)
        codes, times = np.unique(a[la] * one.n_b + b[lb], return_counts=True)
        sha = hashlib.sha256(one.groups_text(a, b, ga, gb)).hexdigest() if len(a) else ""
        self.rows.append((doc, len(a), len(b), len(ga), len(la), sha, len(codes)))
        self.codes.append(codes)
        self.times.append(times)
        self.chars += len(text or "")

    def row(self, number: int) -> pd.DataFrame:
        doc, n_a, n_b, n_groups, n_links, sha, n_pairs = zip(*self.rows)
        codes, place = np.unique(np.concatenate(self.codes), return_inverse=True)
        times = np.concatenate(self.times)
        numbers = np.bincount(place, weights=times, minlength=len(codes)).astype(np.int64)
        # frequent pairs get small numbers, which pack well
        order = np.argsort(-numbers, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        values = [number, codes[order], numbers[order], list(doc), n_a, n_b, n_groups, n_links, list(sha), n_pairs]
        names = [c.split()[0] for c in _BLOCK.split(", ")]
        return pd.DataFrame([dict(zip(names, [*values, _pack(rank[place]), _pack(times)]))])


def blocks(docs: DataFrame, path_a: str, path_b: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of documents: distinct id pairs with their number, and each document's counts, digest and places."""
    small_batches(docs.sparkSession)

    def run(batches):
        one, block, number = _aligner((path_a, path_b)), _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc, text in zip(batch["doc_id"].astype(object), batch["text"]):
                block.add(one, None if pd.isna(doc) else int(doc), text)
                if block.chars >= block_chars:
                    yield block.row(number)
                    block, number = _Block(), number + 1
        if block.rows:
            yield block.row(number)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, _BLOCK)


def pair_counts(of_blocks: DataFrame, n_b: int) -> DataFrame:
    """code (``a * n_b + b``), count of its links in all documents, and best: no pair of that b has more."""
    pairs = of_blocks.select(F.explode(F.arrays_zip("codes", "numbers")).alias("p")).select("p.codes", "p.numbers")
    counts = pairs.groupBy(F.col("codes").alias("code")).agg(F.sum("numbers").alias("count"))
    w = Window.partitionBy(F.pmod("code", F.lit(n_b)))
    return counts.select("code", "count", (F.col("count") == F.max("count").over(w)).alias("best"))


_DOCS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _digest(block: pd.DataFrame, rated: pd.DataFrame) -> pd.DataFrame:
    out = []
    for r in block.itertuples():
        count = np.zeros(len(r.codes), np.int64)
        best = np.zeros(len(r.codes), bool)
        at = rated["place"].to_numpy(np.int64)
        count[at], best[at] = rated["count"].to_numpy(np.int64), rated["best"].to_numpy(bool)
        places, times = _unpack(r.places).astype(np.int64), _unpack(r.times).astype(np.int64)
        ends = np.cumsum(np.asarray(r.n_pairs, np.int64))
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[places], times * count[places])]
        n_best, count_sum = (s[ends] - s[np.concatenate([[0], ends[:-1]])] for s in sums)
        ids = pd.array([None if d is None or d != d else int(d) for d in r.doc_ids], dtype="Int64")
        out.append(
            pd.DataFrame({
                "doc_id": ids, "n_a": r.n_a, "n_b": r.n_b, "n_groups": r.n_groups, "n_links": r.n_links,
                "n_best": n_best, "count_sum": count_sum, "groups_sha256": r.sha,
            })
        )
    return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in _DOCS.split(", ")])


def alignment_digest(docs: DataFrame, path_a: str, path_b: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: counts of tokens, groups and links, the links' corpus-wide counts and the digest of the groups."""
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    found = stored(blocks(docs, path_a, path_b, block_chars), "alignment-blocks")
    rated = (
        found.select(F.col("block").alias("of"), F.posexplode("codes").alias("place", "code"))
        .join(pair_counts(found, n_b), "code")
        .select("of", "place", "count", "best")
    )
    return found.groupBy("block").cogroup(rated.groupBy("of")).applyInPandas(_digest, _DOCS)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return alignment_digest(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
