"""Byte-level BPE over a global shuffle of distinct words, and its decoder.

Texts are cut into pre-tokens.  Documents are gathered into blocks of bounded
size; a block keeps its distinct words once and each document as the positions'
word numbers.  The words of all blocks are dealt out by hash, so that every
distinct word meets in one place and is merged once; its ids travel back to the
blocks that asked, where documents are put together by position.  A word that
is in every text is thus one entry for each block, not one for each occurrence.
Decoding gathers the token-byte table (bounded by the vocabulary).
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spread, stored_in_buckets, table

BLOCK_CHARS = 8_000_000
SEGMENT_DOCS = 500
_FRAME = "block long, part int, ids array<long>, lens binary, data binary"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _pack(a: np.ndarray) -> bytes:
    """int32 numbers as compressed byte planes; frequent words have small numbers."""
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(a.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


class _Block:
    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.words: defaultdict = defaultdict()
        self.words.default_factory = self.words.__len__
        self.docs: list = []
        self.codes: list = []

    def add(self, doc, found: list, chars: int) -> None:
        self.docs.append(doc)
        self.codes.append(np.fromiter(map(self.words.__getitem__, found), np.int32, len(found)))
        self.chars += chars

    def rows(self, parts: int) -> pd.DataFrame:
        """Frames of the block: word lists by part, their places, and the documents."""
        out = []
        every = np.concatenate(self.codes) if self.codes else np.zeros(0, np.int32)
        words = list(self.words)
        by_word = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        uses = np.bincount(every, minlength=len(words))
        # frequent words get small numbers; equally frequent ones stay in order, so that they pack well
        by_use = by_word[np.argsort(-uses[by_word], kind="stable")] if len(words) else by_word
        code = np.empty(len(words), np.int32)
        code[by_use] = np.arange(len(words), dtype=np.int32)
        raw = [words[i].encode("utf-8", "surrogatepass") for i in by_use]
        part = np.fromiter((zlib.crc32(w) % parts for w in raw), np.int64, len(raw))
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        pack = zstandard.ZstdCompressor(level=3).compress
        for p in range(parts):
            at = order[cuts[p] : cuts[p + 1]]
            if len(at):
                own = [raw[i] for i in at]
                out.append((self.number, p, None, _pack(np.array([len(w) for w in own])), pack(b"".join(own))))
        out.append((self.number, -2, None, None, _pack(np.diff(order, prepend=0))))
        for a in range(0, len(self.docs), SEGMENT_DOCS):
            codes = self.codes[a : a + SEGMENT_DOCS]
            sizes = np.array([len(c) for c in codes])
            out.append((self.number, -1, self.docs[a : a + SEGMENT_DOCS], _pack(sizes), _pack(code[np.concatenate(codes)])))
        return pd.DataFrame(out, columns=["block", "part", "ids", "lens", "data"])


def _blocked(pattern: str, parts: int, block_chars: int):
    def run(batches):
        find = regex.compile(pattern).findall
        first = TaskContext.get().partitionId() << 32
        block = _Block(first)
        for pdf in batches:
            ids = [None if i is None or i != i else int(i) for i in pdf["id"].tolist()]
            for doc, text in zip(ids, pdf["text"].tolist()):
                text = text or ""
                block.add(doc, find(text), len(text))
                if block.chars >= block_chars:
                    yield block.rows(parts)
                    block = _Block(block.number + 1)
        if block.docs:
            yield block.rows(parts)

    return run


def _merged(ranks: dict[bytes, int]):
    def run(batches):
        one = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        known: dict[bytes, list[int]] = {}
        for pdf in batches:
            out = []
            for block, part, lens, data in zip(pdf["block"], pdf["part"], pdf["lens"], pdf["data"]):
                data = zstandard.ZstdDecompressor().decompress(data)
                sizes, ids, a = [], [], 0
                for b in np.cumsum(_unpack(lens)).tolist():
                    w = data[a:b]
                    a = b
                    e = known.get(w)
                    if e is None:
                        e = known[w] = one(w)
                    sizes.append(len(e))
                    ids += e
                out.append((block, part, None, _pack(np.array(sizes)), _pack(np.array(ids))))
            yield pd.DataFrame(out, columns=["block", "part", "ids", "lens", "data"])

    return run


def _gather(starts: np.ndarray, lens: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The positions of the entries of ``codes``, one after the other."""
    n = lens[codes]
    ends = np.cumsum(n)
    return np.repeat(starts[codes] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)


def _assembled(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """A block's documents as ids, from their word numbers and the words' ids."""
    docs, ids = [], []
    place = left.loc[left["part"] == -2, "data"]
    if len(place):
        order = np.cumsum(_unpack(place.iloc[0]).astype(np.int64))
        right = right.sort_values("part")
        none = [np.zeros(0, np.int32)]
        lens_p = np.concatenate([_unpack(x) for x in right["lens"]] + none).astype(np.int64)
        flat = np.concatenate([_unpack(x) for x in right["data"]] + none)
        lens, starts = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        lens[order], starts[order] = lens_p, np.cumsum(lens_p) - lens_p
        segments = left[left["part"] == -1]
        for d, n, data in zip(segments["ids"], segments["lens"], segments["data"]):
            codes = _unpack(data)
            out = flat[_gather(starts, lens, codes)]
            ends = np.concatenate([[0], np.cumsum(lens[codes])])[np.concatenate([[0], np.cumsum(_unpack(n))]).astype(np.int64)]
            docs.extend(d)
            ids.extend(out[a:b] for a, b in zip(ends, ends[1:]))
    return pd.DataFrame({"doc_id": pd.array([None if i is None or i != i else int(i) for i in docs], "Int64"), "ids": ids})


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id, ids array<int>) of every row; a null or empty text has no ids.

    ``ranks`` must hold all 256 single bytes.  Repeated rows and null or
    repeated doc_ids each give their own row.  Words are dealt into as many
    parts as the session has shuffle partitions.
    """
    parts = spread(docs)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    blocks = stored_in_buckets(src.mapInPandas(_blocked(pattern, parts, block_chars), _FRAME), "bpe-blocks", "block", parts)
    words = blocks.filter("part >= 0").repartition(parts, "part").mapInPandas(_merged(ranks), _FRAME)
    left = blocks.filter("part < 0")
    return left.groupBy("block").cogroup(words.groupBy("block")).applyInPandas(_assembled, "doc_id long, ids array<int>")


def token_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all bytes, and each id's start and length."""
    top = max(ranks.values(), default=-1) + 1
    by_id = [b""] * top
    for b, i in ranks.items():
        by_id[i] = b
    lens = np.array([len(b) for b in by_id], np.int64)
    return np.frombuffer(b"".join(by_id), np.uint8), np.cumsum(lens) - lens, lens


def decoded(table_of_bytes, ids: np.ndarray) -> bytes:
    """The bytes of a sequence of ids."""
    flat, starts, lens = table_of_bytes
    return flat[_gather(starts, lens, ids)].tobytes() if len(ids) else b""


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, bytes) of every row of (doc_id, ids): its ids joined with the token-byte table."""
    lookup = token_bytes(ranks)

    def run(batches):
        for pdf in batches:
            pdf["bytes"] = [decoded(lookup, np.asarray(x)) for x in pdf["ids"]]
            yield pdf[["doc_id", "bytes"]]

    return encoded.mapInPandas(run, "doc_id long, bytes binary")


def digests(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of (doc_id, ids), by ``decode``'s table join."""
    lookup = token_bytes(ranks)
    top = len(lookup[2])

    def run(batches):
        text = np.array([str(i) for i in range(top)], object)
        for pdf in batches:
            rows = []
            for doc, x in zip(pdf["doc_id"], pdf["ids"]):
                x = np.asarray(x)
                ids = ",".join(text[x]).encode() if len(x) else b""
                rows.append((len(x), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded(lookup, x)).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    return encoded.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokenised(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The digests of ``docs``; rank file and pattern default to the public multi-language vocabulary."""
    import public_tokenizers

    ranks = read_ranks(ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return digests(encode(docs, ranks, pattern or public_tokenizers.PATTERN), ranks)


def op4_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenised(table(spark, sf_dir, "documents"))
