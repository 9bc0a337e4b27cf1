"""Five-word shingles of texts as hashed multisets, in numpy over batches."""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np

from .common import GOLDEN, mix64

BASE = np.uint64(0xD6E8FEB86659FD93)


@functools.cache
def _classes() -> np.ndarray:
    """1 for every code point that belongs to a word (letter, mark, digit, underscore)."""
    t = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] in "LMN":
            t[c] = 1
    t[ord("_")] = 1
    return t


@functools.cache
def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, BASE, np.uint64), dtype=np.uint64)


def word_hashes(texts: list, prefix: int | None = None) -> tuple[np.ndarray, ...]:
    """(doc, hash) of every lower-cased word, in order; null texts have none.

    With ``prefix`` also the hash of each word's first ``prefix`` characters.
    """
    low = [t.lower() if t else "" for t in texts]
    ends = np.cumsum([len(t) + 1 for t in low])
    cp = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _classes()[cp]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return none if prefix is None else (*none, none[1])
    at = np.flatnonzero(inside)
    lens = stops - starts
    first = np.concatenate([[0], np.cumsum(lens)[:-1]])
    place = np.arange(len(at)) - np.repeat(first, lens)
    p = _powers(1 << max(10, int(lens.max()).bit_length()))
    with np.errstate(over="ignore"):
        each = mix64(cp[at].astype(np.uint64) + GOLDEN) * p[place]
        h = np.add.reduceat(each, first)
    doc = np.searchsorted(ends, starts, side="right")
    out = doc, mix64(h + lens.astype(np.uint64))
    if prefix is None:
        return out
    with np.errstate(over="ignore"):
        return *out, mix64(np.add.reduceat(np.where(place < prefix, each, np.uint64(0)), first) ^ GOLDEN)


def shingles(texts: list, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of every run of ``k`` words; a text of 1 to k - 1 words has one, of all its words."""
    doc, h = word_hashes(texts)
    n = len(h)
    if not n:
        return doc, h
    per = np.bincount(doc, minlength=len(texts))
    odd = mix64(np.arange(1, k + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
    with np.errstate(over="ignore"):
        acc = np.zeros(max(n - k + 1, 0), np.uint64)
        for j in range(k):
            acc += h[j : j + len(acc)] * odd[j]
        full = doc[: len(acc)] == doc[k - 1 :] if len(acc) else np.zeros(0, bool)
        out_d, out_h = [doc[: len(acc)][full]], [mix64(acc[full])]
        small = np.flatnonzero((per > 0) & (per < k))
        if len(small):
            first = np.searchsorted(doc, small)
            for d, f in zip(small, first):
                w = h[f : f + per[d]]
                out_d.append(np.array([d]))
                out_h.append(mix64((w * odd[: len(w)]).sum(dtype=np.uint64, keepdims=True) ^ np.uint64(len(w))))
    d, s = np.concatenate(out_d), np.concatenate(out_h)
    if len(small):
        order = np.argsort(d, kind="stable")
        d, s = d[order], s[order]
    return d, s


def multisets(texts: list, k: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, hash, count) of the distinct shingles, sorted by doc and hash."""
    d, s = shingles(texts, k)
    if not len(d):
        return d, s, np.zeros(0, np.int64)
    order = np.lexsort((s, d))
    d, s = d[order], s[order]
    new = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (d[1:] != d[:-1])]))
    return d[new], s[new], np.diff(np.append(new, len(d)))
