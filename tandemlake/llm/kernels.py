"""Numpy kernels over batches of whole texts: words, lines and their 64-bit hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit integers fixed by the seed."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed))


_BYTE = stream(256, 11)
_BASE = _U(0x2545F4914F6CDD1D)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.full(max(n, 2 * len(_powers)), _BASE, np.uint64))
        _powers = np.concatenate([np.ones(1, np.uint64), _powers])
    return _powers[:n]


def segment_hash(a: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """A hash of the bytes with ``inside`` set, from each start to the next one."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    # the place of each byte in its segment
    where = np.arange(len(a), dtype=np.int32)
    sizes = np.diff(starts, append=len(a))
    where[starts[0] :] -= np.repeat(starts.astype(np.int32), sizes)
    with np.errstate(over="ignore"):
        v = powers(max(int(sizes.max()), int(starts[0])) + 1)[where]
        v *= _BYTE[a]
        v *= inside
        return mix(np.add.reduceat(v, starts))


@dataclass
class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a batch: buf holds all texts, each followed by a line feed."""

    buf: bytes
    a: np.ndarray
    space: np.ndarray
    offsets: np.ndarray  # byte where each text begins, and the end
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words
    doc: np.ndarray  # text of each word
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(texts: list[str | None]) -> Words:
    return words_of([(t or "").encode("utf-8", "surrogatepass") for t in texts])


def words_of(blobs: list[bytes]) -> Words:
    """The words of texts in UTF-8."""
    buf = b"\n".join(blobs) + b"\n"
    a = np.frombuffer(buf, np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(b) + 1 for b in blobs])]).astype(np.int64)
    space = _SPACE[a]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    starts = np.flatnonzero(edge == -1)
    ends = np.flatnonzero(edge == 1)
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(blobs)), np.diff(first))
    return Words(buf, a, space, offsets, starts, ends, first, doc, segment_hash(a, starts, ~space))


def names(w: Words) -> np.ndarray:
    """A number for each word, equal for equal words only: words of one hash are compared byte by byte."""
    _, first, number = np.unique(w.hashes, return_index=True, return_inverse=True)
    sizes = w.ends - w.starts
    model = first[number]
    same = sizes == sizes[model]
    # words of one length are compared as rows of bytes
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            part = part[same[part] & (model[part] != part)]
            step = max(1, (1 << 22) // int(sizes[part[0]])) if len(part) else 1
            for i in range(0, len(part), step):
                rows = part[i : i + step]
                place = np.arange(sizes[rows[0]])
                same[rows] = (w.a[w.starts[rows, None] + place] == w.a[w.starts[model[rows], None] + place]).all(1)
    if not same.all():
        table: dict[bytes, int] = {}
        return np.array([table.setdefault(w.buf[a:b], len(table)) for a, b in zip(w.starts.tolist(), w.ends.tolist(), strict=True)], np.int64)
    return number


def windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each window of k consecutive words of one text."""
    n = len(w.hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(w.doc[:n] == w.doc[k - 1 :])
    factors = stream(k, 77) | _U(1)
    with np.errstate(over="ignore"):
        h = w.hashes[at] * factors[0]
        for j in range(1, k):
            h += w.hashes[at + j] * factors[j]
    return at, mix(h)


def equal_earlier(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: does an equal one precede it in its text, and does any other equal one exist there."""
    with np.errstate(over="ignore"):
        key = mix(h + mix(doc.astype(np.uint64) + _U(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    earlier, any_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    earlier[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return earlier, any_


def covered(n: int, at: np.ndarray, k: int) -> np.ndarray:
    """Which of n words lie in a window of k words that begins at one of ``at``."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, at, 1)
    np.add.at(d, np.minimum(at + k, n), -1)
    return np.cumsum(d[:n]) > 0


def per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the flags of each text, whose items begin at ``first``."""
    c = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return c[first[1:]] - c[first[:-1]]
