"""Whole texts to token ids with the tokenizers library, one call for each distinct word a worker meets.

The public vocabularies split a text into pieces before they merge bytes, and no piece crosses the places where these
functions cut it. So the ids of a text are the joined ids of its cuts. Cuts are found, hashed and joined by numpy for a
whole batch; a table of sorted hashes has the ids of those seen before, and only new ones go to the library. Texts with
white space of other shapes go to it whole.
"""

from __future__ import annotations

import functools
import re
from array import array

import numpy as np

from . import kernels as K

#: Cuts in a worker's table; a full table is emptied. One takes about 30 bytes.
MOST = 3_000_000

_U = np.uint64


@functools.cache
def _tokenizer(name: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def _library(name: str, texts: list[str]) -> list[bytes]:
    tok, out = _tokenizer(name), []
    for i in range(0, len(texts), 5000):
        out += [array("H", e.ids).tobytes() for e in tok.encode_batch_fast(texts[i : i + 5000], add_special_tokens=False)]
    return out


#: A run of marks after a letter is a piece of its own in both vocabularies.
_MARKS = ".,!?:;|"
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)))


def keys(h: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Hashes of words of a kind."""
    with np.errstate(over="ignore"):
        return K.mix(h + kind.astype(np.uint64) * _U(0x9E3779B97F4A7C15))


class Level:
    """Sorted hashes beside their entries' numbers, with a directory of the hashes' leading bits."""

    def __init__(self) -> None:
        self.hashes, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self._index()

    def _index(self) -> None:
        bits = max(8, int(len(self.hashes)).bit_length() + 1)
        self.shift = _U(64 - bits)
        self.directory = np.concatenate([[0], np.cumsum(np.bincount((self.hashes >> self.shift).astype(np.int64), minlength=1 << bits))]).astype(np.int32)

    def insert(self, h: np.ndarray, entry: np.ndarray) -> None:
        where = np.searchsorted(self.hashes, h)
        self.hashes, self.entry = np.insert(self.hashes, where, h), np.insert(self.entry, where, entry)
        self._index()

    def find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1, np.int32)
        if not len(self.hashes):
            return out
        bucket = (h >> self.shift).astype(np.int32)
        at, end = self.directory[bucket], self.directory[bucket + 1]
        at = np.minimum(at, len(self.hashes) - 1)
        hit = self.hashes[at] == h
        out[hit] = self.entry[at[hit]]
        todo = np.flatnonzero(~hit & (at + 1 < end))
        at, end = at[todo] + 1, end[todo]
        while len(todo):
            hit = self.hashes[at] == h[todo]
            out[todo[hit]] = self.entry[at[hit]]
            more = ~hit & (at + 1 < end)
            todo, at, end = todo[more], at[more] + 1, end[more]
        return out


class Table:
    """Ids of cuts by hash. New entries go to a small level, which joins the large one when it is an eighth of it."""

    def __init__(self, name: str) -> None:
        self.name = name
        self.clear()

    def clear(self) -> None:
        self.large, self.small = Level(), Level()
        self.start, self.size, self.pool = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint16)
        self.marks: dict[str, bytes] = {}

    def find(self, h: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 if there is none."""
        out = self.large.find(h)
        rest = np.flatnonzero(out < 0)
        if len(rest) and len(self.small.hashes):
            out[rest] = self.small.find(h[rest])
        return out

    def _insert(self, h: np.ndarray, rows: list[bytes]) -> None:
        """Entries with these ids for new, sorted hashes."""
        size = np.array([len(r) >> 1 for r in rows], np.int32)
        new = np.arange(len(self.start), len(self.start) + len(rows), dtype=np.int32)
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(size, dtype=np.int32) - size])
        self.size = np.concatenate([self.size, size])
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(rows), np.uint16)])
        self.small.insert(h, new)
        if len(self.small.hashes) > max(20_000, len(self.large.hashes) // 8):
            self.large.insert(self.small.hashes, self.small.entry)
            self.small = Level()

    def learn(self, words: list[str], kind: np.ndarray, prefix: list[str], lead: list[bytes]) -> None:
        """Entries for new words of a kind. A word that ends in marks is its stem's ids and the marks', so a stem goes to
        the library once, whatever follows it."""
        stems, tails = [], []
        for word in words:
            stem = word.rstrip(_MARKS)
            cut = len(stem) if stem and stem[-1] in _LETTERS else len(word)
            stems.append(word[:cut])
            tails.append(word[cut:])
        h, first = np.unique(keys(K.words(["\n".join(stems)]).hashes, kind), return_index=True)
        fresh = self.find(h) < 0
        first = first[fresh].tolist()
        kinds = kind.tolist()
        ids = _library(self.name, [prefix[kinds[i]] + stems[i] for i in first])
        if first:
            self._insert(h[fresh], [lead[kinds[i]] + row for i, row in zip(first, ids, strict=True)])
        marked = [i for i, t in enumerate(tails) if t]
        if not marked:
            return
        fresh = list({tails[i] for i in marked}.difference(self.marks))
        self.marks.update(zip(fresh, _library(self.name, fresh), strict=True))
        entry = self.find(keys(K.words(["\n".join(stems[i] for i in marked)]).hashes, kind[marked])).tolist()
        start, size = self.start[entry].tolist(), self.size[entry].tolist()
        rows = [self.pool[s : s + n].tobytes() + self.marks[tails[i]] for i, s, n in zip(marked, start, size, strict=True)]
        h, first = np.unique(keys(K.words(["\n".join(words[i] for i in marked)]).hashes, kind[marked]), return_index=True)
        new = self.find(h) < 0
        self._insert(h[new], [rows[i] for i in first[new].tolist()])

    def ids(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The joined ids of entries, and where each one's begin."""
        size = self.size[entries]
        end = np.cumsum(size, dtype=np.int64)
        at = np.repeat((self.start[entries] - (end - size)).astype(np.int32), size)
        at += np.arange(len(at), dtype=np.int32)
        return self.pool[at], np.concatenate([[0], end])


_table = functools.cache(Table)


def _encode(texts: list[str], name: str, kinds, lead: list[bytes], prefix: list[str]) -> list[bytes]:
    """kinds(words): each word's kind, and which texts can't be cut; lead and prefix: by kind, the ids before a word's
    and what its cut begins with."""
    table, w = _table(name), K.words(texts)
    kind, odd = kinds(w)
    if len(table.start) > MOST:
        table.clear()
    h = keys(w.hashes, kind)
    entries = table.find(h)
    gone = np.flatnonzero((entries < 0) & ~odd[w.doc])
    if len(gone):
        at = gone[np.unique(h[gone], return_index=True)[1]]
        new = [w.buf[a:b].decode("utf-8", "surrogatepass") for a, b in zip(w.starts[at].tolist(), w.ends[at].tolist(), strict=True)]
        table.learn(new, kind[at], prefix, lead)
        entries[gone] = table.find(h[gone])
    if len(table.start) == 0:
        return [b"" if not o else b for o, b in zip(odd, _library(name, texts), strict=True)] if odd.any() else [b""] * len(texts)
    keep = entries >= 0
    if odd.any():
        keep &= ~odd[w.doc]
        bounds = np.concatenate([[0], np.cumsum(keep)])[w.first]
    else:
        bounds = w.first
    ids, begin = table.ids(entries[keep])
    cut = begin[bounds]
    out = [ids[a:b].tobytes() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    if odd.any():
        which = np.flatnonzero(odd).tolist()
        for i, whole in zip(which, _library(name, [texts[i] for i in which]), strict=True):
            out[i] = whole
    return out


def _batches(encode):
    """Encodes each distinct text of a batch once, in slices that fit the processor's caches."""

    @functools.wraps(encode)
    def run(texts: list[str | None], *args: str) -> list[bytes]:
        distinct = list(dict.fromkeys(t or "" for t in texts))
        ids, first, size = {}, 0, 0
        for i, t in enumerate(distinct):
            size += len(t)
            if size >= 1 << 20 or i + 1 == len(distinct):
                part = distinct[first : i + 1]
                ids.update(zip(part, encode(part, *args), strict=True))
                first, size = i + 1, 0
        return [ids[t or ""] for t in texts]

    return run


@_batches
def encode_words(texts: list[str], name: str = "word_bpe_49k.json") -> list[bytes]:
    """Ids (little-endian 16 bits) by a vocabulary that drops white space and case: a text is cut at its ASCII white
    space. Texts are lowered first, which saves entries, but for two letters that Python lowers by their place and for
    names of special tokens."""
    lowered = [t if "<|" in t or "Σ" in t or "İ" in t else t.lower() for t in texts]
    return _encode(lowered, name, lambda w: (np.zeros(len(w.starts), np.int64), np.zeros(len(texts), bool)), [b""], [""])


#: White space beyond ASCII, whose runs may join pieces.
_WIDE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")


@_batches
def encode_bytes(texts: list[str], name: str = "byte_bpe_50k.json") -> list[bytes]:
    """Ids (little-endian 16 bits) by a byte-level vocabulary whose pieces begin with at most one space.

    Between two words of a line stands one space, which opens the second word's piece; a line feed between two words is
    a piece of its own. Texts of only such gaps are cut there."""

    def kinds(w: K.Words) -> tuple[np.ndarray, np.ndarray]:
        opens = np.zeros(len(w.starts), bool)
        opens[w.first[:-1][w.counts > 0]] = True
        before = w.a[np.maximum(w.starts - 1, 0)]
        kind = np.where(opens, 0, np.where(before == 10, 2, 1))
        wrong = ~opens & ((before != 32) & (before != 10))
        wrong[1:] |= ~opens[1:] & (w.starts[1:] - w.ends[:-1] != 1)
        odd = np.bincount(w.doc[wrong], minlength=len(texts)) > 0
        size = np.diff(w.offsets) - 1
        full = w.counts > 0
        odd |= ~full & (size > 0)
        odd[full] |= (w.starts[w.first[:-1][full]] != w.offsets[:-1][full]) | (w.ends[w.first[1:][full] - 1] != w.offsets[1:][full] - 1)
        odd |= np.array([_WIDE.search(t) is not None for t in texts], bool)
        return kind, odd

    line = _library(name, ["\n"])[0]
    return _encode(texts, name, kinds, [b"", b"", line], ["", " ", ""])
