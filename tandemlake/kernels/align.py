"""Affine-gap global alignment of many queries to one target, vectorised over the batch and the query.

Scores are whole hundredths, so ties are exact. An insertion is extra query, a deletion is skipped target. Within a row
the best insertion is a prefix maximum, as its cost is linear in its length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Scoring:
    """Hundredths of a point; a gap of n costs open + (n - 1) * extend, at the ends end_open and end_extend."""

    match: int
    mismatch: int
    ins_open: int
    ins_extend: int
    del_open: int
    del_extend: int
    end_open: int
    end_extend: int


# Discovery, validation and locator scores.
DISCOVERY = Scoring(200, -500, -1500, -5, -20000, -150, 0, 0)
VALIDATION = Scoring(200, -200, -1500, -1, -20000, -200, -20000, -20000)
LOCATOR = Scoring(200, -200, -500, -50, -500, -50, -500, -50)

_LOW = np.int32(-(1 << 29))
#: How far paths may stray beyond the difference of the lengths: tried in turn, and then without bound.
BANDS = (0, 8, 40)


@dataclass
class Alignment:
    score: int
    blocks: list[tuple[int, int, int, int]]  # t0, t1, q0, q1
    matches: int
    aligned: int

    @property
    def inserted(self) -> int:
        return sum(n for _, _, n in insertions(self.blocks))


def insertions(blocks: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """(t, q, size) where the query gains more than the target between neighbouring blocks."""
    out = []
    for a, b in zip(blocks[:-1], blocks[1:], strict=True):
        size = (b[2] - a[3]) - (b[0] - a[1])
        if size > 0:
            out.append((a[1], a[3], size))
    return out


def gapped(target: str, query: str, blocks: list[tuple[int, int, int, int]]) -> tuple[str, str]:
    """Both sequences with dashes, as the blocks lay them; between blocks, what both have left stands in columns of its own."""
    top, bottom, t, q = [], [], 0, 0
    for t0, t1, q0, q1 in [*blocks, (len(target), len(target), len(query), len(query))]:
        top += [target[t:t0], "-" * (q0 - q), target[t0:t1]]
        bottom += ["-" * (t0 - t), query[q:q0], query[q0:q1]]
        t, q = t1, q1
    return "".join(top), "".join(bottom)


def render(target: str, query: str, blocks: list[tuple[int, int, int, int]], width: int = 60) -> str:
    """The alignment as text: lines of target, marks and query, each with the bases before it and up to its end."""
    top, bottom = gapped(target, query, blocks)
    marks = "".join("|" if a == b else " " if "-" in (a, b) else "." for a, b in zip(top, bottom, strict=True))
    lines, t, q = [], 0, 0
    for i in range(0, len(top), width):
        a, m, b = (x[i : i + width] for x in (top, marks, bottom))
        nt, nq = t + len(a) - a.count("-"), q + len(b) - b.count("-")
        lines.append(f"target {t:>6} {a} {nt}\n{'':13} {m}\nquery  {q:>6} {b} {nq}\n")
        t, q = nt, nq
    return "\n".join(lines)


def align_batch(target: str, queries: list[str], s: Scoring, bands: tuple[int, ...] = BANDS) -> list[Alignment]:
    """The best alignment of each query. One found in a band counts if its score is above that of any path that leaves the
    band: all best paths then lie within, and the choice among them is the same; other queries go on to the next band."""
    out: list[Alignment | None] = [None] * len(queries)
    by_length: dict[int, list[int]] = {}
    for i, q in enumerate(queries):
        by_length.setdefault(len(q), []).append(i)
    for m, rows in by_length.items():
        n = len(target)
        for band in [*(w for w in bands if min(m, n) > 0 and abs(m - n) + 2 * w + 1 < m // 2), None]:
            width = m if band is None else abs(m - n) + 2 * band + 1
            step = max(1, (1 << 23) // (max(width, 1) * max(n, 1)))
            left = []
            for a in range(0, len(rows), step):
                part = rows[a : a + step]
                texts = [queries[i] for i in part]
                found = _align(target, texts, m, s) if band is None else _align_in_band(target, texts, m, s, band)
                for i, r in zip(part, found, strict=True):
                    out[i] = r
                    if r is None:
                        left.append(i)
            rows = left
            if not rows:
                break
    return out


def most_outside(n: int, m: int, band: int, s: Scoring) -> int:
    """No path that leaves the band scores more: it inserts and deletes band + 1 more than the lengths ask for. Opening costs
    at least as much as extending, and a gap at least as much as the cheaper of those within and at the ends."""
    inserted, deleted = max(m - n, 0) + band + 1, max(n - m, 0) + band + 1
    ins = max(s.ins_open, s.end_open) + (inserted - 1) * max(s.ins_extend, s.end_extend)
    return s.match * max(m - inserted, 0) + ins + max(s.del_open, s.end_open) + (deleted - 1) * max(s.del_extend, s.end_extend)


def _align_in_band(target: str, queries: list[str], m: int, s: Scoring, band: int) -> list[Alignment | None]:
    """_align over the cells whose column exceeds their row by lo to lo + width - 1; None where a path outside may be as good. Queries
    lie along the last axis, so that running maxima over columns go over all queries at once."""
    n, b = len(target), len(queries)
    lo = min(m - n, 0) - band
    width = abs(m - n) + 2 * band + 1
    q = np.frombuffer("".join(queries).encode(), np.uint8).reshape(b, m)
    t = np.frombuffer(target.encode(), np.uint8)
    k = np.arange(width, dtype=np.int32)[:, None]
    # column of q that row i's first cell is matched with: i + lo - 1, shifted by the padding before
    before = 1 - lo
    against = {}
    for c in np.unique(t).tolist():
        against[c] = np.full((before + m + n + width, b), s.mismatch, np.int32)
        against[c][before : before + m] = np.where(q.T == c, np.int32(s.match), np.int32(s.mismatch))
    h = np.where(k + lo > 0, s.end_open + (k + lo - 1) * s.end_extend, np.where(k + lo == 0, 0, _LOW)).astype(np.int32)
    h = np.broadcast_to(h, (width, b)).copy()
    d = np.full((width, b), _LOW, np.int32)
    moves = np.zeros((n + 1, width, b), np.int8)
    runs = np.zeros((n + 1, width, b), np.int16)
    longer = np.zeros((n + 1, width, b), bool)
    origin = np.zeros((n + 1, width, b), np.int16)
    moves[0] = 2
    places = np.broadcast_to(k.astype(np.int16), (width, b))
    new, on, ins = (np.full((width, b), _LOW, np.int32) for _ in range(3))
    top, lifted, low = (np.empty((width, b), np.int32) for _ in range(3))
    at = np.empty((width, b), np.int16)
    for i in range(1, n + 1):
        np.add(h[1:], np.int32(s.del_open), out=new[:-1])
        np.add(d[1:], np.int32(s.del_extend), out=on[:-1])
        last = m - i - lo
        if 0 <= last < width - 1:
            new[last], on[last] = h[last + 1] + s.end_open, d[last + 1] + s.end_extend
        np.greater(on, new, out=longer[i])
        np.maximum(new, on, out=d)
        start = -i - lo
        x = i + lo - 1 + before
        np.add(h, against[int(t[i - 1])][x : x + width], out=top)
        if 0 <= start < width:
            d[start], top[start], longer[i, start] = s.end_open + (i - 1) * s.end_extend, _LOW, i > 1
        move = moves[i]
        np.greater(d, top, out=move.view(bool))
        np.maximum(top, d, out=h)
        if width > 1:
            first, further = (s.end_open, s.end_extend) if i == n else (s.ins_open, s.ins_extend)
            np.subtract(h, further * k, out=lifted)
            np.maximum.accumulate(lifted, axis=0, out=low)
            np.multiply(places, lifted == low, out=at)
            np.maximum.accumulate(at[:-1], axis=0, out=origin[i, 1:])
            origin[i] += np.int16(i + lo)
            np.add(low[:-1], first + further * (k[1:] - 1), out=ins[1:])
            move[ins > h] = 2
            np.maximum(h, ins, out=h)
        np.multiply(runs[i - 1] + np.int16(1), move == 0, out=runs[i])
        if 0 <= start < width:
            runs[i, start] = 0
    score, most = h[m - n - lo], most_outside(n, m, band, s)
    return [_trace(t, q[r], moves[:, :, r], runs[:, :, r], longer[:, :, r], origin[:, :, r], int(score[r]), lo) if score[r] > most else None for r in range(b)]


def _align(target: str, queries: list[str], m: int, s: Scoring) -> list[Alignment]:
    n, b = len(target), len(queries)
    q = np.frombuffer("".join(queries).encode(), np.uint8).reshape(b, m)
    t = np.frombuffer(target.encode(), np.uint8)
    j = np.arange(m + 1, dtype=np.int32)

    def end_cost(k: np.ndarray) -> np.ndarray:
        return np.where(k > 0, s.end_open + (k - 1) * s.end_extend, 0).astype(np.int32)

    h = np.broadcast_to(end_cost(j), (b, m + 1)).copy()
    d = np.full((b, m + 1), _LOW, np.int32)
    moves = np.zeros((n + 1, b, m + 1), np.int8)  # 0 diagonal, 1 deletion, 2 insertion
    runs = np.zeros((n + 1, b, m + 1), np.int16)  # diagonal moves in a row that end here
    longer = np.zeros((n + 1, b, m + 1), bool)  # the deletion goes on
    origin = np.zeros((n + 1, b, m + 1), np.int16)  # where the insertion begins
    moves[0] = 2
    # scores of all queries against each base of the target
    against = {c: np.where(q == c, np.int32(s.match), np.int32(s.mismatch)) for c in np.unique(t).tolist()}
    places = np.broadcast_to(j.astype(np.int16), (b, m + 1))
    new, on, lifted, low = (np.empty((b, m + 1), np.int32) for _ in range(4))
    top, ins = np.full((b, m + 1), _LOW, np.int32), np.full((b, m + 1), _LOW, np.int32)
    at = np.empty((b, m + 1), np.int16)
    for i in range(1, n + 1):
        np.add(h, np.int32(s.del_open), out=new)
        np.add(d, np.int32(s.del_extend), out=on)
        # deletions at the query's end are end gaps
        new[:, m], on[:, m] = h[:, m] + s.end_open, d[:, m] + s.end_extend
        np.greater(on, new, out=longer[i])
        np.maximum(new, on, out=d)
        d[:, 0] = s.end_open + (i - 1) * s.end_extend
        longer[i, :, 0] = i > 1
        np.add(h[:, :-1], against[int(t[i - 1])], out=top[:, 1:])
        move = moves[i]
        np.greater(d, top, out=move.view(bool))
        np.maximum(top, d, out=h)
        first, further = (s.end_open, s.end_extend) if i == n else (s.ins_open, s.ins_extend)
        np.subtract(h, further * j, out=lifted)
        np.maximum.accumulate(lifted, axis=1, out=low)
        np.multiply(places, lifted == low, out=at)
        np.maximum.accumulate(at[:, :-1], axis=1, out=origin[i, :, 1:])
        np.add(low[:, :-1], first + further * (j[1:] - 1), out=ins[:, 1:])
        move[ins > h] = 2
        np.maximum(h, ins, out=h)
        np.multiply(runs[i - 1, :, :-1] + np.int16(1), move[:, 1:] == 0, out=runs[i, :, 1:])
    return [_trace(t, q[r], moves[:, r], runs[:, r], longer[:, r], origin[:, r], int(h[r, m])) for r in range(b)]


def _trace(t: np.ndarray, q: np.ndarray, moves: np.ndarray, runs: np.ndarray, longer: np.ndarray, origin: np.ndarray, score: int, lo: int | None = None) -> Alignment:
    """The best path from its end: a whole block, deletion or insertion at a time. lo: in a band (see _align_in_band)."""
    place = (lambda i, j: (i, j)) if lo is None else (lambda i, j: (i, j - i - lo))
    i, j = len(t), len(q)
    blocks: list[tuple[int, int, int, int]] = []
    while i > 0 and j > 0:
        move = moves[place(i, j)]
        if move == 0:
            k = int(runs[place(i, j)])
            if blocks and blocks[-1][0] == i and blocks[-1][2] == j:
                last = blocks.pop()
                blocks.append((i - k, last[1], j - k, last[3]))
            else:
                blocks.append((i - k, i, j - k, j))
            i, j = i - k, j - k
        elif move == 1:
            while i > 0 and longer[place(i, j)]:
                i -= 1
            i -= 1
        else:
            j = int(origin[place(i, j)])
    blocks.reverse()
    matches = sum(int((t[a:b] == q[c:d]).sum()) for a, b, c, d in blocks)
    return Alignment(score, blocks, matches, sum(x[1] - x[0] for x in blocks))


def score_of(target: str, query: str, blocks: list[tuple[int, int, int, int]], s: Scoring) -> int:
    """The score of an alignment given by its blocks."""
    total, t, q = 0, 0, 0
    gap = lambda k, o, e: o + (k - 1) * e if k > 0 else 0
    for n, (t0, t1, q0, q1) in enumerate([*blocks, (len(target), len(target), len(query), len(query))]):
        end = n == 0 or n == len(blocks)
        total += gap(t0 - t, *((s.end_open, s.end_extend) if end else (s.del_open, s.del_extend)))
        total += gap(q0 - q, *((s.end_open, s.end_extend) if end else (s.ins_open, s.ins_extend)))
        total += sum(s.match if a == b else s.mismatch for a, b in zip(target[t0:t1], query[q0:q1], strict=True))
        t, q = t1, q1
    return total
