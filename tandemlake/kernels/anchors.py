"""Anchor search and placement of insertions on single sequences."""

from __future__ import annotations

import numpy as np


def hits(seq: str, anchor: str, k: int) -> list[tuple[int, int]]:
    """Places and mismatches of all substitution-only hits with at most k mismatches in A, C, G, T."""
    n = len(anchor)
    if not 0 <= k < n:
        raise ValueError("mismatches must be at least 0 and fewer than the anchor's bases")
    if len(seq) < n:
        return []
    windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(seq.encode(), np.uint8), n)
    wrong = (windows != np.frombuffer(anchor.encode(), np.uint8)).sum(1)
    return [(int(p), int(wrong[p])) for p in np.flatnonzero(wrong <= k) if not set(seq[p : p + n]) - set("ACGT")]


def locate(seq: str, left: str, right: str, k: int) -> tuple[str, int | None, int | None, int | None, int | None]:
    """Outcome, places and mismatches of the only ordered pair of anchors."""
    a, b = hits(seq, left, k), hits(seq, right, k)
    pairs = [(x, y, m, n) for x, m in a for y, n in b if x + len(left) <= y]
    if not a or not b or len(pairs) != 1:
        why = "missing_left_anchor" if not a else "missing_right_anchor" if not b else "ambiguous_anchor_pair" if pairs else "no_ordered_anchor_pair"
        return why, None, None, None, None
    return "anchored", *pairs[0]


def duplication_identity(ref: str, pos: int, inserted: str) -> float:
    """Greatest share of bases an insertion has in common with the reference copy of its size on either side."""
    n = len(inserted)
    sides = [ref[pos - n : pos] if pos >= n else "", ref[pos : pos + n]]
    return max((sum(x == y for x, y in zip(inserted, side, strict=True)) / n for side in sides if len(side) == n), default=0.0)


def place(ref: str, allele: str, low: int, high: int) -> tuple[int, float]:
    """Of the equivalent boundaries low to high, the one of the best adjacent copy, the least on ties; and its identity."""
    net = len(allele) - len(ref)
    scored = [(duplication_identity(ref, p, allele[p : p + net]), -p) for p in range(low, high + 1)]
    identity, back = max(scored)
    return -back, identity
