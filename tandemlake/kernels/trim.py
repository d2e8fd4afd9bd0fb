"""Approximate primer search: both primers within an edit budget, the 3' one at its rightmost place."""

from __future__ import annotations

import numpy as np

from tandemlake.assay import reverse_complement


def ends_of(seq: str, primer: str) -> tuple[np.ndarray, np.ndarray]:
    """For each end place in seq: the least edit distance of the primer to a part that ends there, and that part's start."""
    n, m = len(seq), len(primer)
    s = np.frombuffer(seq.encode(), np.uint8)
    cost, start = np.zeros(n + 1, np.int32), np.arange(n + 1)
    for i in range(1, m + 1):
        substitute = cost[:-1] + (s != ord(primer[i - 1]))
        drop = cost[1:] + 1
        best = np.minimum(substitute, drop)
        from_ = np.where(substitute <= drop, start[:-1], start[1:])
        new_cost, new_start = np.empty(n + 1, np.int32), np.empty(n + 1, np.int64)
        new_cost[0], new_start[0] = i, 0
        # an inserted base extends the cell on the left: a running minimum, as each costs one
        raised = np.concatenate([[i], best]) - np.arange(n + 1)
        low = np.minimum.accumulate(raised)
        at = np.maximum.accumulate(np.where(raised == low, np.arange(n + 1), 0))
        new_cost = low + np.arange(n + 1)
        new_start = np.concatenate([[0], from_])[at]
        cost, start = new_cost.astype(np.int32), new_start
    return cost, start


def _find(seq: str, left: str, right: str, rate: float) -> tuple[int, int, int] | None:
    a_cost, a_start = ends_of(seq, left)
    ok = np.flatnonzero(a_cost <= int(rate * len(left)))
    if not len(ok):
        return None
    a_end = ok[np.lexsort((ok, a_cost[ok]))[0]]
    b_cost, b_start = ends_of(seq, right)
    fits = np.flatnonzero((b_cost <= int(rate * len(right))) & (b_start >= a_end))
    if not len(fits):
        return None
    # the rightmost region of hits, and in it the best end
    region = fits[fits > fits[-1] - len(right)]
    b_end = region[np.lexsort((-region, b_cost[region]))[0]]
    return int(a_start[a_end]), int(b_end), int(a_cost[a_end] + b_cost[b_end])


def trim_read(seq: str, left: str, right: str, rate: float = 0.2) -> tuple[str, int, int] | None:
    """Strand and bounds of the part between both primers, them included; the strand of fewer edits, forward on ties."""
    forward, reverse = _find(seq, left, right, rate), _find(reverse_complement(seq), left, right, rate)
    if forward and (not reverse or forward[2] <= reverse[2]):
        return "+", forward[0], forward[1]
    return ("-", reverse[0], reverse[1]) if reverse else None
