"""Circular comparison of sequences: the best rotation by cross-correlation of base indicators, and a canonical rotation."""

from __future__ import annotations

import numpy as np

_BASES = np.frombuffer(b"ACGT", np.uint8)


def rotation_matches(a: str, b: str) -> np.ndarray:
    """For each rotation of a: how many of its first min(len(a), len(b)) bases equal those of b; N equals nothing."""
    if not a or not b:
        return np.zeros(max(len(a), 1), np.int64)
    x = np.frombuffer(a.encode(), np.uint8)
    y = np.frombuffer(b.encode(), np.uint8)[: len(x)]
    total = np.zeros(len(x))
    for base in _BASES:
        left, right = np.fft.rfft(x == base), np.fft.rfft(np.pad((y == base).astype(float), (0, len(x) - len(y))))
        total += np.fft.irfft(left * right.conj(), len(x))
    return np.rint(total).astype(np.int64)


def rotational_identity(a: str, b: str) -> float:
    """The most equal bases of any rotation of a, over the longer one's length."""
    return float(rotation_matches(a, b).max()) / max(len(a), len(b)) if a and b else 0.0


def least_rotation(s: str) -> str:
    """The first of all rotations by code point: equal for sequences that are rotations of each other, and only for these."""
    n, i, j, k = len(s), 0, 1, 0
    while i < n and j < n and k < n:
        a, b = s[(i + k) % n], s[(j + k) % n]
        if a == b:
            k += 1
            continue
        # none of the k + 1 starts that compare greater can be the least
        if a > b:
            i = i + k + 1
        else:
            j = j + k + 1
        j += i == j
        k = 0
    at = min(i, j)
    return s[at:] + s[:at]
