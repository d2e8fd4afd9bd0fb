"""One-dimensional Gaussian mixtures on weighted histograms."""

from __future__ import annotations

import math

import numpy as np


def _em(x: np.ndarray, n: np.ndarray, k: int, reg: float, start: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    total = n.sum()
    mean = start.astype(float)
    var = np.full(k, max(np.average((x - np.average(x, weights=n)) ** 2, weights=n) / k**2, 1.0))
    share = np.full(k, 1 / k)
    last = -np.inf
    for _ in range(300):
        logs = np.log(share) - 0.5 * np.log(2 * math.pi * var) - (x[:, None] - mean) ** 2 / (2 * var)
        top = logs.max(1, keepdims=True)
        norm = top[:, 0] + np.log(np.exp(logs - top).sum(1))
        resp = np.exp(logs - norm[:, None]) * n[:, None]
        weight = resp.sum(0) + 1e-12
        like = float((norm * n).sum())
        share, mean = weight / total, (resp * x[:, None]).sum(0) / weight
        var = (resp * (x[:, None] - mean) ** 2).sum(0) / weight + reg
        if like - last < 1e-7 * max(1, abs(like)):
            break
        last = like
    return like, mean, np.sqrt(var), share


def fit(x: np.ndarray, n: np.ndarray, k: int, reg: float = 1e-3) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """The likeliest of a few deterministic starts: log-likelihood, means, deviations, shares, by ascending mean."""
    x, n = x.astype(float), n.astype(float)
    order = np.argsort(x)
    x, n = x[order], n[order]
    share = (np.cumsum(n) - n / 2) / n.sum()
    starts = [np.interp((np.arange(k) + 0.5) / k, share, x), np.linspace(x[0], x[-1], k) if k > 1 else np.array([np.average(x, weights=n)])]
    # the commonest lengths, kept apart
    modes: list[float] = []
    for i in np.lexsort((x, -n)):
        if len(modes) < k and all(abs(x[i] - m) > 3 for m in modes):
            modes.append(float(x[i]))
    if len(modes) == k:
        starts.append(np.array(sorted(modes)))
    best = max((_em(x, n, k, reg, s) for s in starts), key=lambda r: r[0])
    by = np.argsort(best[1])
    return best[0], best[1][by], best[2][by], best[3][by]


def bic(like: float, k: int, n: float) -> float:
    return -2 * like + (3 * k - 1) * math.log(n)


def select(x: np.ndarray, n: np.ndarray, most: int, force: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, deviations and shares of the number of components of the lowest BIC (the smaller one on ties)."""
    best = None
    for k in [force] if force else range(1, min(most, len(x)) + 1):
        like, mean, sd, share = fit(x, n, k)
        score = bic(like, k, float(n.sum()))
        if best is None or score < best[0]:
            best = (score, mean, sd, share)
    return best[1:]
