"""Statistics of small tables, computed on the driver or in Arrow batches."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fisher_exact(a: int, b: int, c: int, d: int) -> tuple[float, float]:
    """Odds ratio and two-sided p of [[a, b], [c, d]]: the sum of all tables no likelier than the observed one."""
    lg = math.lgamma
    r1, r2, c1, n = a + b, c + d, a + c, a + b + c + d

    def log_p(x: int) -> float:
        y, z = r1 - x, c1 - x
        w = r2 - z
        return lg(r1 + 1) - lg(x + 1) - lg(y + 1) + lg(r2 + 1) - lg(z + 1) - lg(w + 1) - (lg(n + 1) - lg(c1 + 1) - lg(n - c1 + 1))

    low, high = max(0, c1 - r2), min(r1, c1)
    logs = np.array([log_p(x) for x in range(low, high + 1)])
    here = log_p(a)
    p = float(np.exp(logs[logs <= here + math.log1p(1e-7)]).sum())
    odds = math.nan if b * c == 0 and a * d == 0 else math.inf if b * c == 0 else a * d / (b * c)
    return odds, min(1.0, p)


@F.pandas_udf(T.StructType([T.StructField("odds_ratio", T.DoubleType()), T.StructField("fisher_p", T.DoubleType())]))
def fisher(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
    """fisher_exact for each row; an undefined odds ratio is null."""
    rows = [fisher_exact(*map(int, x)) for x in zip(a, b, c, d, strict=True)]
    return pd.DataFrame({"odds_ratio": [None if math.isnan(o) else o for o, _ in rows], "fisher_p": [p for _, p in rows]}).astype("float64")


def law_of_total_variance(weights: list[float], means: list[float], sds: list[float]) -> tuple[float, float]:
    """Mean and deviation of pooled groups."""
    total = sum(weights)
    mean = sum(w * m for w, m in zip(weights, means, strict=True)) / total
    return mean, math.sqrt(sum(w * (s * s + (m - mean) ** 2) for w, m, s in zip(weights, means, sds, strict=True)) / total)
