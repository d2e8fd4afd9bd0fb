"""Quality rules: gradient-boosted trees over document statistics.

Statistics of every whole text are computed in numpy batches; a boosted ensemble with monotonic constraints is fitted on
a bounded sample of labelled rows, flattened into node arrays, and applied to all rows in vectorised batches.
Null and empty texts have no words and fail the base rule. Rows are never merged: repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import documents, in_chunks, release, staged, table

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_upper", "n_digits", "n_punct", "n_lines", "n_distinct", "n_bytes"]
#: Derived features, and the sign in which the chance of good quality may move as each one grows (0: either).
FEATURES = {
    "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "digit_share": 0, "punct_per_word": 0,
    "mean_word": 0, "log_words": 0, "words_per_line": 0, "distinct_share": 0,
}
#: ASCII symbols of the base rule, and ASCII punctuation.
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b"!\"'(),-./:;?[]_`{}~"


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOL, _PUNCT = _table(SYMBOLS), _table(PUNCTUATION)
_UPPER, _DIGIT = _table(bytes(range(65, 91))), _table(bytes(range(48, 58)))


def statistics(texts: list[str | None]) -> dict[str, np.ndarray]:
    """BASE and EXTRA for each text."""
    w = K.words(texts)
    n = len(texts)
    # one line ends at each line feed; the separator after a text ends its last line
    ends = np.flatnonzero(w.a == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    inside = w.a != 10
    first = np.searchsorted(starts, w.offsets)
    doc = np.repeat(np.arange(n), np.diff(first))
    full = np.add.reduceat((~w.space).astype(np.int64), starts) > 0
    earlier = np.zeros(len(starts), bool)
    if full.any():
        earlier[full] = K.equal_earlier(doc[full], K.segment_hash(w.a, starts, inside)[full])[0]
    at, h = K.windows(w, 3)
    again = K.equal_earlier(w.doc[at], h)[1] if len(at) else np.zeros(0, bool)
    lead = (w.a & 0xC0) != 0x80
    by_byte = lambda flags: K.per_text(flags, w.offsets)
    return {
        "n_words": w.counts,
        "word_chars": by_byte(lead & ~w.space),
        "n_symbols": by_byte(_SYMBOL[w.a]),
        "n_dup_lines": K.per_text(earlier, first),
        "n_repeat_words": K.per_text(K.covered(len(w.hashes), at[again], 3), w.first),
        "n_upper": by_byte(_UPPER[w.a]),
        "n_digits": by_byte(_DIGIT[w.a]),
        "n_punct": by_byte(_PUNCT[w.a]),
        "n_lines": K.per_text(full, first),
        "n_distinct": w.counts - K.per_text(K.equal_earlier(w.doc, w.hashes)[0], w.first) if len(w.hashes) else w.counts,
        "n_bytes": np.diff(w.offsets) - 1,
    }


def features(s: pd.DataFrame) -> np.ndarray:
    words, chars = np.maximum(s["n_words"].to_numpy(float), 1), np.maximum(s["word_chars"].to_numpy(float), 1)
    lines = np.maximum(s["n_lines"].to_numpy(float), 1)
    cols = {
        "symbols_per_word": s["n_symbols"] / words, "dup_line_share": s["n_dup_lines"] / lines, "repeat_share": s["n_repeat_words"] / words, "upper_share": s["n_upper"] / chars,
        "digit_share": s["n_digits"] / chars, "punct_per_word": s["n_punct"] / words, "mean_word": s["word_chars"] / words, "log_words": np.log1p(s["n_words"].to_numpy(float)),
        "words_per_line": s["n_words"] / lines, "distinct_share": s["n_distinct"] / words,
    }
    return np.column_stack([np.asarray(cols[name], float) for name in FEATURES])


@dataclass
class Ensemble:
    """All trees' nodes in flat arrays; a leaf points at itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                down = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(down, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 64, l2: float = 1.0, least: float = 5.0) -> Ensemble:
    """Logistic boosting on binned features; a split against a feature's sign is refused, and both children are held
    on their side of the mid value, so the ensemble is monotone in every signed feature."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.column_stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(m)])
    rate_y = min(max(y.mean(), 1e-4), 1 - 1e-4)
    bias = float(np.log(rate_y / (1 - rate_y)))
    margin = np.full(n, bias)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        k = len(feature)
        feature.append(0), threshold.append(np.inf), left.append(k), right.append(k), value.append(v)
        return k

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        roots.append(leaf(0.0))
        level = [(roots[-1], np.arange(n), -np.inf, np.inf)]
        for d in range(depth + 1):
            following = []
            for node, rows, low, high in level:
                sg, sh = g[rows].sum(), h[rows].sum()
                value[node] = rate * float(np.clip(-sg / (sh + l2), low, high))
                best = (1e-6, None)
                if d == depth or len(rows) < 2 * least:
                    margin[rows] += value[node]
                    continue
                for j in range(m):
                    size = len(edges[j]) + 1
                    if size < 2:
                        continue
                    b = binned[rows, j]
                    cg, ch, cn = (np.cumsum(np.bincount(b, weights=v, minlength=size))[:-1] for v in (g[rows], h[rows], np.ones(len(rows))))
                    lv, rv = np.clip(-cg / (ch + l2), low, high), np.clip(-(sg - cg) / (sh - ch + l2), low, high)
                    gain = cg**2 / (ch + l2) + (sg - cg) ** 2 / (sh - ch + l2) - sg**2 / (sh + l2)
                    ok = (cn >= least) & (len(rows) - cn >= least) & ((rv - lv) * signs[j] >= 0)
                    if ok.any() and (k := int(np.argmax(np.where(ok, gain, -np.inf)))) >= 0 and gain[k] > best[0]:
                        best = (gain[k], (j, k, lv[k], rv[k]))
                if best[1] is None:
                    margin[rows] += value[node]
                    continue
                j, k, lv, rv = best[1]
                mid = (lv + rv) / 2
                bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high), (low, high))}[signs[j]]
                feature[node], threshold[node] = j, float(edges[j][k])
                left[node], right[node] = leaf(0.0), leaf(0.0)
                down = binned[rows, j] <= k
                following += [(left[node], rows[down], *bounds[0]), (right[node], rows[~down], *bounds[1])]
            level = following
    return Ensemble(*(np.array(v) for v in (feature, threshold, left, right, value, roots)), depth, bias)


def quality_rules(docs: DataFrame, labels: DataFrame | None, *, sample_rows: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """Per document: doc_id, the base statistics, base_failed, probability (of good quality; null without a model) and kept.

    ``labels`` has doc_id and quality (0 or 1); rows with nulls in either are left out. The ensemble is fitted on the
    ``sample_rows`` labelled documents that come first by a hash of doc_id and statistics: a bound on the driver's data, the same at
    every input size. Without labels of both kinds there is no model and all that pass the base are kept.
    """
    columns = BASE + EXTRA

    def measure(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": batch["doc_id"]} | statistics(batch["text"].tolist()))[["doc_id", *columns]]

    stats = staged(documents(docs, "doc_id", "text").mapInPandas(in_chunks(measure), "doc_id long, " + ", ".join(f"{c} long" for c in columns)))
    model = None
    if labels is not None:
        known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
        # rows repeated whole count once; few more than sample_rows lie below the cut, and only they leave their tasks
        seen = staged(stats.join(known, "doc_id").distinct().withColumn("hash", F.xxhash64("doc_id", *columns)))
        n = seen.count()
        share = (sample_rows + 6 * sample_rows**0.5) / n if n > sample_rows else 1.0
        below = F.col("hash") <= F.lit(min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)))
        rows = seen.where(below).toPandas().sort_values(["hash", "doc_id", *columns]).head(sample_rows)
        release(seen)
        if rows["quality"].nunique() == 2:
            model = fit(features(rows), rows["quality"].to_numpy(float), list(FEATURES.values()))

    def judge(batches):
        for batch in batches:
            p = model.probability(features(batch)) if model else np.full(len(batch), np.nan)
            failed = (batch["n_words"] < 50) | (100 * batch["n_repeat_words"] > 50 * batch["n_words"])
            out = batch[["doc_id", *BASE]].copy()
            out["base_failed"] = failed
            out["probability"] = pd.Series(p).where(~np.isnan(p), None).astype(object)
            out["kept"] = ~failed & ((p >= threshold) | np.isnan(p))
            yield out

    return stats.mapInPandas(judge, "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, probability double, kept boolean")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op1_quality_rules": op1_quality_rules}
ORACLES: dict[str, str] = {}
