"""Language ID: interpolated Kneser-Ney character models, one per language.

Every learning row's whole text is counted into character 4-grams (lower-cased letters and single spaces); the lower
orders' continuation counts follow from the distinct 4-grams. The models are stored in sorted hash arrays with a
directory of leading bits, one row of log-probabilities (a column for each language) per n-gram. No n-gram is left out:
the models are cut into parts by the two symbols before the predicted one, and each part has all that its grams back
off to. A text goes to the language of the lowest cross-entropy per character. Rejection is calibrated on a fold of the
learning rows, under models of the other ones: by the score below which predictions are wrong more often than right, and
for each language by the cross-entropy that best parts the fold's texts from the same texts with their characters shuffled.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, in_chunks, ordered, partitions, running_sum, staged, table
from .kernels import mix

ORDER = 4
#: 4-grams times languages in a part of the models: what the driver gathers and sends out at once, besides the last key's.
MOST_GRAMS = 1 << 20
#: The score is the chance of the best language for a text of so many characters, or its own if it has fewer, at the whole
#: text's mean cross-entropies. A whole text's own chance is 1 for any text of some length, so it could reject nothing.
EVIDENCE = 40
BINS = 200
#: One in so many learning texts is left out of the models that rejection is calibrated with.
FOLDS = 8
#: Bins of cross-entropy to a nat, and the most nats that are told apart.
NAT, MOST_NATS = 20, 40
_EDGE, _GAP = 1, 32

_fold: np.ndarray | None = None


def _folding() -> np.ndarray:
    """Code point to symbol: lower-case letters to 16 bits, U+0000 to the edge, all else to a gap."""
    global _fold
    if _fold is None:
        t = np.full(0x110000, _GAP, np.uint16)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                k = ord(low) if len(low) == 1 else c
                t[c] = k if 64 < k < 0x10000 else (k & 0x7FFF) | 0x8000
        t[0] = _EDGE
        _fold = t
    return _fold


@dataclass
class Symbols:
    grams: np.ndarray  # the 4-gram that ends at each predicted symbol, 16 bits a symbol
    bounds: np.ndarray  # first gram of each text, and the number of grams
    letters: np.ndarray  # letters of each text


def symbols(texts: list[str | None]) -> Symbols:
    lead = "\0" * (ORDER - 1)
    parts = [lead + (t or "").replace("\0", " ") for t in texts]
    cp = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    s = _folding()[cp]
    ends = np.cumsum([len(p) for p in parts])
    keep = np.ones(len(s), bool)
    keep[1:] = ~((s[1:] == _GAP) & ((s[:-1] == _GAP) | (s[:-1] == _EDGE)))
    kept = np.concatenate([[0], np.cumsum(keep)])
    s = s[keep].astype(np.uint64)
    cuts = np.concatenate([[0], kept[ends]])
    letters = np.concatenate([[0], np.cumsum(s > 64)])
    grams = s.copy()
    for j in range(1, ORDER):
        grams[j:] |= s[:-j] << np.uint64(16 * j)
    real = s != _EDGE
    n = np.concatenate([[0], np.cumsum(real)])
    return Symbols(grams[real], n[cuts], np.diff(letters[cuts]))


@dataclass
class HashArray:
    """Keys sorted by hash, found through a directory of the hashes' leading bits."""

    hashes: np.ndarray
    rows: np.ndarray  # values, in the order of hashes
    directory: np.ndarray = field(default=None)
    shift: int = 63
    longest: int = 0

    @classmethod
    def of(cls, keys: np.ndarray, rows: np.ndarray) -> HashArray:
        h = mix(keys)
        order = np.argsort(h)
        h = h[order]
        bits = max(1, int(np.ceil(np.log2(len(h) + 1))) + 1)
        directory = np.searchsorted(h >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        return cls(h, rows[order], directory, 64 - bits, int(np.diff(directory).max(initial=0)))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where there is none."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.hashes) or not len(keys):
            return out
        h = mix(keys)
        b = (h >> np.uint64(self.shift)).astype(np.int64)
        at, end = self.directory[b], self.directory[b + 1]
        hit = self.hashes[np.minimum(at, len(self.hashes) - 1)] == h
        out[hit] = at[hit]
        todo = np.flatnonzero(~hit & (end - at > 1))
        for step in range(1, self.longest):
            if not len(todo):
                break
            k = at[todo] + step
            same = self.hashes[np.minimum(k, len(self.hashes) - 1)] == h[todo]
            out[todo[same]] = k[same]
            todo = todo[~same & (end[todo] > k + 1)]
        return out


@dataclass
class Model:
    languages: list[str]
    grams: list[HashArray]  # by order, 1 first: log-probabilities
    contexts: list[HashArray]  # by order of what follows, 2 first: log of the mass left to lower orders
    floor: float

    def log_probabilities(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """A row for each gram, a column for each language."""
        low = grams & np.uint64((1 << (16 * order)) - 1)
        at = self.grams[order - 1].find(low)
        out = self.grams[order - 1].rows[np.maximum(at, 0)]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            if order == 1:
                out[miss] = self.floor
            else:
                ctx = self.contexts[order - 2].find(low[miss] >> np.uint64(16))
                left = np.where((ctx >= 0)[:, None], self.contexts[order - 2].rows[np.maximum(ctx, 0)], 0.0)
                out[miss] = left + self.log_probabilities(grams[miss], order - 1)
        return out


def train(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model | None:
    """Models from the 4-gram counts n of each language index and gram."""
    if not len(gram):
        return None
    # counts by order: for the highest the counts, below it the number of distinct left extensions
    by_order = {ORDER: (lang, gram, n.astype(float))}
    for order in range(ORDER - 1, 0, -1):
        above_lang, above, _ = by_order[order + 1]
        suffix = above & np.uint64((1 << (16 * order)) - 1)
        pairs, counts = np.unique(np.rec.fromarrays([above_lang, suffix], names="l,g"), return_counts=True)
        by_order[order] = (pairs.l.copy(), pairs.g.copy(), counts.astype(float))
    seen = {o: np.array([((c == v)[:, None] & (l[:, None] == np.arange(len(languages)))).sum(0) for v in (1, 2)], float) for o, (l, _, c) in by_order.items()}
    return fit(languages, by_order, seen)


def fit(languages: list[str], by_order: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], seen: dict[int, np.ndarray]) -> Model:
    """Models from language index, gram and count of each order, and by order how many grams of each language have counts 1
    and 2. The grams may be a part of all, if it has all those of a history and of the lower orders that they end in."""
    k = len(languages)
    vocabulary = len(np.unique(by_order[1][1])) + 1
    grams, contexts, lower = [], [], None
    for order in range(1, ORDER + 1):
        l, g, c = by_order[order]
        union, where = np.unique(g, return_inverse=True)
        count = np.zeros((len(union), k))
        count[where, l] = c
        history = union >> np.uint64(16)
        hist, hist_at = np.unique(history, return_inverse=True)
        total, kinds = np.zeros((len(hist), k)), np.zeros((len(hist), k))
        np.add.at(total, hist_at, count)
        np.add.at(kinds, hist_at, (count > 0).astype(float))
        ones, twos = seen[order]
        discount = np.clip(np.where(ones + twos > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5), 0.05, 0.95)
        with np.errstate(divide="ignore", invalid="ignore"):
            left = np.where(total > 0, discount * kinds / total, 1.0)
            own = np.where(total[hist_at] > 0, np.maximum(count - discount, 0) / total[hist_at], 0.0)
        if order == 1:
            base = np.full((len(union), k), 1.0 / vocabulary)
        else:
            suffix = union & np.uint64((1 << (16 * (order - 1))) - 1)
            base = lower[1][np.searchsorted(lower[0], suffix)]
        p = own + left[hist_at] * base
        lower = (union, p)
        grams.append(HashArray.of(union, np.log(p).astype(np.float32)))
        if order == 1:
            floor = float(np.log(left.mean() / vocabulary))
        else:
            contexts.append(HashArray.of(hist, np.log(np.maximum(left, 1e-12)).astype(np.float32)))
    return Model(languages, grams, contexts, floor)


@dataclass
class Parts:
    """Models cut by key, each broadcast by itself: from a start to the next one."""

    starts: np.ndarray
    sent: list  # broadcast models
    languages: list[str]

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """As Model's; with several parts, one at a time is in memory."""
        if len(self.sent) == 1:
            return self.sent[0].value.log_probabilities(grams)
        half = np.uint64(0xFFFF)
        key = (grams >> np.uint64(16) & half) << np.uint64(16) | grams >> np.uint64(32) & half
        part = np.searchsorted(self.starts, key.astype(np.int64), side="right") - 1
        out = np.empty((len(grams), len(self.languages)), np.float32)
        for i, sent in enumerate(self.sent):
            mine = np.flatnonzero(part == i)
            if len(mine):
                out[mine] = sent.value.log_probabilities(grams[mine])
                if getattr(sent, "_path", None):
                    sent.__dict__.pop("_value", None)  # it can be read again from its file
        return out


def model_parts(counts: DataFrame, most_grams: int) -> Parts | None:
    """Models of the 4-gram counts (lang, gram, n). Continuation counts and discounts are taken from all grams."""
    spark = counts.sparkSession
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if not languages:
        return None
    n = partitions(counts)
    levels = {ORDER: counts.select("lang", "gram", F.col("n").cast("long").alias("n"))}
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << (16 * order)) - 1).cast("long"))
        levels[order] = levels[order + 1].groupBy("lang", suffix.alias("gram")).agg(F.count("*").alias("n"))
    both = None
    for order, level in levels.items():
        level = level.withColumn("order", F.lit(order))
        both = level if both is None else both.unionByName(level)
    symbol = lambda j: F.shiftright("gram", 16 * j).bitwiseAND(F.lit(0xFFFF).cast("long"))
    key = F.shiftleft(symbol(1), 16).bitwiseOR(symbol(2))
    grams = staged(both.withColumn("key", key).repartitionByRange(n, "key", "gram").sortWithinPartitions("key"))
    seen = {order: np.zeros((2, len(languages))) for order in levels}
    at = {v: i for i, v in enumerate(languages)}
    for r in grams.where("n <= 2").groupBy("order", "lang", "n").agg(F.count("*").alias("c")).collect():
        seen[r.order][r.n - 1, at[r.lang]] = r.c
    sizes = grams.where(F.col("order") == ORDER).select("key", "gram").distinct().groupBy("key").agg((F.count("*") * len(languages)).alias("size"))
    before = running_sum(ordered(sizes, "key"), "size", ["key"], "before")
    firsts = before.groupBy(F.floor(F.col("before") / most_grams).alias("part")).agg(F.min("key").alias("first")).collect()
    starts = [0, *sorted(r["first"] for r in firsts)[1:]]
    sent = []
    for lo, hi in zip(starts, [*starts[1:], 1 << 32], strict=True):
        level2 = (F.col("order") == 2) & F.col("key").between(lo >> 16 << 16, hi - 1)
        part = grams.where((F.col("order") == 1) | level2 | ((F.col("order") > 2) & (F.col("key") >= lo) & (F.col("key") < hi))).select("order", "lang", "gram", "n").toPandas()
        part["lang"] = part["lang"].map(at)
        by_order = {o: (p["lang"].to_numpy(np.int64), p["gram"].to_numpy(np.int64).view(np.uint64), p["n"].to_numpy(float)) for o, p in part.groupby("order")}
        sent.append(spark.sparkContext.broadcast(fit(languages, by_order, seen)))
    return Parts(np.array(starts, np.int64), sent, languages)


def best_languages(m: Parts, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Of each text whether it has letters, its best language's index, the score and the entropy; None if no text has any."""
    s = symbols(texts)
    size = np.diff(s.bounds)
    ok = s.letters > 0
    if not ok.any():
        return None
    p = m.log_probabilities(s.grams)
    total = np.add.reduceat(p, np.minimum(s.bounds[:-1], len(p) - 1), axis=0, dtype=np.float64)
    mean = total / np.maximum(size, 1)[:, None]
    best = mean.argmax(1)
    top = mean[np.arange(len(texts)), best]
    rival = np.exp((mean - top[:, None]) * np.minimum(size, EVIDENCE)[:, None]).sum(1)
    return ok, best, np.where(ok, 1 / rival, 0.0), np.where(ok, -top, np.nan)


def shuffled(text: str) -> str:
    """The text's characters in an order fixed by the text."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.random.default_rng(zlib.crc32(cp.tobytes())).permutation(cp).tobytes().decode("utf-32-le", "surrogatepass")


def entropy_limit(texts: dict[int, int], noise: dict[int, int]) -> float:
    """The entropy that parts bins of texts from bins of noise with the fewest errors; of several, the middle."""
    most = max(*texts, *noise) + 2
    good, bad = (np.bincount(list(b), weights=list(b.values()), minlength=most) for b in (texts, noise))
    wrong = good.sum() - np.concatenate([[0], np.cumsum(good)]) + np.concatenate([[0], np.cumsum(bad)])
    fewest = np.flatnonzero(wrong == wrong.min())
    return float(fewest[0] + fewest[-1]) / 2 / NAT


def calibrate(fold: DataFrame, m: Parts | None) -> tuple[float, dict[str, float]]:
    """The least score, and the most entropy by language, from labelled rows (text, lang) that m has not counted."""
    if m is None:
        return 0.0, {}

    def probe(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for noise in (False, True):
            found = best_languages(m, [shuffled(t) for t in batch["text"]] if noise else batch["text"].tolist())
            if found is None:
                return pd.DataFrame({"lang": [], "noise": [], "right": [], "score": [], "nats": []})
            ok, best, score, entropy = found
            right = np.array(m.languages, object)[best] == batch["lang"].to_numpy()
            bins = np.nan_to_num(np.floor(np.minimum(entropy, MOST_NATS) * NAT)).astype(int)
            out.append(pd.DataFrame({"lang": batch["lang"], "noise": noise, "right": right, "score": np.floor(score * BINS).astype(int), "nats": bins})[ok])
        return pd.concat(out)

    tried = fold.where(F.col("lang").isin(m.languages)).select("text", "lang").mapInPandas(in_chunks(probe, size=1 << 19), "lang string, noise boolean, right boolean, score int, nats int")
    bins = tried.groupBy("lang", "noise", "right", "score", "nats").count().collect()
    scores: dict[int, list[int]] = {}
    texts, noises = {}, {}
    for r in bins:
        if not r.noise:
            of = scores.setdefault(r.score, [0, 0])
            of[0] += r["count"]
            of[1] += r["count"] * r.right
        if r.noise or r.right:
            of = (noises if r.noise else texts).setdefault(r.lang, {})
            of[r.nats] = of.get(r.nats, 0) + r["count"]
    threshold, n, right = 0.0, 0, 0
    for b, (all_, good) in sorted(scores.items()):
        n, right = n + all_, right + good
        if 2 * right < n:
            threshold = (b + 1) / BINS
    return threshold, {lang: entropy_limit(texts[lang], noises[lang]) for lang in texts if lang in noises}


def identify_language(docs: DataFrame, *, most_grams: int = MOST_GRAMS) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, entropy (nats a character), rejected and text_hash.

    Learning rows: non-null lang, and crc32(doc_id) mod 5 not 0 (a null doc_id is held out). A null text, one without
    letters, and any text where nothing could be learned are ``und`` with score 0, and rejected. The prediction and entropy
    come from the whole text; the score is the best language's chance at these entropies for EVIDENCE characters, so that
    long and short texts have one scale. Rejected is also a text whose score is too low, or whose entropy is too high for its language: of a script or language that was not learned, or no language."""
    spark = docs.sparkSession
    rows = documents(docs, "doc_id", "text", "lang").withColumn("text_hash", F.xxhash64("text")).withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True)))

    def count(batches):
        held: dict[tuple[str, bool], list] = {}

        def fold(parts):
            g = np.concatenate([p[0] for p in parts])
            c = np.concatenate([p[1] for p in parts])
            u, at = np.unique(g, return_inverse=True)
            return [(u, np.bincount(at, weights=c).astype(np.int64))]

        def add(batch):
            for key, part in batch.groupby(["lang", "fold"], sort=False):
                g, c = np.unique(symbols(part["text"].tolist()).grams, return_counts=True)
                parts = held.setdefault(key, [])
                parts.append((g, c))
                if len(parts) > 12:
                    parts[:] = fold(parts)
            return batch.iloc[:0]

        for _ in in_chunks(add, size=1 << 21)(batches):
            pass
        for (lang, out), parts in held.items():
            (g, c), = fold(parts)
            yield pd.DataFrame({"lang": lang, "gram": g.view(np.int64), "n": c, "rest": 0 if out else c})

    learning = rows.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang", (F.pmod("text_hash", F.lit(FOLDS)) == 0).alias("fold"))
    counts = staged(learning.mapInPandas(count, "lang string, gram long, n long, rest long").groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("rest").alias("rest")))
    rest = model_parts(counts.where("rest > 0").select("lang", "gram", F.col("rest").alias("n")), most_grams)
    threshold, limits = calibrate(learning.where("fold"), rest)
    for sent in rest.sent if rest else []:
        sent.destroy()
    m = model_parts(counts, most_grams)

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "held_out": batch["held_out"], "lang": batch["lang"], "lang_pred": "und", "score": 0.0, "entropy": np.nan})
        if m is None:
            return out
        found = best_languages(m, batch["text"].tolist())
        if found is None:
            return out
        ok, best, out["score"], out["entropy"] = found
        out["lang_pred"] = np.where(ok, np.array(m.languages, object)[best], "und")
        return out

    scored = staged(rows.select("doc_id", "text_hash", "held_out", "lang", "text").mapInPandas(in_chunks(score, size=(1 << 19) * min(4, len(m.sent) if m else 1)), "doc_id long, text_hash long, held_out boolean, lang string, lang_pred string, score double, entropy double"))
    # a language without rows in the fold has the loosest limit of the others
    loosest = max(limits.values(), default=float("inf"))
    limit = F.lit(loosest)
    if limits:
        limit = F.coalesce(F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair])[F.col("lang_pred")], limit)
    return scored.select(
        "doc_id", "held_out", "lang_pred", "score", F.when(F.isnan("entropy"), None).otherwise(F.col("entropy")).alias("entropy"), ((F.col("lang_pred") == "und") | (F.col("score") < threshold) | (F.col("entropy") > limit)).alias("rejected"), "text_hash"
    )


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, without the documents whose language is rejected."""
    rows = documents(docs, "doc_id", "text", "lang", "source", "n_chars")
    out = staged(identify_language(rows).where("rejected").select(F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash")).distinct())
    return rows.join(out, F.col("doc_id").eqNullSafe(F.col("r_id")) & F.xxhash64("text").eqNullSafe(F.col("r_hash")), "left_anti")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents")).drop("text_hash")


QUERIES = {"op2_language_id": op2_language_id}
ORACLES: dict[str, str] = {}
