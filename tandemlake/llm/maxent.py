"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

Words are put into classes by their training count: the most frequent ones, those of at least N / 2**HEAD tokens, into
classes of WIDTH words each; the others, by octaves of frequency, down to N / 2**KNOWN; and all rarer ones, with every
word that was never seen, into one class. A token's probability is that of its class given the tokens before it times
that of the word in its class. Both are softmaxes over weights that hashed features of the history choose: n-grams (the
token before, the two before) and skips (the second and third one before). Within an octave or the rare class a word has
its share of the class's counts. Every threshold is a share of all tokens, so nothing depends on the size of the corpus,
and the words that a threshold lets in are bounded in number: what is broadcast has at most 2**KNOWN words.

Weights are trained by gradient: training documents are dealt to ROUNDS folds; in a round, tasks sum the model's expected
and the observed feature counts of one fold's documents, Spark adds these up, and the driver steps along the gradient,
each weight scaled by its curvature. Texts are scored in sparse batches: a batch gathers the rows of weights that its
features hash to.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, in_chunks, staged, table
from .kernels import Words, mix, segment_hash, stream, words_of

#: Held out are documents whose crc32 of doc_id leaves this remainder.
FOLDS, HELD_OUT = 7, 2
#: Negative binary logarithms of the least share of a word in a head class, and of a word that the broadcast table knows.
HEAD, KNOWN = 12, 20
#: Words of a head class.
WIDTH = 32
#: Binary logarithms of the rows of weights for classes and for words.
CLASS_BITS, WORD_BITS = 13, 15
ROUNDS = 8
#: What a feature's expected count is raised by in a step (a prior), and the most that a weight moves in a round.
PRIOR, MOST_STEP = 2.0, 1.0
#: Share of the Newton step; the features of a token overlap.
RATE = 0.35
#: History features: which of the tokens before (1 is the last one) are hashed together, for classes and for words.
CLASS_FEATURES = ((1,), (1, 2), (2,), (3,))
WORD_FEATURES = ((1,), (2,))
#: Tokens of a batch.
BATCH = 1 << 14
#: The end token; a word has no line feed.
END = "\n"


@dataclass
class Vocabulary:
    """Known words by rank (the most frequent first, ties by code point), with their hashes and what the totals say."""

    hashes: np.ndarray
    counts: np.ndarray
    end: int  # the end token's rank, -1 if it is rare
    total: int  # N
    distinct: int  # V
    head_bits: int = HEAD
    known_bits: int = KNOWN
    order: np.ndarray = field(init=False)
    sorted: np.ndarray = field(init=False)
    classes: np.ndarray = field(init=False)
    heads: int = field(init=False)
    inside: np.ndarray = field(init=False)
    prior: np.ndarray = field(init=False)
    start: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.order = np.argsort(self.hashes)
        self.sorted = self.hashes[self.order]
        n = len(self.counts)
        head = int((self.counts * (1 << self.head_bits) >= self.total).sum())
        self.heads = max(1, -(-head // WIDTH))
        octave = np.floor(np.log2(np.maximum(self.total / np.maximum(self.counts, 1), 1))).astype(np.int64)
        self.classes = np.where(np.arange(n) < head, np.arange(n) // WIDTH, self.heads + np.clip(octave - self.head_bits, 0, self.known_bits - self.head_bits - 1)).astype(np.int64)
        sums = np.bincount(self.classes, weights=self.counts, minlength=self.n_classes)
        sums[-1] = self.rare_tokens
        # log10 of a word's share of its class; a head word's depends on the history
        self.inside = np.where(np.arange(n) < head, 0.0, np.log10(np.maximum(self.counts, 1) / np.maximum(sums[self.classes], 1)))
        self.prior = np.log((sums + 1) / (self.total + len(sums))).astype(np.float32)
        self.prior[:-1][sums[:-1] == 0] = -1e9  # a class without words has no chance; the rare one has the unseen words
        self.start = np.full((self.heads, WIDTH), -1e9, np.float32)
        ranks = np.arange(head)
        self.start[ranks // WIDTH, ranks % WIDTH] = np.log(self.counts[:head] / sums[ranks // WIDTH])

    @property
    def n_classes(self) -> int:
        return self.heads + self.known_bits - self.head_bits + 1

    @property
    def rare_tokens(self) -> int:
        return self.total - int(self.counts.sum())

    def rank(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each hash, -1 for a rare word."""
        if not len(self.sorted):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], -1)


@dataclass
class Weights:
    """Rows of weights: one column for each class, and one for each word of a class."""

    classes: np.ndarray
    words: np.ndarray

    @classmethod
    def none(cls, v: Vocabulary, class_bits: int = CLASS_BITS, word_bits: int = WORD_BITS) -> Weights:
        return cls(np.zeros((1 << class_bits, v.n_classes), np.float32), np.zeros((1 << word_bits, WIDTH), np.float32))

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        return self.classes, self.words


def lowered_words(texts: list[str | None]) -> Words:
    """The words of the texts with A-Z in lower case."""
    return words_of([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts])


_END_HASH = segment_hash(np.frombuffer(END.encode(), np.uint8), np.zeros(1, np.int64), np.ones(1, bool))[0]
_FACTORS = stream(8, 1301) | np.uint64(1)


def history_rows(keys: np.ndarray, place: np.ndarray, features: tuple[tuple[int, ...], ...]) -> list[np.ndarray]:
    """A 64-bit number for each token and feature, from the keys of the tokens before it; place: how many its text has of
    these, at least up to the longest feature."""
    back = {}
    for j in {j for f in features for j in f}:
        before = np.zeros(len(keys), np.uint64)
        before[j:] = keys[: max(0, len(keys) - j)]
        before[place < j] = 0
        back[j] = before
    out = []
    with np.errstate(over="ignore"):
        for i, f in enumerate(features):
            h = np.full(len(keys), _FACTORS[7] * np.uint64(i + 1), np.uint64)
            for j in f:
                h += (back[j] + np.uint64(1)) * _FACTORS[j]
            out.append(mix(h))
    return out


@dataclass
class Batch:
    """Tokens with the rows of weights that their features hash to."""

    klass: np.ndarray
    class_rows: list[np.ndarray]
    heads: np.ndarray  # places of the tokens in head classes
    column: np.ndarray  # their words' columns
    word_rows: list[np.ndarray]


_REACH = max(j for f in CLASS_FEATURES + WORD_FEATURES for j in f)


def batches(v: Vocabulary, w: Weights, ids: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, Batch]]:
    """First token and Batch of each stretch of the tokens ids (ranks, negative for rare words), whose texts begin at starts."""
    class_bits, word_bits = (len(t).bit_length() - 1 for t in w.tables())
    for a in range(0, len(ids), BATCH):
        b, lead = min(a + BATCH, len(ids)), min(a, _REACH)
        part = ids[a - lead : b]
        at = np.arange(a - lead, b)
        place = at - starts[np.searchsorted(starts, at, side="right") - 1]
        known = part >= 0
        keys = (-1 - part.astype(np.int64)).astype(np.uint64)
        keys[known] = v.hashes[part[known]]
        klass = np.full(len(part), v.n_classes - 1)
        klass[known] = v.classes[part[known]]
        of_class, of_word = ([h[lead:] for h in history_rows(keys, place, f)] for f in (CLASS_FEATURES, WORD_FEATURES))
        part, klass = part[lead:], klass[lead:]
        heads = np.flatnonzero(klass < v.heads)
        with np.errstate(over="ignore"):
            salt = (klass[heads].astype(np.uint64) + np.uint64(1)) * _FACTORS[6]
        class_rows = [(h >> np.uint64(64 - class_bits)).astype(np.uint32) for h in of_class]
        word_rows = [(mix(h[heads] ^ salt) >> np.uint64(64 - word_bits)).astype(np.uint32) for h in of_word]
        yield a, Batch(klass, class_rows, heads, part[heads] % WIDTH, word_rows)


def softmax(start: np.ndarray, weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Chances, a row for each token. Weights are bounded, so the exponentials need no shift."""
    logits = weights.take(rows[0], axis=0)
    for r in rows[1:]:
        logits += weights.take(r, axis=0)
    logits += start
    np.exp(logits, out=logits)
    logits *= (1 / logits.sum(1))[:, None]
    return logits


def chances(v: Vocabulary, w: Weights, b: Batch) -> tuple[np.ndarray, np.ndarray]:
    return softmax(v.prior, w.classes, b.class_rows), softmax(v.start[b.klass[b.heads]], w.words, b.word_rows)


def log10_chances(v: Vocabulary, w: Weights, b: Batch) -> np.ndarray:
    """Of each token, but for a word's share of its octave or of the rare class."""
    p, q = chances(v, w, b)
    out = np.log10(p[np.arange(len(p)), b.klass].astype(np.float64))
    out[b.heads] += np.log10(q[np.arange(len(q)), b.column].astype(np.float64))
    return out


class Gradient:
    """Expected and observed counts by row and column, for classes and for words."""

    def __init__(self, w: Weights) -> None:
        self.expected = [np.zeros(t.T.shape) for t in w.tables()]
        self.observed = [np.zeros(t.shape, np.int64) for t in w.tables()]

    def add(self, v: Vocabulary, w: Weights, b: Batch) -> None:
        for kind, (p, rows, target) in enumerate(zip(chances(v, w, b), (b.class_rows, b.word_rows), (b.klass, b.column), strict=True)):
            expected, observed = self.expected[kind], self.observed[kind]
            columns = np.ascontiguousarray(p.T)
            for r in rows:
                for c in range(len(columns)):
                    expected[c] += np.bincount(r, weights=columns[c], minlength=expected.shape[1])
                observed += np.bincount(r.astype(np.int64) * observed.shape[1] + target, minlength=observed.size).reshape(observed.shape)

    def blocks(self) -> pd.DataFrame:
        """Sums in blocks of rows: kind, what (0 expected, 1 observed), block and values."""
        parts = []
        for kind in (0, 1):
            for what, sums in ((0, self.expected[kind].T), (1, self.observed[kind])):
                parts += [(kind, what, i, rows.astype(np.float32).tobytes()) for i, rows in enumerate(np.split(sums, BLOCKS)) if rows.any()]
        return pd.DataFrame(parts, columns=["kind", "what", "block", "values"])


#: Parts of a table of weights that tasks add up by themselves.
BLOCKS = 16
_BLOCK = "kind int, what int, block int, values binary"


def gradient(rows: DataFrame, v: Vocabulary, w: Weights) -> list[tuple[int, int, int, np.ndarray]]:
    """Expected and observed counts over the documents rows (ids): a block for each range of weights. Tasks add up as their
    rows come, so what one holds is bounded by the weights, however many documents or tasks there are."""
    sent = rows.sparkSession.sparkContext.broadcast((v, w))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary, weights = sent.value
        total = Gradient(weights)
        for frame in frames:
            ids, starts = joined(frame["ids"])
            for _, batch in batches(vocabulary, weights, ids, starts):
                total.add(vocabulary, weights, batch)
        yield total.blocks()

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for frame in frames:
            for kind, what, block, values in frame.itertuples(index=False):
                x = np.frombuffer(values, np.float32)
                sums[kind, what, block] = sums[kind, what, block] + x if (kind, what, block) in sums else x.astype(np.float64)
        yield pd.DataFrame([(*k, x.astype(np.float32).tobytes()) for k, x in sums.items()], columns=["kind", "what", "block", "values"])

    parts = rows.select("ids").mapInPandas(count, _BLOCK)
    # many tasks' sums meet in two steps
    for width in (BLOCKS, 1):
        parts = parts.withColumn("turn", F.spark_partition_id() % width).repartition(BLOCKS, "kind", "what", "block", "turn").drop("turn").mapInPandas(add, _BLOCK)
    found = [(r.kind, r.what, r.block, np.frombuffer(r["values"], np.float32)) for r in parts.collect()]  # of the size of the weights
    sent.destroy()
    return found


def joined(ids: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all documents, and where each begins."""
    parts = [np.frombuffer(x, np.int32) for x in ids]
    return np.concatenate([*parts, np.zeros(0, np.int32)]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)[:-1]


def step(w: Weights, found: list[tuple[int, int, int, np.ndarray]]) -> Weights:
    """One step along the gradient, observed minus expected counts, each weight scaled by its expected count."""
    tables = []
    for kind, t in enumerate(w.tables()):
        counts = np.zeros((2, BLOCKS, len(t) // BLOCKS, t.shape[1]))
        for k, what, block, values in found:
            if k == kind:
                counts[what, block] = values.reshape(counts.shape[2:])
        expected, observed = counts.reshape(2, *t.shape)
        tables.append((t + np.clip(RATE * (observed - expected) / (expected + PRIOR), -MOST_STEP, MOST_STEP)).astype(np.float32))
    return Weights(*tables)


def word_counts(rows: DataFrame) -> DataFrame:
    """word (UTF-8) and n over the texts of rows, ends included; n is how often a word comes."""

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        w = lowered_words(batch["text"].tolist())
        _, at, n = np.unique(w.hashes, return_index=True, return_counts=True)
        words = [w.buf[a:b] for a, b in zip(w.starts[at].tolist(), w.ends[at].tolist(), strict=True)]
        return pd.DataFrame({"word": [*words, END.encode()], "n": [*n.tolist(), len(batch)]})

    return rows.select("text").mapInPandas(in_chunks(count, size=1 << 22), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, head_bits: int = HEAD, known_bits: int = KNOWN) -> Vocabulary:
    """From word_counts: the known words, at most 2**known_bits of them."""
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    known = counts.where(F.shiftleft("n", known_bits) >= totals.n).toPandas()
    known = known.iloc[sorted(range(len(known)), key=lambda i: (-known["n"].iat[i], bytes(known["word"].iat[i])))]
    words = [bytes(x) for x in known["word"]]
    end = words.index(END.encode()) if END.encode() in words else -1
    text = words_of([b" ".join(b"x" if i == end else x for i, x in enumerate(words))])
    hashes = text.hashes.copy()
    if end >= 0:
        hashes[end] = _END_HASH
    return Vocabulary(hashes, known["n"].to_numpy(np.int64), end, int(totals.n), int(totals.v), head_bits, known_bits)


def encoded(rows: DataFrame, v: Vocabulary) -> DataFrame:
    """rows (doc_id, held_out, fold, text) as tokens: uid, doc_id, held_out, fold, n_tokens, n_known, base and inside (both of the
    known words), ids, and rare_words with rare_n, which a table of all counts has to tell more of."""
    sent = rows.sparkSession.sparkContext.broadcast(v)

    def encode(batch: pd.DataFrame) -> pd.DataFrame:
        v = sent.value
        w = lowered_words(batch["text"].tolist())
        starts = w.first[:-1] + np.arange(len(batch))
        ends = w.first[1:] + np.arange(len(batch))
        hashes = np.insert(w.hashes, w.first[1:], _END_HASH)
        ranks = v.rank(hashes)
        known = ranks >= 0
        ids = np.where(known, ranks, -1 - (hashes >> np.uint64(33)).astype(np.int64)).astype(np.int32)
        base = np.zeros(len(ids))
        base[known] = np.log10((v.counts[ranks[known]] + 1) / (v.total + v.distinct + 1))
        inside = np.zeros(len(ids))
        inside[known] = v.inside[ranks[known]]
        sizes = ends - starts + 1
        doc = np.repeat(np.arange(len(batch)), sizes)
        # rare words once for each text
        at = np.flatnonzero(~known)
        by = at[np.lexsort((hashes[at], doc[at]))]
        new = np.ones(len(by), bool)
        new[1:] = (hashes[by][1:] != hashes[by][:-1]) | (doc[by][1:] != doc[by][:-1])
        heads = np.flatnonzero(new)
        times = np.diff(heads, append=len(by)).astype(np.int32)
        first = by[heads]
        word = first - doc[first]  # the ends before it aren't words
        blobs = [END.encode() if i == ends[d] else w.buf[w.starts[j] : w.ends[j]] for i, d, j in zip(first.tolist(), doc[first].tolist(), word.tolist(), strict=True)]
        cuts = np.searchsorted(doc[first], np.arange(len(batch) + 1)).tolist()
        raw = ids.tobytes()
        return pd.DataFrame({
            "uid": batch["uid"], "doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "fold": batch["fold"], "n_tokens": sizes, "n_known": np.add.reduceat(known, starts, dtype=np.int64),
            "base": np.add.reduceat(base, starts), "inside": np.add.reduceat(inside, starts), "ids": [raw[4 * a : 4 * b + 4] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)],
            "rare_words": [blobs[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], "rare_n": [times[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
        })

    made = "uid long, doc_id long, held_out boolean, fold int, n_tokens long, n_known long, base double, inside double, ids binary, rare_words array<binary>, rare_n array<int>"
    return rows.withColumn("uid", F.monotonically_increasing_id()).mapInPandas(in_chunks(encode, size=1 << 22), made)


def is_held_out(doc_id: Column) -> Column:
    """A null doc_id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(True))


def train(docs: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> Weights:
    """docs: fold and ids. Round k takes the documents of fold k."""
    w = Weights.none(v)
    for k in range(rounds):
        w = step(w, gradient(docs.where(F.col("fold") == k), v, w))
    return w


def score_texts(docs: DataFrame, *, rounds: int = ROUNDS, head_bits: int = HEAD, known_bits: int = KNOWN) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens (all with the end token), base_score and score, log10 of
    the whole text's probability by the smoothed unigram and by the model.

    Learning rows are those that aren't held out (is_held_out). A null or empty text is its end token alone. Repeated rows
    are documents of their own and are learned as often. With nothing to learn from, every word is a rare one. Words stand
    for themselves in the counts; 64-bit hashes stand for them in features and in the table of known words. Further columns
    are left aside."""
    rows = documents(docs, "doc_id", "text").withColumn("held_out", is_held_out(F.col("doc_id")))
    rows = rows.withColumn("fold", F.when(F.col("held_out"), -1).otherwise(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds))).cast("int"))
    counts = staged(word_counts(rows.where(~F.col("held_out"))))
    v = vocabulary(counts, head_bits, known_bits)
    coded = staged(encoded(rows, v), by="fold")
    w = train(coded, v, rounds)
    sent = docs.sparkSession.sparkContext.broadcast((v, w))

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        v, w = sent.value
        ids, starts = joined(batch["ids"])
        logs = np.zeros(len(ids))
        for a, b in batches(v, w, ids, starts):
            logs[a : a + len(b.klass)] = log10_chances(v, w, b)
        return batch.drop(columns="ids").assign(doc_id=batch["doc_id"].astype("Int64"), model=np.add.reduceat(logs, starts) if len(starts) else 0.0)

    known = ("uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "inside")
    scored = coded.select(*known, "ids").mapInPandas(in_chunks(score, "ids", 1 << 22), "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inside double, model double")
    rare_types = v.distinct - len(v.counts)
    rare = coded.select("uid", F.explode(F.arrays_zip("rare_words", "rare_n")).alias("r")).select("uid", F.col("r.rare_words").alias("word"), F.col("r.rare_n").alias("times"))
    c = F.coalesce("n", F.lit(0))
    log = lambda denominator: F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(denominator))))
    looked_up = rare.join(counts, "word", "left").groupBy("uid").agg(log(v.total + v.distinct + 1).alias("r_base"), log(v.rare_tokens + rare_types + 1).alias("r_inside"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("r_known"))
    both = scored.join(looked_up, "uid", "left").fillna(0, ["r_base", "r_inside", "r_known"])
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("r_known")).alias("n_known"), F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("r_base")).alias("base_score"), (F.col("model") + F.col("inside") + F.col("r_inside")).alias("score"),
    )


def op13_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


QUERIES = {"op13_maxent_scores": op13_maxent_scores}
ORACLES: dict[str, str] = {}
