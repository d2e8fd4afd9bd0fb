"""Mixture-controlled packing: deficit round robin over source queues.

Each source is a queue of its documents' tokens in doc_id order. A round is a window of one packed sequence; in each, every
queue is credited its quantum, the window's tokens times the source's target share, and sends what it has credit for,
cutting documents freely. A queue whose quantum is below a grain saves its credit until it has one, so that small sources
send pieces worth reading; what is left of a credit carries into the next round. The j-th piece of a queue, of a quantum
or a grain, therefore leaves in round floor(j * piece / quantum), and where each piece stands follows from ordered sums
over the whole corpus: no window or partition boundary resets a deficit. An empty queue sends no more and the others go
on in their proportions. The pieces, in the order of rounds and queues, fill sequences without gaps; one is cut where a
sequence ends, and the corpus's last, unfilled sequence is cut into powers of two.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import encoding
from .common import documents, in_chunks, ordered, release, running_sum, staged, table
from .mixing import WEIGHTS, source_weights

LENGTH = 1024
#: Tokens that a queue sends at least, but for its documents' last ones.
GRAIN = 128
END_ID = 0


def tail_starts(total: int, length: int = LENGTH) -> list[int]:
    """Where sequences begin after the last full one: at powers of two, so that none needs padding."""
    at, out, left = total // length * length, [], total % length
    while left:
        out.append(at)
        size = 1 << (left.bit_length() - 1)
        at, left = at + size, left - size
    return out


def pack_documents(docs: DataFrame, *, weights: tuple[float, ...] | None = None, shares: dict[str, float] | None = None, vocabulary: str = "byte_bpe_50k.json", end_id: int = END_ID, length: int = LENGTH, window: int = 1, grain: int = GRAIN, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source and, if with_ids,
    ids (binary).

    A null text is empty: its document is the end id alone. Null sources are a queue of their own, repeated rows are
    documents of their own; those of one source and doc_id, null ones too, follow in the order of a digest of their texts, so
    that reruns agree however rows lie. Target token proportions: shares, where sources that it leaves out or gives 0 come in the mean
    share of the others; or weights, taken in turn by the sources' code points, null last; or, with neither, each source's
    share of all tokens, which drains all queues together. window: sequences in a round."""

    def encode(batch: pd.DataFrame) -> pd.DataFrame:
        end = end_id.to_bytes(2, "little")
        ids = [e + end for e in encoding.encode_bytes(batch["text"].tolist(), vocabulary)]
        return pd.DataFrame({"doc_id": batch["doc_id"], "source": batch["source"], "key": batch["key"], "doc_tokens": [len(i) // 2 for i in ids], "ids": ids})

    rows = documents(docs, "doc_id", "text", "source").withColumn("key", F.sha2(F.coalesce("text", F.lit("")), 256))
    coded = rows.mapInPandas(in_chunks(encode, size=1 << 21), "doc_id long, source string, key string, doc_tokens long, ids binary")
    tokens = staged(coded.withColumn("uid", F.monotonically_increasing_id()))
    queue = ["source", "doc_id", "key", "uid"]
    queued_rows = ordered(tokens.select(*queue, "doc_tokens"), *queue)
    queued = running_sum(queued_rows, "doc_tokens", queue, "sent", group="source")
    queues = source_weights(tokens, weights or (1.0,))
    if shares:
        given = {k: v for k, v in shares.items() if v > 0}
        mean = sum(given.values()) / len(given) if given else 1.0
        queues = queues.withColumn("weight", F.coalesce(F.create_map(*[F.lit(x) for kv in given.items() for x in kv])[F.col("source")], F.lit(mean)) if given else F.lit(1.0))
    elif not weights:
        sums = tokens.groupBy("source").agg(F.sum("doc_tokens").cast("double").alias("own"))
        queues = queues.alias("a").join(sums.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.source", "a.place", F.col("b.own").alias("weight"))
    queues = staged(queues)
    every = queues.agg(F.sum("weight")).first()[0] or 1.0
    quantum = F.col("weight") / F.lit(every) * F.lit(float(window * length))
    queues = queues.select("source", F.col("place").alias("queue"), quantum.alias("quantum"), F.greatest(quantum, F.lit(float(grain))).alias("piece"))
    turn = queued.alias("q").join(queues.alias("s"), F.col("q.source").eqNullSafe(F.col("s.source"))).select("q.uid", "q.sent", "q.doc_tokens", "s.queue", "s.quantum", "s.piece")
    # the pieces that hold tokens of a document: from its first token's to its last one's
    nth = F.sequence(F.floor(F.col("sent") / F.col("piece")), F.floor((F.col("sent") + F.col("doc_tokens") - 1) / F.col("piece")))
    low = F.greatest("sent", F.ceil(F.col("nth") * F.col("piece")).cast("long"))
    high = F.least(F.col("sent") + F.col("doc_tokens"), F.ceil((F.col("nth") + 1) * F.col("piece")).cast("long"))
    sent = turn.withColumn("nth", F.explode(nth)).select("uid", "queue", F.floor(F.col("nth") * F.col("piece") / F.col("quantum") + 1e-9).cast("long").alias("round"), low.alias("low"), (high - low).alias("n"), (low - F.col("sent")).alias("start")).where("n > 0")
    streamed = ordered(sent, "round", "queue", "low")
    total = tokens.agg(F.sum("doc_tokens")).first()[0] or 0
    placed = running_sum(streamed, "n", ["round", "queue", "low"], "place").groupBy("uid").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("sizes"), F.collect_list("place").alias("places"))
    tail = np.array(tail_starts(total, length), np.int64)
    full = total // length * length
    release(queued_rows)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"] + ["ids"] * with_ids

    def cut(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for doc_id, source, n, ids, *sent in zip(*(batch[c] for c in ("doc_id", "source", "doc_tokens", "ids", "starts", "sizes", "places")), strict=True):
            wide = np.frombuffer(ids, np.uint16).astype("<u4").tobytes()
            starts, sizes, places = (np.asarray(x) for x in sent)
            order = np.argsort(starts)
            starts, sizes, places = starts[order], sizes[order], places[order]
            # pieces that follow one another in the stream as well are one
            heads = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1] + sizes[:-1]]))
            for start, size, place in zip(starts[heads].tolist(), np.add.reduceat(sizes, heads).tolist(), places[heads].tolist(), strict=True):
                end = place + size
                marks = [place, *range((place // length + 1) * length, min(end, full + 1), length), *(tail[(tail > max(place, full)) & (tail < end)].tolist() if end > full else ()), end]
                for a, b in zip(marks[:-1], marks[1:], strict=True):
                    if a < full:
                        seq, offset = divmod(a, length)
                    else:
                        k = int(np.searchsorted(tail, a, side="right")) - 1
                        seq, offset = full // length + k, a - int(tail[k])
                    at = start + a - place
                    part = wide[4 * at : 4 * (at + b - a)]
                    rows.append((doc_id, at, b - a, zlib.crc32(part), n, seq, offset, source, *([part] * with_ids)))
        return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    both = tokens.join(placed.hint("shuffle_hash"), "uid").select("doc_id", "source", "doc_tokens", "ids", "starts", "sizes", "places")
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string" + ", ids binary" * with_ids
    return both.mapInPandas(in_chunks(cut, "ids"), kinds)


def op5_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), weights=WEIGHTS, with_ids=False)


QUERIES = {"op5_mixture_packing": op5_mixture_packing}
ORACLES: dict[str, str] = {}
