"""Substring dedup by prefix-partitioned suffix trees over words.

A suffix begins at each word that 20 words follow. Its anchors are the least six-word windows of its first 20 words by a
hash; the prefix that names its group runs from the suffix's start to the end of its first anchor, and suffixes whose
prefixes end in one anchor go together, so that neighbours share the words that are shipped. Suffixes with the same first
20 words have the same anchors and so the same prefix; anchors that occur once are left out before any words move.

A group's suffixes are sorted by their words, which gives suffix order, common-prefix lengths and so the subtree's
internal nodes. A node at least 20 words deep is a repeat, as long as it is deep; all its leaves but the earliest are
removed. Words are compared as bytes, never by a hash alone.

A group too large for memory is dealt to parts. A part's subtree decides all leaves but each node's earliest; the
earliest ones go on with a longer prefix, to the end of their next anchor. So equal suffixes melt by the size of a part in
each round, different ones are told apart by longer prefixes, and rounds go on until every group fits.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import documents, in_chunks, partitions, release, staged, table

LENGTH = 20
ANCHOR = 6
#: Rows (runs of neighbouring suffixes with one anchor) in a group, or in a part of a larger one.
GROUP = 2048
#: An anchor with more than this part of all rows is hot: there are at most so many of them, and they are broadcast.
HOT = 4096

_U = np.uint64
_MOST = np.iinfo(np.uint64).max


def least_anchors(w: K.Words, length: int = LENGTH, k: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of each window of ``length`` words, the place of its anchor (the leftmost k-word window of the least hash
    in it), and the hashes of all k-word windows by their first word."""
    n = len(w.hashes)
    h = np.full(n, _MOST, np.uint64)
    at, hashes = K.windows(w, k)
    h[at] = hashes
    starts = np.flatnonzero(w.doc[: max(0, n - length + 1)] == w.doc[length - 1 :]) if n >= length else np.zeros(0, np.int64)
    span = length - k + 1
    place, size = np.arange(n), 1
    while size < span:
        step = min(size, span - size)
        other = place[step:]
        mine = place[: n - step]
        place = np.where(h[other] < h[mine], other, mine)
        n, size = n - step, size + step
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), h
    return starts, place[starts], h


def longer_prefixes(w: K.Words, starts: np.ndarray, anchors: int, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes that begin at these words: a name of the prefix to the last of their ``anchors`` least anchors, and the
    place of the first one. Neighbours with the same anchors have the same name."""
    h = np.full(len(w.hashes), _MOST, np.uint64)
    at, hashes = K.windows(w, k)
    h[at] = hashes
    grid = h[starts[:, None] + np.arange(length - k + 1)]
    least = np.sort(np.argsort(grid, axis=1, kind="stable")[:, :anchors], axis=1)
    name = np.full(len(starts), anchors, np.uint64)
    rows = np.arange(len(starts))
    with np.errstate(over="ignore"):
        for j in range(least.shape[1]):
            name = K.mix(name * _U(0x9E3779B97F4A7C15) + grid[rows, least[:, j]] + (least[:, j] - least[:, 0]).astype(np.uint64))
    return name, starts + least[:, 0]


def deep_nodes(words: np.ndarray, first: np.ndarray, sizes: np.ndarray, group: np.ndarray, order_by: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The subtrees of suffixes ``words[first : first + sizes]`` of each group: for each suffix the deepest node's depth that
    it shares with its equals in the first ``length`` words (its own size if there are none), whether an earlier leaf of
    that node exists by ``order_by``, and whether it is the node's earliest."""
    wide = int(sizes.max())
    place = np.arange(wide)
    grid = words[np.minimum(first[:, None] + place, len(words) - 1)].astype(np.int32) + 1
    grid[place >= sizes[:, None]] = 0
    big = np.concatenate([group.astype(">u8").view(np.uint8).reshape(-1, 8), grid.astype(">u4").view(np.uint8).reshape(len(grid), -1)], axis=1)
    order = np.argsort(np.ascontiguousarray(big).view(f"S{big.shape[1]}").reshape(-1), kind="stable")
    # common prefixes of neighbours in suffix order, in words; none across groups
    differ = grid[order][1:] != grid[order][:-1]
    common = np.where(differ.any(1), differ.argmax(1), wide)
    common = np.minimum(common, np.minimum(sizes[order][1:], sizes[order][:-1]))
    common[group[order][1:] != group[order][:-1]] = 0
    # the topmost nodes of at least ``length`` words: runs of neighbours whose common prefixes stay as long
    opens = np.concatenate([[True], common < length])
    heads = np.flatnonzero(opens)
    least = np.minimum.reduceat(np.where(opens, np.iinfo(np.int64).max, np.concatenate([[0], common])), heads)
    node = np.cumsum(opens) - 1
    number, depth = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    number[order] = node
    depth[order] = np.minimum(least[node], sizes[order])
    rank = np.lexsort((*reversed(order_by), number))
    begins = np.concatenate([[True], number[rank][1:] != number[rank][:-1]])
    earliest = rank[np.maximum.accumulate(np.where(begins, np.arange(len(rank)), 0))]
    # rows repeated whole are the earliest as well
    later = np.zeros(len(order), bool)
    later[rank] = np.any([key[rank] != key[earliest] for key in order_by], axis=0)
    leads = np.zeros(len(order), bool)
    leads[rank[begins]] = True
    return depth, later, leads


#: Stands for a null doc_id, after all others.
LAST_ID = np.iinfo(np.int64).max

_RUN = "prefix long, doc_id long, tie long, start long, words binary, large boolean"
_OUT = "found boolean, prefix long, doc_id long, tie long, start long, size long, words binary"


def _trees(length: int, anchors: int, k: int):
    """A mapInPandas function over runs sorted by prefix: repeats found (start and size), and the runs that go on, with
    prefixes of so many anchors."""

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        w = K.words_of([bytes(x) for x in part["words"]])
        name, count = K.names(w), w.counts
        owner = np.repeat(np.arange(len(part)), count - length + 1)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(count - length + 1) - (count - length + 1), count - length + 1)
        ids, ties, starts = part["doc_id"].to_numpy()[owner], part["tie"].to_numpy()[owner], part["start"].to_numpy()[owner] + nth
        depth, later, leads = deep_nodes(name, w.first[owner] + nth, count[owner] - nth, part["prefix"].to_numpy().view(np.uint64)[owner], [ids, ties, starts], length)
        # neighbouring repeats of a run are one
        at = np.flatnonzero(later)
        cuts = np.flatnonzero(np.concatenate([[True], (owner[at][1:] != owner[at][:-1]) | (nth[at][1:] != nth[at][:-1] + 1)])) if len(at) else at
        out = [pd.DataFrame()]
        if len(at):
            ends = np.maximum.reduceat(starts[at] + depth[at], cuts)
            a = at[cuts]
            out.append(pd.DataFrame({"found": True, "prefix": np.int64(0), "doc_id": ids[a], "tie": ties[a], "start": starts[a], "size": ends - starts[a], "words": b""}))
        at = np.flatnonzero(leads & part["large"].to_numpy()[owner])
        if len(at):
            names, place = longer_prefixes(w, w.first[owner[at]] + nth[at], anchors, length, k)
            cuts = np.flatnonzero(np.concatenate([[True], (owner[at][1:] != owner[at][:-1]) | (nth[at][1:] != nth[at][:-1] + 1) | (names[1:] != names[:-1]) | (place[1:] != place[:-1])]))
            a, b = at[cuts], at[np.append(cuts[1:], len(at)) - 1]
            low, high = w.starts[w.first[owner[a]] + nth[a]], w.ends[w.first[owner[b]] + nth[b] + length - 1]
            blobs = [w.buf[x:y] for x, y in zip(low.tolist(), high.tolist(), strict=True)]
            out.append(pd.DataFrame({"found": False, "prefix": names[cuts].view(np.int64), "doc_id": ids[a], "tie": ties[a], "start": starts[a], "size": np.int64(0), "words": blobs}))
        return pd.concat(out)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            cuts = np.flatnonzero(batch["prefix"].to_numpy()[1:] != batch["prefix"].to_numpy()[:-1]) + 1
            size += len(batch)
            if size < 2 * GROUP or not len(cuts):
                held.append(batch)
                continue
            yield grow(pd.concat([*held, batch.iloc[: cuts[-1]]], ignore_index=True))
            held, size = [batch.iloc[cuts[-1] :]], len(batch) - int(cuts[-1])
        if size:
            yield grow(pd.concat(held, ignore_index=True))

    return run


def dedup_substrings(docs: DataFrame, *, length: int = LENGTH, group: int = GROUP, with_text: bool = True) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and, if with_text, kept (the words left, joined by a space).

    Documents are ordered by doc_id (null last), those of one doc_id by their text's hash. Rows of one doc_id and one
    text are one document, and each gets its result. Null and empty texts have no words. length: words of a repeat, at
    least 1; anchors are as short as it if it is below six. group: rows in memory at once, 2 at least."""
    if length < 1:
        raise ValueError("length must be at least 1")
    k, group = min(ANCHOR, length), max(group, 2)
    n = partitions(docs)
    rows = documents(docs, "doc_id", "text").select(F.coalesce("doc_id", F.lit(int(LAST_ID))).alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "text")

    def scan(batch: pd.DataFrame) -> pd.DataFrame:
        w = K.words(batch["text"].tolist())
        starts, place, h = least_anchors(w, length, k)
        at = place[np.concatenate([[True], place[1:] != place[:-1]])] if len(place) else place
        again = K.equal_earlier(w.doc[at], h[at])[1] if len(at) else np.zeros(0, bool)
        doc = w.doc[at]
        return pd.DataFrame({"anchor": h[at].view(np.int64), "doc_id": batch["doc_id"].to_numpy()[doc], "tie": batch["tie"].to_numpy()[doc], "pos": (at - w.first[doc]).astype(np.int32), "again": again})

    anchors = staged(rows.select("doc_id", "tie", "text").mapInPandas(in_chunks(scan, size=1 << 20), "anchor long, doc_id long, tie long, pos int, again boolean"))
    # copies of one text come to its first document alone
    heads = staged(rows.groupBy("digest").agg(F.min(F.struct("doc_id", "tie")).alias("head")).select("head.doc_id", "head.tie"))
    repeated = anchors.groupBy("anchor").agg(F.count("*").alias("n"), F.min("tie").alias("low"), F.max("tie").alias("high"), F.max("again").alias("again")).where("low <> high or again")
    repeated = staged(repeated.select("anchor", F.ceil(F.col("n") / group).cast("int").alias("parts"), "n"))
    # anchors so frequent that their rows would crowd one task: at most HOT
    often = F.col("n") > anchors.count() / HOT
    hot = repeated.where(often).select("anchor", "parts")
    sites = anchors.select("anchor", "doc_id", "tie", "pos")
    beside = sites.join(F.broadcast(hot.select("anchor")), "anchor", "left_anti")
    found = sites.join(F.broadcast(hot), "anchor").unionByName(beside.join(repeated.where(~often).select("anchor", "parts"), "anchor"))
    found = found.join(heads.select("doc_id", "tie").distinct(), ["doc_id", "tie"], "left_semi")
    places = staged(found.groupBy("doc_id", "tie").agg(F.collect_list("pos").alias("places"), F.collect_list("parts").alias("parts")))
    release(anchors, repeated)

    def suffixes(batch: pd.DataFrame) -> pd.DataFrame:
        w = K.words(batch["text"].tolist())
        starts, place, h = least_anchors(w, length, k)
        parts = np.zeros(len(w.hashes) + 1, np.int64)
        for first, at, p in zip(w.first[:-1].tolist(), batch["places"], batch["parts"], strict=True):
            parts[first + np.asarray(at)] = p
        keep = parts[place] > 0
        starts, place = starts[keep], place[keep]
        # one row for neighbours of one anchor, with all their words
        runs = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)])) if len(starts) else starts
        a, b = starts[runs], starts[np.append(runs[1:], len(starts)) - 1] if len(starts) else starts
        d, p = w.doc[a], place[runs]
        ids, ties = batch["doc_id"].to_numpy()[d], batch["tie"].to_numpy()[d]
        with np.errstate(over="ignore"):
            part = K.mix(K.mix(ties.view(np.uint64)) + a.astype(np.uint64)) % parts[p].astype(np.uint64)
            prefix = K.mix(h[p] + part)
        words = [w.buf[x:y] for x, y in zip(w.starts[a].tolist(), w.ends[b + length - 1].tolist(), strict=True)]
        return pd.DataFrame({"prefix": prefix.view(np.int64), "doc_id": ids, "tie": ties, "start": a - w.first[d], "words": words, "large": parts[p] > 1})

    texts = rows.select("doc_id", "tie", "text").join(places.hint("shuffle_hash"), ["doc_id", "tie"])
    runs = texts.mapInPandas(in_chunks(suffixes, size=1 << 20), _RUN)
    span, rounds, marks, outs = length - k + 1, 0, [], []
    while True:
        out = staged(runs.repartition(n, "prefix").sortWithinPartitions("prefix").mapInPandas(_trees(length, min(2 << rounds, span), k), _OUT))
        outs.append(out)
        marks.append(out.where("found").select("doc_id", "tie", "start", "size"))
        ahead = out.where("not found").select("prefix", "doc_id", "tie", "start", "words")
        if ahead.isEmpty():
            break
        # groups of several runs go on, those too large in parts
        counts = ahead.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1").select("prefix", F.ceil(F.col("n") / group).alias("parts"))
        part = F.expr(f"if(parts > 1, xxhash64(prefix, pmod(xxhash64(doc_id, tie, start, {rounds}), parts)), prefix)")
        runs = ahead.join(counts, "prefix").select(part.alias("prefix"), "doc_id", "tie", "start", "words", (F.col("parts") > 1).alias("large"))
        rounds += 1
    removed = marks[0]
    for more in marks[1:]:
        removed = removed.unionByName(more)
    removed = staged(removed.groupBy("doc_id", "tie").agg(F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes")))
    release(places, *outs)

    def strip(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc_id, text, head, starts, sizes in zip(batch["doc_id"], batch["text"], batch["head"], batch["starts"], batch["sizes"], strict=True):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            n = len(words)
            if not head and n >= length:
                kept, gone = [], n
            elif starts is None or not head:
                kept, gone = words, 0
            else:
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, np.asarray(starts), 1)
                np.add.at(edge, np.asarray(starts) + np.asarray(sizes), -1)
                left = np.cumsum(edge[:n]) == 0
                kept = list(compress(words, left.tolist()))
                gone = n - len(kept)
            joined = b" ".join(kept)
            out.append((doc_id, n, gone, hashlib.sha256(joined).hexdigest(), *([joined.decode("utf-8", "surrogatepass")] * with_text)))
        frame = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text)
        frame["doc_id"] = frame["doc_id"].astype("Int64").mask(frame["doc_id"] == LAST_ID)
        return frame

    every = rows.select("doc_id", "tie", "text").join(removed.hint("shuffle_hash"), ["doc_id", "tie"], "left")
    first_ids = heads.select("doc_id", "tie", F.lit(True).alias("first")).distinct()
    every = every.join(first_ids.hint("shuffle_hash"), ["doc_id", "tie"], "left").withColumn("head", F.coalesce("first", F.lit(False)))
    return every.select("doc_id", "text", "head", "starts", "sizes").mapInPandas(in_chunks(strip), "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"), with_text=False)


QUERIES = {"op4_substring_dedup": op4_substring_dedup}
ORACLES: dict[str, str] = {}
