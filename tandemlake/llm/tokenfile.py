"""Token-id output: frequency-ranked ids in a byte-aligned variable-length code with separate control bytes.

A shard holds consecutive documents: a header, their ids and lengths, two bits for each token (its bytes less one, four
tokens to a control byte), and the tokens' bytes. A token is written as its rank by corpus frequency, so the commonest
256 take one byte. A token file is a folder: ``shards`` is a Parquet table with a shard in each row, so that any file
system Spark knows holds them and a lost task is simply written again; ``vocabulary`` has the id and count of each rank.
The folder is all that a reader needs.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import encoding
from .common import documents, in_chunks, partitions, release, scratch, staged, table

MAGIC = b"FRV1"
END_ID = 2
VOCABULARY = 1 << 16

#: For each control byte: the bytes of its four tokens.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def pack(doc_ids: np.ndarray, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    """The shard of documents with these ids and token counts, whose tokens' ranks follow one another."""
    ranks = ranks.astype(np.uint32)
    n = len(ranks)
    width = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    two = np.zeros(-(-n // 4) * 4, np.uint8)
    two[:n] = width - 1
    two = two.reshape(-1, 4)
    control = two[:, 0] | two[:, 1] << 2 | two[:, 2] << 4 | two[:, 3] << 6
    grid = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = grid[np.arange(4) < width[:, None]]
    head = MAGIC + struct.pack("<QQQ", len(doc_ids), n, len(data))
    return head + doc_ids.astype("<i8").tobytes() + counts.astype("<u4").tobytes() + control.tobytes() + data.tobytes()


def unpack(shard: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, counts and ranks of a shard, by a lookup of each control byte."""
    if shard[:4] != MAGIC:
        raise ValueError("not a shard")
    docs, n, size = struct.unpack_from("<QQQ", shard, 4)
    at = 28
    doc_ids = np.frombuffer(shard, "<i8", docs, at)
    counts = np.frombuffer(shard, "<u4", docs, at := at + 8 * docs)
    control = np.frombuffer(shard, np.uint8, -(-n // 4), at := at + 4 * docs)
    data = np.frombuffer(shard, np.uint8, size, at + len(control))
    width = _LENGTHS[control].reshape(-1)[:n]
    begin = np.cumsum(width, dtype=np.int64) - width
    ranks = data[begin].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for j in range(1, 4):
        longer = np.flatnonzero(width > j)
        if not len(longer):
            break
        ranks[longer] |= data[begin[longer] + j].astype(np.uint32) << np.uint32(8 * j)
    return doc_ids, counts, ranks


#: Stands for a null doc_id in a shard; nulls come first.
NULL_ID = np.iinfo(np.int64).min


def write_tokens(docs: DataFrame, path: str | None = None, *, vocabulary: str = "word_bpe_49k.json", end_id: int = END_ID) -> str:
    """Encodes every whole text (null: empty), appends end_id, and writes all ids in ascending doc_id order to a token file
    at path, by default one that goes when the process ends. Returns the path.

    Null doc_ids come first, rows of one doc_id in the order of a hash of their texts; each row, repeated ones too, is a
    document of its own. An empty table gives a file without shards."""
    spark = docs.sparkSession
    path = path or scratch(spark)

    def encode(batch: pd.DataFrame) -> pd.DataFrame:
        end = end_id.to_bytes(2, "little")
        ids = [e + end for e in encoding.encode_words(batch["text"].tolist(), vocabulary)]
        return pd.DataFrame({"pid": batch["pid"], "doc_id": batch["doc_id"], "n_tokens": [len(i) // 2 for i in ids], "ids": ids})

    def counted(batches):
        """Adds each row's place in its range, and to the range's last row the counts of all ids of the range."""
        before, seen, last = 0, np.zeros(VOCABULARY, np.int64), None
        for out in in_chunks(encode, size=1 << 21)(batches):
            ends = before + out["n_tokens"].cumsum()
            out["place"], out["seen"] = ends - out["n_tokens"], None
            before = int(ends.iloc[-1])
            seen += np.bincount(np.frombuffer(b"".join(out["ids"]), np.uint16), minlength=VOCABULARY)
            if last is not None:
                yield last
            last = out
        if last is not None:
            last.loc[len(last) - 1, "seen"] = zlib.compress(seen.tobytes(), 1)
            yield last

    rows = documents(docs, "doc_id", "text").select(F.coalesce("doc_id", F.lit(int(NULL_ID))).alias("doc_id"), F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("uid"), "text")
    # by text and row too, so that no doc_id is one task's
    dealt = rows.repartitionByRange(partitions(docs), "doc_id", "tie", "uid").sortWithinPartitions("doc_id", "tie", "uid").select(F.spark_partition_id().alias("pid"), "doc_id", "text")
    tokens = staged(dealt.mapInPandas(counted, "pid int, doc_id long, n_tokens long, ids binary, place long, seen binary"))

    # one row for each range of doc_ids: where its ids begin
    sums = sorted((r.pid, r.n) for r in tokens.groupBy("pid").agg(F.sum("n_tokens").alias("n")).collect())
    base, total = {}, 0
    for pid, n in sums:
        base[pid], total = total, total + n

    def count(batches):
        c = np.zeros(VOCABULARY, np.int64)
        for batch in batches:
            for z in batch["seen"]:
                c += np.frombuffer(zlib.decompress(z), np.int64)
        there = np.flatnonzero(c)
        yield pd.DataFrame({"id": there, "n": c[there]})

    seen = tokens.where("seen is not null").select("seen").mapInPandas(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(VOCABULARY, np.int64)
    for r in seen:
        counts[r.id] = r.n
    by_rank = np.lexsort((np.arange(VOCABULARY), -counts)).astype(np.uint32)
    rank = np.empty(VOCABULARY, np.uint16)
    rank[by_rank] = np.arange(VOCABULARY)

    def shard(batches):
        for batch in batches:
            batch = batch.assign(start=batch["pid"].map(base) + batch["place"]).sort_values("start", kind="stable")
            # a shard's documents follow one another: it ends where a start isn't the last end
            breaks = np.flatnonzero(np.append(True, (batch["start"].to_numpy()[1:] != (batch["start"] + batch["n_tokens"]).to_numpy()[:-1])))
            for a, b in zip(breaks, np.append(breaks[1:], len(batch)), strict=True):
                part = batch.iloc[a:b]
                ranks = rank[np.frombuffer(b"".join(part["ids"]), np.uint16)]
                yield pd.DataFrame({"start": [part["start"].iloc[0]], "n_docs": [len(part)], "shard": [pack(part["doc_id"].to_numpy(), part["n_tokens"].to_numpy(), ranks)]})

    tokens.drop("seen").mapInPandas(shard, "start long, n_docs long, shard binary").write.parquet(f"{path}/shards")
    ranked = pd.DataFrame({"rank": np.arange(VOCABULARY), "id": by_rank.astype(np.int64), "n": counts[by_rank]})
    spark.createDataFrame(ranked).coalesce(1).write.parquet(f"{path}/vocabulary")
    release(tokens)
    return path


def read_tokens(spark: SparkSession, path: str, *, ids: bool = True) -> DataFrame:
    """Per document, from a token file: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids (little-endian, unsigned,
    32 bits)."""
    ranked = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").select("id").toPandas()  # a row for each id there is
    by_rank = ranked["id"].to_numpy(np.uint32)

    def read(batches):
        for batch in batches:
            for start, shard in zip(batch["start"], batch["shard"], strict=True):
                doc_ids, counts, ranks = unpack(shard)
                wide = by_rank[ranks].astype("<u4")
                ends = np.cumsum(counts, dtype=np.int64)
                parts = [wide[e - c : e].tobytes() for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                out = {"doc_id": pd.Series(doc_ids, dtype="Int64").mask(doc_ids == NULL_ID), "start": start + ends - counts, "n_tokens": counts.astype(np.int64), "ids_crc32": [zlib.crc32(p) for p in parts]}
                yield pd.DataFrame(out | ({"ids": parts} if ids else {}))

    shards = spark.read.schema("start long, n_docs long, shard binary").parquet(f"{path}/shards")
    return shards.select("start", "shard").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids)


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(spark, write_tokens(table(spark, sf_dir, "documents")), ids=False)


QUERIES = {"op3_token_file": op3_token_file}
ORACLES: dict[str, str] = {}
