"""Target-distribution importance resampling: documents drawn by how much their n-grams look like a target's.

Each task counts its documents with DuckDB: SQL lower-cases, cuts and unnests the words, a window puts each word beside
the one after it, and a registered function gives zlib's CRC of every n-gram. What leaves a task is one row a document
with its bucket counts, which Spark spills to Parquet in the shared folder. Spark then merges the counts of all documents
by bucket, turns them and the target's into gains, scores each document from its own spilled counts, and draws the
highest scores under Gumbel noise, which is a draw without replacement in proportion to the weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, ordered, release, running_sum, staged, table

BUCKETS = 10_000
#: Share of the documents that are drawn, in percent, and the words that a document has at least to be drawn.
PERCENT, LEAST_WORDS = 25, 20
SEED = 7
#: Bytes of text that DuckDB counts at once; a longer text is counted by itself.
SLICE = 1 << 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Fixed value: the contract's words, after A-Z are lower-cased.
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_COUNTS = f"""
WITH texts AS (
  SELECT place, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS found FROM batch),
words AS (SELECT place, unnest(found) AS word, generate_subscripts(found, 1) AS nth FROM texts),
pairs AS (SELECT place, word, lead(word) OVER (PARTITION BY place ORDER BY nth) AS next_word FROM words),
features AS (
  SELECT place, word AS feature FROM pairs
  UNION ALL SELECT place, word || ' ' || next_word FROM pairs WHERE next_word IS NOT NULL),
counted AS (SELECT place, crc(feature) % {{buckets}} AS bucket, count(*) AS n FROM features GROUP BY ALL)
SELECT place, CAST(sum(n) AS BIGINT) AS n_features, list(CAST(bucket AS INTEGER)) AS buckets, list(n) AS counts
FROM counted GROUP BY place ORDER BY place"""


def _crc(features: pa.Array) -> pa.Array:
    blobs = features.cast(pa.binary()).to_numpy(zero_copy_only=False)
    return pa.array(np.fromiter(map(zlib.crc32, blobs), np.int64, len(blobs)))


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """rows (key columns, then text) with, in place of text: n_words and n_features (long), and buckets and counts, arrays
    with an entry for each bucket that the text's features fall in. Null texts and texts without words have none."""
    keys = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        # a slice bounds what a query holds, so nothing is left to spill to a disk of the executor's own
        with duckdb.connect(config={"threads": 1, "temp_directory": ""}) as db:
            db.create_function("crc", _crc, ["VARCHAR"], "BIGINT", type="arrow")
            for batch in batches:
                sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
                slices = np.cumsum(sizes) // SLICE
                for piece in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(slices)) + 1):
                    if len(piece):
                        yield count(db, batch.slice(piece[0], len(piece)))

    def count(db, batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        db.register("batch", pa.table({"place": pa.array(range(n), pa.int64()), "text": batch["text"]}))
        found = db.sql(_COUNTS.format(buckets=buckets)).to_arrow_table()
        db.unregister("batch")
        at = np.full(n, -1)
        at[found["place"].to_numpy()] = np.arange(found.num_rows)
        take = pa.array(at, mask=at < 0)
        features = pc.fill_null(found["n_features"].combine_chunks().take(take), 0)
        # of a text with n words, n features are words and n - 1 pairs
        words = pa.array((features.to_numpy() + 1) // 2)
        lists = [found[c].combine_chunks().take(take).cast(pa.list_(kind)) for c, kind in (("buckets", pa.int32()), ("counts", pa.int64()))]
        names = [f.name for f in keys] + ["n_words", "n_features", "buckets", "counts"]
        return pa.RecordBatch.from_arrays([*(batch[f.name] for f in keys), words, features, *lists], names=names)

    made = T.StructType(list(keys)).add("n_words", "long").add("n_features", "long").add("buckets", T.ArrayType(T.IntegerType())).add("counts", T.ArrayType(T.LongType()))
    return rows.select(*[f"`{f.name}`" for f in keys], "text").mapInArrow(run, made)


def _by_bucket(counted: DataFrame, name: str) -> DataFrame:
    pairs = F.explode(F.arrays_zip("buckets", "counts")).alias("p")
    return counted.where("n_features > 0").select(pairs).groupBy(F.col("p.buckets").alias("bucket")).agg(F.sum("p.counts").alias(name))


def bucket_gains(counted: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row with gains: for each bucket, in order, floor(1000 * log of the target's smoothed share over the corpus's)."""
    both = counted.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    both = both.join(_by_bucket(counted, "s"), "bucket", "left").join(_by_bucket(target, "t"), "bucket", "left").fillna(0, ["s", "t"])
    totals = both.agg(F.sum("s").cast("double").alias("all_s"), F.sum("t").cast("double").alias("all_t"))
    one = lambda c: F.col(c).cast("double") + 1.0
    ratio = one("t") * (F.col("all_s") + float(buckets)) / (one("s") * (F.col("all_t") + float(buckets)))
    gains = both.crossJoin(F.broadcast(totals)).select("bucket", F.floor(1000.0 * F.log(ratio)).alias("gain"))
    return gains.agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "gain"))), lambda g: g["gain"]).alias("gains"))


def _noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a hash of the seed and doc_id (a null one counts as empty)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance_sample(docs: DataFrame, target: DataFrame, *, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight, score and rank (from 1; null if it isn't drawn), all long.

    target: any table with a text column. weight is the floored mean gain of the document's features (none: 0). Of the
    documents with ``least_words`` words, ``percent`` in a hundred are drawn, those of the highest score, ties to the smaller
    doc_id. Null texts have no features and can't be drawn; a null doc_id has the noise of an empty one and comes first
    among ties; repeated rows are documents of their own, and those alike in doc_id and score rank by n_features. With an
    empty target all of its counts are 0. Further columns of either table are left aside."""
    counted = staged(bucket_counts(documents(docs, "doc_id", "text"), buckets))
    aimed = staged(bucket_counts(target.select(F.col("`text`").cast("string").alias("text")), buckets))
    gains = staged(bucket_gains(counted, aimed, buckets))
    release(aimed)
    total = F.aggregate(F.zip_with("buckets", "counts", lambda b, n: F.get("gains", b) * n), F.lit(0).cast("long"), lambda a, x: a + x)
    down = F.expr("total div n_features") - F.when(F.expr("total % n_features < 0"), 1).otherwise(0)
    # one row of as many gains as there are buckets, a parameter
    weighed = counted.crossJoin(F.broadcast(gains)).select("doc_id", "n_words", "n_features", total.alias("total")).withColumn("weight", F.when(F.col("n_features") > 0, down).otherwise(0)).drop("total")
    scored = weighed.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed)).withColumn("one", (F.col("n_words") >= least_words).cast("long"))
    rows = ordered(scored.withColumn("down", -F.col("score")), "down", "doc_id", "n_features")
    release(counted, gains)
    drawn = (rows.agg(F.sum("one")).first()[0] or 0) * percent // 100
    ranked = running_sum(rows, "one", ["down", "doc_id", "n_features"], "before")
    rank = F.when((F.col("one") == 1) & (F.col("before") < drawn), F.col("before") + 1)
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def op11_importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {"op11_importance_sample": op11_importance_sample}
_FEATURES = f"""
texts AS (
  SELECT of, id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS ws
  FROM (SELECT 'd' AS of, row_number() OVER () AS id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), text FROM benchmark)),
singles AS (SELECT of, id, unnest(ws) AS f FROM texts),
features AS (
  SELECT * FROM singles
  UNION ALL SELECT of, id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM texts),
grouped AS (SELECT of, id, f, count(*) AS n FROM features GROUP BY ALL)"""
# the table and the sum over bytes of CRC-32 (polynomial 0xEDB88320), bit by bit
ORACLES = {
    "op11_importance_sample": f"""
WITH rule AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
{_FEATURES},
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(f)) + 1), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i - 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT f FROM grouped), rule),
counted AS (SELECT g.of, g.id, h.bucket, sum(g.n)::BIGINT AS n FROM grouped g JOIN hashed h USING (f) GROUP BY ALL),
merged AS (
  SELECT b.range AS bucket, coalesce(sum(n) FILTER (of = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (of = 'b'), 0)::DOUBLE AS t
  FROM range({BUCKETS}) b LEFT JOIN counted c ON c.bucket = b.range GROUP BY b.range),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + {BUCKETS}) / ((s + 1) * (sum(t) OVER () + {BUCKETS})))) AS BIGINT) AS gain FROM merged),
summed AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total FROM counted JOIN gains USING (bucket) WHERE of = 'd' GROUP BY id),
h AS (SELECT row_number() OVER () AS id, doc_id, CAST('0x' || substr(sha256(concat('{SEED}:', doc_id)), 1, 8) AS BIGINT)::DOUBLE AS h FROM documents),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
    CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0))) AS BIGINT) AS noise, len(ws) >= {LEAST_WORDS} AS fit
  FROM h JOIN texts USING (id) LEFT JOIN summed USING (id) WHERE texts.of = 'd'),
ranked AS (SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY fit ORDER BY weight + noise DESC, doc_id) AS place, count(*) OVER (PARTITION BY fit) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= {PERCENT} * n // 100 THEN place END AS rank FROM ranked"""
}
