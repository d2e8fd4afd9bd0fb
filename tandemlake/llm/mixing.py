"""Mixing sources to target weights by Pareto order sampling.

A source's target is met by whole copies of every document as far as they go; the rest is a sample without replacement.
Each document of the rest has an inclusion probability p that grows with a power of its size, and is ranked by its random odds over
its inclusion odds, u / (1 - u) over p / (1 - p). The sample is the head of that order, of fixed size in words: it ends
where the sum of its sizes is nearest to what the target leaves. u comes from a hash of doc_id and text, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import DOCUMENT_SCHEMA, documents, ordered, running_sum, staged, table

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
#: Inclusion probabilities grow with this power of a document's size.
POWER = 0.25


def source_weights(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """source, place (by code point, null last, from 0) and weight (taken in turn) of all sources of rows."""
    found = ordered(rows.select("source").distinct().withColumn("last", F.col("source").isNull()).withColumn("one", F.lit(1)), "last", "source")
    placed = running_sum(found, "one", ["last", "source"], "place")
    return placed.select("source", "place", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).alias("weight"))


def water_fill(sizes: DataFrame, total: float, most: float = MOST) -> DataFrame:
    """source, size, weight and target: targets by weight that sum to total and stop at ``most`` times a size, the excess
    reshared by weight until none is above.

    In the order of size over weight, those that stop come first. With all before a source stopped, the rest shares by one
    level; the true level is the greatest of these, and a source gets its weight times it, or its cap."""
    capped = sizes.withColumn("cap", F.col("size") * most).withColumn("turn", F.col("size") / F.col("weight"))
    rows = ordered(capped, "turn", "place")
    rows = running_sum(running_sum(rows, "cap", ["turn", "place"], "capped"), "weight", ["turn", "place"], "passed")
    every = sizes.agg(F.sum("weight")).first()[0]
    level = rows.agg(F.max((F.lit(total) - F.col("capped")) / (F.lit(every) - F.col("passed")))).first()[0] if every else None
    return rows.withColumn("target", F.least("cap", F.col("weight") * F.lit(level or 0.0)))


def row_key() -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))


def row_digest() -> Column:
    """Tells rows apart by all their columns; the text and doc_id stand in ``key``."""
    return F.md5(F.to_json(F.struct("key", "lang", "source", "n_chars")))


def mix_sources(docs: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, power: float = POWER) -> DataFrame:
    """Per document: doc_id, size (words; null text: 0), source_size, target, copies and taken (copies * size).

    Sources by code point, null last, take the weights in turn. Targets share ``share`` times all sizes and never exceed
    ``most`` times their source's size; no document is copied more often than that, rounded up. Documents without words
    are copied as the whole copies say. Repeated rows are documents of their own."""
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: F.length(w) > 0)).cast("long")
    whole_row = documents(docs, *(f.name for f in DOCUMENT_SCHEMA)).withColumn("key", row_key()).withColumn("row", row_digest())
    sized = staged(whole_row.select("doc_id", "source", words.alias("size"), "key", "row", F.monotonically_increasing_id().alias("uid")).withColumn("bucket", (F.length(F.bin(F.col("size") + 1)) - 1).cast("int")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("size"), F.sum(F.col("size") * F.pow(F.lit(2.0), F.col("bucket") * power)).alias("raised"))
    sizes = staged(sizes.alias("a").join(source_weights(sized, weights).alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.*", "b.place", "b.weight"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
    # p = scale * 2 ** (power * bucket): the expected words of the sample are the rest, but for p that stop at 1
    plan = water_fill(sizes, share * total, most).withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("size"))
    plan = plan.select("source", F.col("size").alias("source_size"), "target", "whole", "rest", F.when(F.col("raised") > 0, F.col("rest") / F.col("raised")).otherwise(0.0).alias("scale"))
    u = (F.conv(F.substring("key", 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    joined = sized.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))).select("d.*", "p.source_size", "p.target", "p.whole", "p.rest", "p.scale")
    p = F.least(F.lit(1.0), F.col("scale") * F.pow(F.lit(2.0), F.col("bucket") * power))
    odds = F.when(p >= 1, 0.0).when(p <= 0, F.lit(float("inf"))).otherwise(u / (1 - u) * (1 - p) / p)
    ranked = ordered(joined.withColumn("odds", odds), "source", "odds", "key", "uid")
    summed = running_sum(ranked, "size", ["source", "odds", "key", "uid"], "before", group="source")
    # the head ends where its words come nearest to the rest
    extra = (F.col("size") > 0) & (F.col("before") + F.col("size") / 2 <= F.col("rest")) & (F.col("rest") > 0)
    copies = F.col("whole") + F.when(extra, 1).otherwise(0)
    return summed.select("doc_id", "size", "source_size", "target", copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), "row", "source")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, each document as often as mix_sources copies it. Of rows repeated whole one has the copies
    of all. Null texts have no words, and are copied as the whole copies of their source say."""
    columns = [f.name for f in DOCUMENT_SCHEMA]
    rows = documents(docs, *columns).withColumn("key", row_key()).withColumn("own", row_digest())
    copies = staged(mix_sources(docs).groupBy("row").agg(F.sum("copies").cast("int").alias("copies"), F.count("*").alias("repeats")).where("copies > 0"))
    both = rows.join(copies, F.col("own") == F.col("row"))
    once = both.where("repeats = 1").select(*columns, "copies")
    if not copies.where("repeats > 1").isEmpty():
        again = both.where("repeats > 1").groupBy("own").agg(F.first(F.struct(*columns, "copies")).alias("r"))
        once = once.unionByName(again.select("r.*"))
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op8_mix_sources": op8_mix_sources}
ORACLES = {
    "op8_mix_sources": f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size
  FROM documents),
r AS (
  SELECT *, length(bin(size + 1)) - 1 AS bucket,
    (CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || text), 1, 12)) AS BIGINT) + 0.5) / 281474976710656.0 AS u
  FROM d),
s0 AS (
  SELECT source, sum(size) AS source_size, sum(size * power(2.0, {POWER} * bucket)) AS raised,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END AS w
  FROM r GROUP BY source),
s1 AS (
  SELECT *, {SHARE} * sum(source_size) OVER () AS total, {MOST} * source_size AS cap,
    coalesce(sum({MOST} * source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wleft
  FROM s0),
s2 AS (SELECT *, (total - capped) / wleft AS level FROM s1),
s3 AS (SELECT *, least(cap, w * (SELECT max(level) FROM s2)) AS target FROM s2),
s4 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM s3),
j AS (
  SELECT r.doc_id, r.source, r.size, r.u, s4.source_size, s4.target, s4.whole, s4.target - s4.whole * s4.source_size AS rest,
    least(1.0, CASE WHEN raised > 0 THEN (s4.target - s4.whole * s4.source_size) / raised ELSE 0 END * power(2.0, {POWER} * bucket)) AS p
  FROM r JOIN s4 ON r.source IS NOT DISTINCT FROM s4.source),
k AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY CASE WHEN p >= 1 THEN 0 WHEN p <= 0 THEN 'inf'::DOUBLE ELSE u / (1 - u) * (1 - p) / p END, u, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM j)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, CAST(target AS DOUBLE) AS target,
  CAST((whole + CASE WHEN size > 0 AND rest > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM k"""
}
