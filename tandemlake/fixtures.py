"""Reads derived from the orders table: the same SQL text runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Common table expressions; ``reads`` is the last one.
READS_CTES = """wt AS (SELECT 'CTGTACCTTTCAGCATTTTGACGGCAACCTGGATTGAGACTCCTGTTTTGCTAATTCCATAAGCTGTTGCGTTCATCACTTTTCCAAAAGCACCTGATCCTAGTACCTTCCCTGCAAAGACAAATGGTGAGTACGTGCATTTTAAAGATTTTCCAATGGAAAAGAAATGCTGCAGAAACATTTGGCACATTCCATTCTTACCAAACTCTAAATTTTCTCTTGGAAACTCCCATTTGAGATCATATTCATATTCTCTGAAATCAACGTAGAAGTACTCATTATCTGAGGAGCCGGTCACCTGTACCATCTGTAGCTGGCTTTCATACCTAAATTGCT' AS w),
haps AS (
  SELECT 'WT' AS haplotype, 0 AS lo, 55 AS hi, w AS allele FROM wt
  UNION ALL SELECT 'ITD_A', 55, 75, concat(substr(w,1,180), substr(w,136,45), substr(w,181)) FROM wt
  UNION ALL SELECT 'ITD_B', 75, 87, concat(substr(w,1,120), substr(w,76,45), substr(w,121)) FROM wt
  UNION ALL SELECT 'ITD_C', 87, 95, concat(substr(w,1,180), substr(w,151,30), substr(w,181)) FROM wt
  UNION ALL SELECT 'ITD_D', 95, 100, concat(substr(w,1,180), substr(w,136,5), translate(substr(w,141,1),'ACGT','CGTA'),
      substr(w,142,14), translate(substr(w,156,1),'ACGT','CGTA'), substr(w,157,14),
      translate(substr(w,171,1),'ACGT','CGTA'), substr(w,172,9), substr(w,181)) FROM wt),
seeds AS (
  SELECT CAST(o_orderkey AS BIGINT) AS read_id,
         CAST((CAST(o_orderkey AS BIGINT)*7919 + o_custkey*31) % 100 AS INT) AS u,
         CAST((CAST(o_orderkey AS BIGINT)*13 + o_custkey*7) % 296 AS INT) + 21 AS ep,
         CAST((CAST(o_orderkey AS BIGINT)*3 + o_custkey) % 10 AS INT) AS ek,
         CASE WHEN (o_orderkey + o_custkey) % 2 = 0 THEN '+' ELSE '-' END AS strand,
         CAST(o_custkey % 61 AS INT) AS mapq
  FROM orders),
reads AS (
  SELECT read_id, strand, mapq, haplotype, read_seq,
         repeat(CASE CAST(read_id % 5 AS INT) WHEN 0 THEN '5' WHEN 1 THEN '+' ELSE 'I' END, length(read_seq)) AS read_qual,
         CAST(length(read_seq) AS INT) AS read_len
  FROM (SELECT s.read_id, s.strand, s.mapq, h.haplotype,
          CASE s.ek WHEN 0 THEN concat(substr(h.allele,1,s.ep-1), substr(h.allele,s.ep+1))
                    WHEN 1 THEN concat(substr(h.allele,1,s.ep), 'A', substr(h.allele,s.ep+1))
                    WHEN 2 THEN concat(substr(h.allele,1,s.ep-1), 'C', substr(h.allele,s.ep+1))
                    ELSE h.allele END AS read_seq
        FROM seeds s JOIN haps h ON s.u >= h.lo AND s.u < h.hi) x)"""


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def _seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of orders over all cores: a file of few row groups gives few tasks, and a read is fifty times as wide as its keys."""
    keys = orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    return keys.repartition(max(keys.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism), "o_orderkey")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_id, strand, mapq, haplotype (truth), read_seq, read_qual, read_len."""
    text = READS_CTES.replace("FROM orders)", "FROM {orders})")
    return spark.sql(f"WITH {text} SELECT * FROM reads", orders=_seeds(spark, sf_dir))


def with_reads(select: str) -> str:
    """DuckDB SQL with the reads in scope; select may begin with further common table expressions."""
    return f"WITH {READS_CTES}{select if select.lstrip().startswith(',') else ' ' + select}"


#: Reads with two more substitutions each, at places that run through the read: nearly every sequence is another one.
NOISY = """noisy AS (
  SELECT read_id, strand, haplotype, read_qual, read_len,
         concat(substr(read_seq, 1, p - 1), translate(substr(read_seq, p, 1), 'ACGT', 'CGTA'), substr(read_seq, p + 1, q - p - 1), translate(substr(read_seq, q, 1), 'ACGT', 'GTAC'), substr(read_seq, q + 1)) AS read_seq
  FROM (SELECT *, CAST(20 + read_id * 37 % 140 AS INT) AS p, CAST(170 + read_id * 53 % 150 AS INT) AS q FROM reads) y)"""


def noisy_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reads, nearly all of them unique."""
    text = READS_CTES.replace("FROM orders)", "FROM {orders})")
    return spark.sql(f"WITH {text}, {NOISY} SELECT * FROM noisy", orders=_seeds(spark, sf_dir))
