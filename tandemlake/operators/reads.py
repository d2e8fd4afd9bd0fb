"""Reads: region scan, orientation, deduplication, primer trimming, length filters and histogram."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tandemlake.assay import FORWARD_PRIMER, REVERSE_PRIMER, Settings, reverse_complement
from tandemlake.functions import sequence as S
from tandemlake.kernels.trim import trim_read


def region_scan(alignments: DataFrame, start: int, end: int, min_mapq: int = 20) -> DataFrame:
    """Mapped alignments of sufficient mapping quality that overlap [start, end]; all predicates reach the source."""
    return alignments.where((F.col("flag").bitwiseAND(4) == 0) & (F.col("mapq") >= min_mapq) & (F.col("pos") <= end) & (F.col("pos_end") >= start))


def restore_orientation(alignments: DataFrame) -> DataFrame:
    """Sequencing orientation of primary alignments: seq and qual reversed where the flag says so."""
    back = F.col("flag").bitwiseAND(16) != 0
    primary = alignments.where(F.col("flag").bitwiseAND(0x900) == 0)
    return primary.withColumns({"seq": F.when(back, S.reverse_complement(F.col("seq"))).otherwise(F.col("seq")), "qual": F.when(back, F.reverse("qual")).otherwise(F.col("qual"))})


def keep_last(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in a total order, with the number of rows in n_rows."""
    w = Window.partitionBy(*keys)
    ranked = rows.withColumns({"_rank": F.row_number().over(w.orderBy(*[o.desc() for o in order])), "n_rows": F.count("*").over(w)})
    return ranked.where("_rank = 1").drop("_rank")


def exact_primer_trim(reads: DataFrame, left: str = REVERSE_PRIMER, right: str | None = None) -> DataFrame:
    """Adds strand and trimmed: the part from the first ``left`` to the last ``right``, both kept, in the orientation that has
    both (forward first); rows without both primers go."""
    right = right or reverse_complement(FORWARD_PRIMER)

    def cut(seq: Column) -> Column:
        a = F.instr(seq, left)
        last = F.instr(F.reverse(seq), right[::-1])
        end = F.length(seq) - last + 1
        return F.when((a > 0) & (last > 0) & (end - a + 1 >= len(left) + len(right)), F.substring(seq, a, end - a + 1))

    seq = F.col("read_seq")
    sides = F.array(F.struct(F.lit("+").alias("strand"), seq.alias("seq")), F.struct(F.lit("-").alias("strand"), S.reverse_complement(seq).alias("seq")))
    found = F.filter(F.transform(sides, lambda c: F.struct(c.strand.alias("strand"), cut(c.seq).alias("trimmed"))), lambda c: c.trimmed.isNotNull())
    one = reads.withColumn("_c", F.explode(F.slice(found, 1, 1)))
    return one.withColumns({"trimmed": F.col("_c.trimmed"), "strand": F.col("_c.strand")}).drop("_c")


def trim_primers(reads: DataFrame, settings: Settings, error_rate: float = 0.2) -> DataFrame:
    """read_id, read_seq, read_qual, strand, read_len of reads in which both primers are found with at most error_rate edits a
    base; the read is cut to the primers and turned to the reference's orientation."""
    right = reverse_complement(FORWARD_PRIMER)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for rid, seq, qual in zip(batch["read_id"], batch["read_seq"], batch["read_qual"], strict=True):
                if seq and (found := trim_read(seq, REVERSE_PRIMER, right, error_rate)):
                    strand, a, b = found
                    s = seq if strand == "+" else reverse_complement(seq)
                    q = qual if strand == "+" or qual is None else qual[::-1]
                    rows.append((rid, s[a:b], q[a:b] if q is not None and len(q) == len(s) else None, strand, b - a))
            yield pd.DataFrame(rows, columns=["read_id", "read_seq", "read_qual", "strand", "read_len"])

    kind = reads.schema["read_id"].dataType.simpleString()
    out = reads.select("read_id", "read_seq", "read_qual").mapInPandas(run, f"read_id {kind}, read_seq string, read_qual string, strand string, read_len int")
    return length_band(out, settings.min_read_length, settings.max_read_length)


def distinct_sequences(reads: DataFrame, seq: str = "read_seq") -> DataFrame:
    """The distinct non-empty sequences, seq, dealt to as many partitions as shuffles have: kernels take milliseconds a row, and
    adaptive execution, which counts bytes, would put them into a few tasks."""
    n = int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return reads.where(F.length(seq) > 0).select(F.col(seq).alias("seq")).distinct().repartition(n)


def length_band(reads: DataFrame, low: int, high: int) -> DataFrame:
    return reads.where(F.col("read_len").between(low, high))


def length_histogram(reads: DataFrame) -> DataFrame:
    """read_len, n: all that one-dimensional fitting needs."""
    return reads.groupBy("read_len").agg(F.count("*").alias("n"))


def sequence_counts(reads: DataFrame, seq: str = "read_seq", order: str = "read_id") -> DataFrame:
    """Distinct upper-case sequences: seq, n and first (the least order value), without empty ones."""
    return reads.where(F.length(seq) > 0).groupBy(F.upper(seq).alias("seq")).agg(F.count("*").alias("n"), F.min(order).alias("first"))
