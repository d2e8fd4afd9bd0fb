"""Insertions of reads against the reference, their length modes, and splitting peaks by them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tandemlake.assay import WT
from tandemlake.kernels.align import DISCOVERY, align_batch, insertions
from tandemlake.kernels.msa import boundary_interval
from tandemlake.operators.reads import distinct_sequences

MIN_GAP = 3
MAX_VALLEY = 0.5


def extract_insertions(reads: DataFrame, windows: DataFrame | None = None, ref: str = WT) -> DataFrame:
    """peak_alias (if given), read_id, strand, aln_score, pct_identity, ins_pos_ref, ins_len, ins_seq: each insertion of each
    read, within its peak's size window if windows are given. Every distinct sequence is aligned once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for seq, aln in zip(batch["seq"], align_batch(ref, batch["seq"].tolist(), DISCOVERY), strict=True):
                pid = aln.matches / aln.aligned if aln.aligned else 0.0
                rows += [(seq, aln.score / 100, pid, t, n, seq[q : q + n]) for t, q, n in insertions(aln.blocks)]
            yield pd.DataFrame(rows, columns=["seq", "aln_score", "pct_identity", "ins_pos_ref", "ins_len", "ins_seq"])

    found = distinct_sequences(reads).mapInPandas(run, "seq string, aln_score double, pct_identity double, ins_pos_ref int, ins_len int, ins_seq string")
    keep = [c for c in ("gmm_peak_alias", "read_id", "strand", "read_seq") if c in reads.columns]
    rows = reads.select(*keep).join(found, F.col("read_seq") == F.col("seq")).drop("read_seq", "seq").withColumnRenamed("gmm_peak_alias", "peak_alias")
    if windows is not None:
        rows = rows.join(F.broadcast(windows.select("peak_alias", "size_min", "size_max")), "peak_alias").where(F.col("ins_len").between(F.col("size_min"), F.col("size_max"))).drop("size_min", "size_max")
    return rows


def exact_insertion(sequences: DataFrame, ref: str = WT) -> DataFrame:
    """seq, ins_pos (least boundary), ins_len, ins_seq of distinct sequences that are the reference with one insertion.

    A batch function, not an expression: as one, the optimiser would copy the test to the reads that join it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for seq in batch["seq"]:
                net = len(seq) - len(ref)
                low, high = boundary_interval(seq, ref)
                if net > 0 and low <= high:
                    rows.append((seq, low, net, seq[low : low + net]))
            yield pd.DataFrame(rows, columns=["seq", "ins_pos", "ins_len", "ins_seq"])

    return sequences.select("seq").mapInPandas(run, "seq string, ins_pos int, ins_len int, ins_seq string")


def length_candidates(lengths: DataFrame, keys: list[str], min_reads: int, min_fraction: float) -> DataFrame:
    """keys, ins_len, n: local maxima of the counts by length (not below the length before, above the next one) with enough
    reads and share. A missing length counts 0."""
    counts = lengths.groupBy(*keys, "ins_len").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    by = w.orderBy("ins_len")
    near = counts.withColumns({
        "_total": F.sum("n").over(w),
        "_before": F.when(F.lag("ins_len").over(by) == F.col("ins_len") - 1, F.lag("n").over(by)).otherwise(0),
        "_after": F.when(F.lead("ins_len").over(by) == F.col("ins_len") + 1, F.lead("n").over(by)).otherwise(0),
    })
    ok = (F.col("n") >= min_reads) & (F.col("n") / F.col("_total") >= min_fraction) & (F.col("n") >= F.col("_before")) & (F.col("n") > F.col("_after"))
    return near.where(ok).select(*keys, "ins_len", "n")


def length_modes(lengths: DataFrame, key: str, min_reads: int, min_fraction: float, min_gap: int = MIN_GAP, max_valley: float = MAX_VALLEY) -> DataFrame:
    """key, mode, n: lengths that mark separate insertions. Candidates are folded in by descending count (the lower length on
    ties); one stays if it is min_gap away from each that stays and the counts between fall to max_valley of the smaller.
    A key has a few hundred lengths at most, so its counts are one row's map."""
    rows = lengths.select(key, F.col("ins_len").cast("int").alias("ins_len"))
    counts = rows.groupBy(key, "ins_len").agg(F.count("*").alias("n")).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("ins_len", "n"))).alias("counts"))
    tops = length_candidates(rows, [key], min_reads, min_fraction)
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("rank"), F.col("ins_len").alias("len"))))
    both = tops.groupBy(key).agg(order.alias("tops")).join(counts, key)

    def apart(x: Column, y: Column) -> Column:
        inner = F.sequence(F.least(x.len, y.len) + 1, F.greatest(x.len, y.len) - 1)
        valley = F.array_min(F.transform(inner, lambda at: F.coalesce(F.element_at("counts", at), F.lit(0))))
        return (F.abs(x.len - y.len) >= min_gap) & (valley <= F.least(-x["rank"], -y["rank"]) * max_valley)

    kept = F.aggregate("tops", F.slice("tops", 1, 0), lambda kept, x: F.when(F.forall(kept, lambda y: apart(x, y)), F.concat(kept, F.array(x))).otherwise(kept))
    return both.select(key, F.explode(kept).alias("m")).select(key, F.col("m.len").alias("mode"), (-F.col("m.rank")).alias("n"))


def nearest_mode(lengths: DataFrame, modes: DataFrame, key: str) -> DataFrame:
    """key, ins_len, mode: the nearest mode of each distinct length, on ties the one of more reads, then the lower one."""
    distinct = lengths.select(key, "ins_len").distinct()
    near = distinct.join(F.broadcast(modes), key)
    order = F.struct(F.abs(F.col("mode") - F.col("ins_len")), -F.col("n"), F.col("mode"))
    return near.groupBy(key, "ins_len").agg(F.min_by("mode", order).alias("mode"))


def cluster_guardrails(assigned: DataFrame, min_reads: int, min_fraction: float, used: Sequence[str] = ()) -> DataFrame:
    """parent, label, kept, target, child, child_reads: clusters below the guardrails fold into the parent's largest; a parent
    with fewer than two kept clusters stays whole (child is null). assigned: parent, read_id, label (null: no cluster). A child's name that is among ``used`` gets the first free
    number behind it."""
    return guarded(assigned.groupBy("parent", "label").agg(F.count("*").alias("n")), min_reads, min_fraction, used)


def guarded(counts: DataFrame, min_reads: int, min_fraction: float, used: Sequence[str] = ()) -> DataFrame:
    """The same from counts: parent, label, n."""
    w = Window.partitionBy("parent")
    clustered = F.sum(F.when(F.col("label").isNotNull(), F.col("n"))).over(w)
    counts = counts.withColumn("kept", F.col("label").isNotNull() & (F.col("n") >= min_reads) & (F.col("n") / clustered >= min_fraction))
    counts = counts.withColumns({"_kept": F.count_if("kept").over(w), "_big": F.max(F.when(F.col("kept"), F.col("n"))).over(w)})
    counts = counts.withColumn("_biggest", F.min(F.when(F.col("kept") & (F.col("n") == F.col("_big")), F.col("label"))).over(w))
    counts = counts.withColumn("target", F.when(F.col("_kept") >= 2, F.when(F.col("kept"), F.col("label")).otherwise(F.col("_biggest"))))
    sizes = counts.where("target is not null").groupBy("parent", "target").agg(F.sum("n").alias("child_reads"))
    prefix = F.when(F.upper("parent") == "WT", "ITD_WT").otherwise(F.col("parent"))
    named = sizes.withColumn("child", F.concat(prefix, F.lit("_H"), F.row_number().over(Window.partitionBy("parent").orderBy(F.desc("child_reads"), "target")).cast("string")))
    if used:
        tries = F.array(F.col("child"), *[F.concat("child", F.lit(f"_{i}")) for i in range(2, len(used) + 2)])
        named = named.withColumn("child", F.get(F.filter(tries, lambda name: ~name.isin(list(used))), F.lit(0)))
    return counts.select("parent", "label", "n", "kept", "target").join(named, ["parent", "target"], "left").select("parent", "label", "n", "kept", "target", "child", "child_reads")


def relabel(reads: DataFrame, children: DataFrame, label: Column) -> DataFrame:
    """gmm_peak_alias replaced by the child of the read's cluster, where its parent was split."""
    c = F.broadcast(children.where("child is not null").select("parent", F.col("label").alias("_label"), "child"))
    joined = reads.withColumn("_l", label).join(c, (F.col("gmm_peak_alias") == F.col("parent")) & F.col("_l").eqNullSafe(F.col("_label")), "left")
    return joined.withColumn("gmm_peak_alias", F.coalesce("child", "gmm_peak_alias")).drop("_l", "_label", "parent", "child")


def insertion_statistics(insertions_: DataFrame) -> DataFrame:
    """peak_alias, n_insertions, mean_len, sd_len (sample), median_pos; the median from the counts of distinct places."""
    sizes = insertions_.groupBy("peak_alias").agg(F.count("*").alias("n_insertions"), F.avg("ins_len").alias("mean_len"), F.stddev_samp("ins_len").alias("sd_len"))
    places = insertions_.groupBy("peak_alias", "ins_pos_ref").agg(F.count("*").alias("n")).groupBy("peak_alias").agg(F.percentile("ins_pos_ref", F.lit(0.5), F.col("n")).alias("median_pos"))
    return sizes.join(places, "peak_alias")
