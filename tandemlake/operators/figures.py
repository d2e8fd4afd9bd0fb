"""The data behind the report's figures, as DataFrames."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tandemlake.assay import WT, exons
from tandemlake.kernels import msa
from tandemlake.kernels.align import DISCOVERY, align_batch, render
from tandemlake.operators.consensus import panel
from tandemlake.operators.quantify import final_support
from tandemlake.operators.ranks import ranked


def length_profile(reads: DataFrame, assigned: DataFrame, peaks: DataFrame) -> DataFrame:
    """read_len, n_all, n_assigned and fitted: the expected reads of that length by the peaks' normal curves."""
    every = reads.groupBy("read_len").agg(F.count("*").alias("n_all"))
    kept = assigned.groupBy("read_len").agg(F.count("*").alias("n_assigned"))
    total = F.sum("n_all").over(Window.partitionBy(F.lit(0)))
    j = every.join(kept, "read_len", "left").withColumn("_t", total).crossJoin(F.broadcast(peaks.select("mean_bp", "sd_bp", "fraction")))
    curve = F.col("_t") * F.col("fraction") * F.exp(-F.pow((F.col("read_len") - F.col("mean_bp")) / F.col("sd_bp"), 2) / 2) / (F.col("sd_bp") * F.sqrt(2 * F.pi()))
    return j.groupBy("read_len").agg(F.max("n_all").alias("n_all"), F.coalesce(F.max("n_assigned"), F.lit(0)).alias("n_assigned"), F.sum(curve).alias("fitted"))


def axis_limit(reads: DataFrame, share: float = 0.995) -> DataFrame:
    """p: the length that ``share`` of the reads don't exceed."""
    return reads.agg(F.percentile("read_len", share).alias("p"))


def size_distribution(insertions_: DataFrame) -> DataFrame:
    """peak_alias, ins_len, n with the peak's mean and sample deviation."""
    w = Window.partitionBy("peak_alias")
    counts = insertions_.groupBy("peak_alias", "ins_len").agg(F.count("*").alias("n"))
    mean = F.sum(F.col("n") * F.col("ins_len")).over(w) / F.sum("n").over(w)
    counts = counts.withColumn("mean_len", mean)
    var = F.sum(F.col("n") * F.pow(F.col("ins_len") - F.col("mean_len"), 2)).over(w) / F.nullif(F.sum("n").over(w) - 1, F.lit(0))
    return counts.withColumn("sd_len", F.sqrt(var))


def pileup_rows(insertions_: DataFrame, most: int = 30) -> DataFrame:
    """At most ``most`` insertions of each peak, evenly spaced in the order of place, length and read."""
    rows = ranked(insertions_, "peak_alias", ["ins_pos_ref", "ins_len", "read_id"])
    # row i is shown if some k of 0..most-1 has floor(k * n / most) = i
    k = F.ceil(F.col("_i") * most / F.col("_n"))
    return rows.where((F.col("_n") <= most) | ((k < most) & (F.floor(k * F.col("_n") / most) == F.col("_i")))).drop("_i", "_n")


def exon_overlaps(exons: DataFrame, start: int, end: int) -> DataFrame:
    """Exons (label, exon_start, exon_end) that overlap a range, cut to it: label, from, to."""
    hit = exons.where((F.col("exon_start") <= end) & (F.col("exon_end") >= start))
    return hit.select("label", F.greatest("exon_start", F.lit(start)).alias("from"), F.least("exon_end", F.lit(end)).alias("to"))


def exons_frame(spark: SparkSession, genome: str = "hg38") -> DataFrame:
    return spark.createDataFrame(exons(genome), "label string, exon_start long, exon_end long")


def genome_view(references: DataFrame, genome: str = "hg38") -> DataFrame:
    """ref_alias, genomic_pos, itd_len, exon (null between exons) of each ITD allele."""
    spans = F.broadcast(exons_frame(references.sparkSession, genome))
    itd = references.where("ref_alias <> 'WT'")
    return itd.join(spans, F.col("genomic_pos").between(F.col("exon_start"), F.col("exon_end")), "left").select("ref_alias", "genomic_pos", "itd_len", F.col("label").alias("exon"))


def density_allowed(insertions: DataFrame) -> DataFrame:
    """allowed: whether a smooth density of lengths can be drawn, that is, every peak has more than one length."""
    kinds = insertions.groupBy("peak_alias").agg(F.countDistinct("ins_len").alias("n"))
    return kinds.agg(F.coalesce(F.min("n") > 1, F.lit(True)).alias("allowed"))


def density_curve(insertions: DataFrame, step: float = 0.5) -> DataFrame:
    """peak_alias, x, density of insertion lengths: a Gaussian kernel over each length, weighted by its count, at places a step
    apart from the least to the greatest. The bandwidth is the sample deviation times n ** (-1/5), by peak. No rows unless
    every peak has more than one length (density_allowed). Lengths are bounded by the settings, so a peak's counts are one
    row, however many insertions it has."""
    counts = insertions.groupBy("peak_alias", "ins_len").agg(F.count("*").cast("double").alias("w"))
    whole = counts.groupBy("peak_alias").agg(F.collect_list(F.struct("ins_len", "w")).alias("c"), F.sum("w").alias("n"), F.sum(F.col("w") * F.col("ins_len")).alias("s"), F.min("ins_len").alias("low"), F.max("ins_len").alias("high"))
    total = lambda value: F.aggregate("c", F.lit(0.0), lambda acc, v: acc + v["w"] * value(v["ins_len"]))
    mean = F.col("s") / F.col("n")
    spread = F.sqrt(total(lambda x: (x - mean) * (x - mean)) / F.nullif(F.col("n") - 1, F.lit(0.0)))
    shaped = whole.withColumn("h", spread * F.pow(F.col("n"), F.lit(-0.2))).withColumn("x", F.explode(F.transform(F.sequence(F.lit(0), F.ceil((F.col("high") - F.col("low")) / step).cast("int")), lambda i: F.least(F.col("low") + i * step, F.col("high").cast("double")))))
    kernel = total(lambda v: F.exp(-F.pow((F.col("x") - v) / F.col("h"), F.lit(2.0)) / 2))
    curve = shaped.select("peak_alias", "x", (kernel / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))
    return curve.crossJoin(F.broadcast(density_allowed(insertions))).where("allowed").drop("allowed")


def top_differences(msa_rows: DataFrame, most: int = 8) -> DataFrame:
    """ref_alias, rank, n, shown of the heaviest aligned alleles (final_support_msa's rows): a dot where an allele has the column's
    heaviest base, else its own base, or a dash; and share, the part of the panel's reads that differ from it in some column."""
    cells = msa_rows.select("ref_alias", "rank", "n", F.posexplode(F.split("aligned", "")).alias("col", "base")).where("base <> ''")
    votes = cells.groupBy("ref_alias", "col", "base").agg(F.sum("n").alias("w"))
    heaviest = votes.groupBy("ref_alias", "col").agg(F.min(F.struct(-F.col("w"), "base")).alias("top")).select("ref_alias", "col", F.col("top.base").alias("top"))
    marks = cells.where(F.col("rank") < most).join(heaviest, ["ref_alias", "col"])
    mark = F.when(F.col("base") == F.col("top"), ".").otherwise(F.col("base"))
    shown = marks.groupBy("ref_alias", "rank", "n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", mark.alias("m")))), lambda c: c["m"]), "").alias("shown"))
    same = cells.join(heaviest, ["ref_alias", "col"]).groupBy("ref_alias", "rank", "n").agg(F.bool_and(F.col("base") == F.col("top")).alias("same"))
    share = same.groupBy("ref_alias").agg((F.sum(F.when(~F.col("same"), F.col("n")).otherwise(0)) / F.sum("n")).alias("share"))
    return shown.join(F.broadcast(share), "ref_alias").orderBy("ref_alias", "rank")


def alignment_texts(references: DataFrame, ref: str = WT, width: int = 60) -> DataFrame:
    """ref_alias and text of each ITD allele: a heading, and the allele's alignment to the wild type in lines of both sequences
    with bars between equal bases, dots between others, and dashes in gaps. Alleles are a handful, one row each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            found = align_batch(ref, t["ref_seq"].tolist(), DISCOVERY)
            heads = [f"# allele {r.ref_alias}\n# insertion at {r.chrom}:{r.genomic_pos:,}, {r.itd_len} bp\n# score {a.score / 100:g}\n\n" for r, a in zip(t.itertuples(), found, strict=True)]
            yield pd.DataFrame({"ref_alias": t["ref_alias"], "text": [h + render(ref, q, a.blocks, width) for h, q, a in zip(heads, t["ref_seq"], found, strict=True)]})

    itd = references.where("ref_alias <> 'WT'").select("ref_alias", "ref_seq", "itd_len", "chrom", "genomic_pos")
    return itd.mapInPandas(run, "ref_alias string, text string")


def reported_calls(references: DataFrame, summary: DataFrame) -> DataFrame:
    """ITD calls of the summary with their alleles, by size and alias."""
    itd = references.where((F.col("ref_alias") != "WT") & (F.col("itd_len") > 0))
    return itd.join(F.broadcast(summary.select("ref_alias", "allele_frequency", "n_itd_reads")), "ref_alias").orderBy("itd_len", "ref_alias")


def membership_json(validation: DataFrame, reported: DataFrame) -> DataFrame:
    """A JSON line for each supporting read of each reported call: its allele and id. Lines, not one list an allele, so an
    allele of any depth is written by many tasks."""
    rows = final_support(validation).join(F.broadcast(reported.select("ref_alias").distinct()), "ref_alias", "left_semi")
    return rows.select("ref_alias", F.to_json(F.struct("ref_alias", "read_id")).alias("line"))


def final_support_msa(support: DataFrame, references: DataFrame, max_unique: int = 100, min_coverage: float = 0.95, flank: int = 12) -> DataFrame:
    """ref_alias, rank, n, aligned, consensus, max_minor: the panel of each call's supporting sequences (ref_alias, read_id,
    read_seq), cut to the insertion and its flanks and aligned to the call's allele."""
    counts = support.groupBy("ref_alias", F.upper("read_seq").alias("seq")).agg(F.count("*").alias("n"), F.min("read_id").alias("first"))
    chosen = panel(counts, ["ref_alias"], max_unique, min_coverage).join(F.broadcast(references.where("ref_alias <> 'WT'")), "ref_alias")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("panel_rank")
        ref, pos, size = part["ref_seq"].iloc[0], int(part["local_pos"].iloc[0]), int(part["itd_len"].iloc[0])
        rows = msa.star([ref, *part["seq"]])
        places = [i for i, c in enumerate(rows[0]) if c != "-"]
        a, b = places[max(0, pos - flank)], places[min(len(places), pos + size + flank) - 1] + 1
        shown = [r[a:b] for r in rows[1:]]
        called = msa.weighted_consensus([rows[0][a:b], *shown], [0, *part["n"]])
        return pd.DataFrame({"ref_alias": part["ref_alias"].iloc[0], "rank": part["panel_rank"].to_numpy(), "n": part["n"].to_numpy(), "aligned": shown, "consensus": called.sequence, "max_minor": called.max_minor})

    return chosen.groupBy("ref_alias").applyInPandas(run, "ref_alias string, rank int, n long, aligned string, consensus string, max_minor double")


def column_agreement(alleles: DataFrame, keys: list[str]) -> DataFrame:
    """keys, col, agreement: the share of the heaviest base in each column of aligned alleles (column aligned, weight n)."""
    cells = alleles.select(*keys, "n", F.posexplode(F.split("aligned", "")).alias("col", "base")).where("base <> '' and base <> '-'")
    votes = cells.groupBy(*keys, "col", "base").agg(F.sum("n").alias("w"))
    return votes.groupBy(*keys, "col").agg((F.max("w") / F.sum("w")).alias("agreement"))

