"""Consensus of each peak's insertions, duplicate alleles, and reference alleles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tandemlake.assay import AMPLICON, WT, Settings
from tandemlake.functions import sequence as S
from tandemlake.kernels import msa
from tandemlake.kernels.align import DISCOVERY, align_batch, insertions


#: Parts of a key's sequences, each of which is cut to the panel's size by itself.
PARTS = 64


def panel(counts: DataFrame, keys: list[str], max_unique: int, min_coverage: float) -> DataFrame:
    """The heaviest sequences (seq, n, first) of each key until they cover min_coverage of its reads, the one that crosses
    included, at most max_unique."""
    total = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    # only the heaviest of a key can be chosen: they are found in parts, so that no task sorts all of a key's sequences
    part = counts.withColumn("_part", F.pmod(F.xxhash64("n", "first"), F.lit(PARTS)))
    order = [F.desc("n"), F.col("first")]
    heavy = part.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))).where(F.col("_rank") <= max_unique).drop("_part", "_rank")
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = heavy.withColumns({"panel_rank": F.row_number().over(w), "_before": before}).join(total, keys)
    return ranked.where((F.col("panel_rank") <= max_unique) & ((F.col("panel_rank") == 1) | (F.col("_before") / F.col("_total") < min_coverage))).drop("_before", "_total")


def column_consensus(alleles: DataFrame, keys: list[str], base_threshold: float, min_coverage: float) -> DataFrame:
    """keys, consensus, max_minor of aligned alleles (rows of one length, column aligned, weight n, order ``first``): columns
    with enough non-gap weight, each with its heaviest base or N."""
    cells = alleles.select(*keys, "n", "first", F.posexplode(F.split("aligned", "")).alias("col", "base"))
    total = alleles.groupBy(*keys).agg(F.sum("n").alias("_all"))
    votes = cells.where("base <> '-' and base <> ''").groupBy(*keys, "col", "base").agg(F.sum("n").alias("w"), F.min(F.struct(-F.col("n"), F.col("first"))).alias("seen"))
    best = votes.groupBy(*keys, "col").agg(F.sum("w").alias("cover"), F.min(F.struct(-F.col("w"), F.col("seen"), F.col("base"))).alias("top"))
    best = best.join(F.broadcast(total), keys).withColumn("share", -F.col("top.col1") / F.col("cover")).where(F.col("cover") / F.col("_all") >= min_coverage)
    called = best.withColumn("called", F.when(F.col("share") >= base_threshold, F.col("top.base")).otherwise("N"))
    g = called.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("col", "called"))).alias("c"), F.min("share").alias("worst"))
    return g.select(*keys, F.array_join(F.col("c.called"), "").alias("consensus"), (1 - F.col("worst")).alias("max_minor"))


CONSENSUS = "peak_alias string, n_total_reads long, n_unique long, consensus_len int, consensus_seq string, max_minor_fraction double, consensus_ins_pos_ref int, raw_median_ins_pos_ref int, allele_consensus_len int"


def peak_consensus(insertions_: DataFrame, settings: Settings, ref: str = WT) -> DataFrame:
    """One row for each peak whose consensus allele is the reference with exactly one sufficient insertion. Alleles are
    counted and cut to a panel by Spark; a task gets at most msa_max_unique alleles of a peak."""
    allele = S.reconstruct_allele(F.lit(ref), F.col("ins_pos_ref"), F.col("ins_seq"))
    rows = insertions_.select("peak_alias", F.upper(allele).alias("seq"), F.struct("ins_pos_ref", "ins_len", "read_id").alias("place"), "ins_pos_ref")
    # a median from the counts of distinct places
    by_place = rows.groupBy("peak_alias", "ins_pos_ref").agg(F.count("*").alias("n"))
    medians = by_place.groupBy("peak_alias").agg(F.percentile("ins_pos_ref", F.lit(0.5), F.col("n")).cast("int").alias("raw_median"), F.sum("n").alias("n_total"))
    counts = rows.groupBy("peak_alias", "seq").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    uniques = counts.groupBy("peak_alias").agg(F.count("*").alias("n_unique"))
    chosen = panel(counts, ["peak_alias"], settings.msa_max_unique, settings.msa_min_weight_coverage).join(F.broadcast(medians.join(uniques, "peak_alias")), "peak_alias")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("panel_rank")
        alleles, weights = part["seq"].tolist(), part["n"].tolist()
        left, right = msa.context_window([msa.boundary_interval(a, ref) for a in alleles], weights, len(ref))
        end = ref[len(ref) - right :]
        # alleles outside the window, whose ends differ from the reference's, can't be trimmed
        kept = [(a, w) for a, w in zip(alleles, weights, strict=True) if a.startswith(ref[:left]) and a.endswith(end)]
        core = [a[left : len(a) - right] for a, _ in kept]
        called = msa.weighted_consensus(msa.star(core), [w for _, w in kept], settings.msa_base_threshold, settings.msa_min_col_coverage)
        whole = ref[:left] + called.sequence + end
        out = pd.DataFrame(columns=["peak_alias", "n_total_reads", "n_unique", "consensus_len", "consensus_seq", "max_minor_fraction", "consensus_ins_pos_ref", "raw_median_ins_pos_ref", "allele_consensus_len"])
        if set(whole) - set("ACGT"):
            return out
        low, high = msa.boundary_interval(whole, ref)
        net = len(whole) - len(ref)
        if net >= settings.min_itd_size and low <= high:
            found = [(low, low, net)]
        else:
            found = [x for x in insertions(align_batch(ref, [whole], DISCOVERY)[0].blocks) if x[2] >= settings.min_itd_size]
        if len(found) != 1 or found[0][2] > settings.max_itd_size:
            return out
        pos, q, size = found[0]
        first = part.iloc[0]
        out.loc[0] = [first["peak_alias"], int(first["n_total"]), int(first["n_unique"]), size, whole[q : q + size], round(called.max_minor, 4), pos, int(first["raw_median"]), len(whole)]
        return out

    return chosen.select("peak_alias", "seq", "n", "panel_rank", "raw_median", "n_total", "n_unique").groupBy("peak_alias").applyInPandas(run, CONSENSUS)


def merge_duplicates(consensus: DataFrame, ref: str = WT) -> DataFrame:
    """peak_alias, owner: peaks of one reconstructed allele belong to the one of most reads (then the least alias)."""
    allele = S.reconstruct_allele(F.lit(ref), F.col("consensus_ins_pos_ref"), F.col("consensus_seq"))
    w = Window.partitionBy("_allele").orderBy(F.desc("n_total_reads"), "peak_alias")
    return consensus.withColumn("_allele", allele).select("peak_alias", F.first("peak_alias").over(w).alias("owner"))


def merged_peaks(peaks: DataFrame, owners: DataFrame) -> DataFrame:
    """Peaks summed into their owners: counts and shares added, mean and deviation pooled by read count."""
    w = F.col("effective_read_count")
    j = peaks.join(F.broadcast(owners), "peak_alias", "left").withColumn("peak_alias", F.coalesce("owner", "peak_alias")).drop("owner")
    g = j.groupBy("peak_alias").agg(F.sum("fraction").alias("fraction"), F.sum(w).alias("effective_read_count"), (F.sum(w * F.col("mean_bp")) / F.sum(w)).alias("mean_bp"), (F.sum(w * (F.col("sd_bp") * F.col("sd_bp") + F.col("mean_bp") * F.col("mean_bp"))) / F.sum(w)).alias("_square"))
    return g.withColumn("sd_bp", F.sqrt(F.greatest(F.col("_square") - F.col("mean_bp") * F.col("mean_bp"), F.lit(0.0)))).drop("_square")


def reference_alleles(consensus: DataFrame, genome: str = "hg38", ref: str = WT) -> DataFrame:
    """ref_alias, ref_seq, local_pos, itd_len, itd_seq, chrom, genomic_pos; the wild type first."""
    start = AMPLICON[genome if genome == "hg38" else "hg19"][0]
    itd = consensus.select(
        F.col("peak_alias").alias("ref_alias"), S.reconstruct_allele(F.lit(ref), F.col("consensus_ins_pos_ref"), F.col("consensus_seq")).alias("ref_seq"), F.col("consensus_ins_pos_ref").alias("local_pos"), F.length("consensus_seq").alias("itd_len"),
        F.col("consensus_seq").alias("itd_seq"), F.lit("chr13").alias("chrom"), S.genomic_position(F.col("consensus_ins_pos_ref"), start, len(ref)).alias("genomic_pos"),
    )
    wt = consensus.sparkSession.createDataFrame([("WT", ref, None, 0, "", "chr13", None)], "ref_alias string, ref_seq string, local_pos int, itd_len int, itd_seq string, chrom string, genomic_pos int")
    return wt.unionByName(itd)
