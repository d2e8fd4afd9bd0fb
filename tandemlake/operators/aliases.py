"""Lineage of aliases: what became of each length peak, and the peaks' table after all splits and merges.

A read's alias is changed where it is split or merged, and all tables follow from the reads: insertions take the alias of
their read, and counts, shares and moments of peaks are those of the reads that bear the alias.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tandemlake.assay import Settings
from tandemlake.operators import insertions


def begin(assigned: DataFrame) -> DataFrame:
    """Reads with their length peak as parent_peak_alias, at refinement level 0 and split by nothing."""
    return assigned.withColumns({"parent_peak_alias": F.col("gmm_peak_alias"), "refinement_level": F.lit(0), "split_by": F.lit("")})


def refined(before: str, reads: DataFrame, split_by: str) -> DataFrame:
    """reads after a split; before: the column of the alias each had. Those that got another one are a level deeper."""
    changed = ~F.col("gmm_peak_alias").eqNullSafe(F.col(before))
    return reads.withColumns({"parent_peak_alias": F.when(changed, F.col(before)).otherwise(F.col("parent_peak_alias")), "refinement_level": F.col("refinement_level") + F.when(changed, 1).otherwise(0), "split_by": F.when(changed, split_by).otherwise(F.col("split_by"))}).drop(before)


def split_by_length(assigned: DataFrame, inserted: DataFrame, modes: DataFrame, settings: Settings) -> DataFrame:
    """Reads of peaks with several length modes (peak_alias, mode, n) under an alias for each mode. A read goes with the mode
    nearest to its longest insertion; reads without an insertion go with the largest child."""
    several = modes.groupBy("peak_alias").agg(F.count("*").alias("_n")).where("_n > 1")
    lengths = inserted.groupBy("peak_alias", "read_id").agg(F.max("ins_len").alias("ins_len")).join(F.broadcast(several), "peak_alias", "left_semi")
    nearest = insertions.nearest_mode(lengths.select("peak_alias", "ins_len"), modes.join(F.broadcast(several), "peak_alias", "left_semi"), "peak_alias")
    labels = lengths.join(F.broadcast(nearest), ["peak_alias", "ins_len"]).select(F.col("peak_alias").alias("_p"), F.col("read_id").alias("_r"), F.concat(F.col("mode").cast("string"), F.lit("bp")).alias("label"))
    labelled = assigned.join(labels, (F.col("read_id") == F.col("_r")) & (F.col("gmm_peak_alias") == F.col("_p")), "left").drop("_r", "_p")
    used = [r.a for r in assigned.select(F.col("gmm_peak_alias").alias("a")).distinct().collect()]  # a handful of peaks
    split = labelled.join(F.broadcast(several), F.col("gmm_peak_alias") == F.col("peak_alias"), "left_semi")
    children = insertions.cluster_guardrails(split.select(F.col("gmm_peak_alias").alias("parent"), "read_id", "label"), settings.min_haplotype_reads, settings.min_subpeak_fraction, used)
    return refined("_before", insertions.relabel(labelled.withColumn("_before", F.col("gmm_peak_alias")), children, F.col("label")).drop("label"), "length")


def follow(inserted: DataFrame, assigned: DataFrame) -> DataFrame:
    """Insertions (peak_alias) under the alias that their read has now."""
    now = assigned.select(F.col("read_id").alias("_r"), F.col("gmm_peak_alias").alias("_now"))
    return inserted.join(now, F.col("read_id") == F.col("_r"), "left").withColumn("peak_alias", F.coalesce("_now", "peak_alias")).drop("_r", "_now")


def merged(assigned: DataFrame, owners: DataFrame) -> DataFrame:
    """Reads of peaks with one allele under their owner's alias. owners: peak_alias, owner."""
    moved = owners.where("peak_alias <> owner").select(F.col("peak_alias").alias("_p"), "owner")
    return assigned.join(F.broadcast(moved), F.col("gmm_peak_alias") == F.col("_p"), "left").withColumn("gmm_peak_alias", F.coalesce("owner", "gmm_peak_alias")).drop("_p", "owner")


def peak_table(frame: DataFrame, assigned: DataFrame, settings: Settings) -> DataFrame:
    """peak_alias, mean_bp, sd_bp, fraction, effective_read_count, effective_allele_freq, putative_itd_size, is_wt,
    parent_peak_alias, refinement_level, split_by of the peaks that reads bear, by descending share.

    frame: the fitted length peaks, which keep their mean, deviation and weight where no read was moved. Otherwise shares are
    those of reads, and sum to 1; a peak that was made by a split or grew by a merge has the moments of its reads."""
    own = assigned.groupBy(F.col("gmm_peak_alias").alias("peak_alias")).agg(
        F.count("*").alias("n"), F.avg("read_len").alias("own_mean"), F.stddev_pop("read_len").alias("own_sd"), F.min("parent_peak_alias").alias("parent_peak_alias"),
        F.max("refinement_level").cast("int").alias("refinement_level"), F.max("split_by").alias("split_by"),
    )
    fitted = frame.select("peak_alias", "mean_bp", "sd_bp", F.col("fraction").alias("weight"), F.col("effective_read_count").alias("fitted_reads"))
    both = own.join(F.broadcast(fitted), "peak_alias", "full").withColumns({"n": F.coalesce("n", F.lit(0)), "refinement_level": F.coalesce("refinement_level", F.lit(0))})
    every = Window.partitionBy(F.lit(0))  # a handful of peaks; the reads are passed over once
    moved = F.max((F.col("n") != F.coalesce("fitted_reads", F.lit(-1))).cast("int")).over(every)
    rows = both.withColumns({"moved": moved, "total": F.sum("n").over(every)}).where("not (n = 0 and coalesce(fitted_reads, 0) > 0)")
    as_fitted = (F.col("refinement_level") == 0) & (F.col("n") == F.col("fitted_reads"))
    rows = rows.select(
        "peak_alias", F.when(as_fitted, F.col("mean_bp")).otherwise(F.col("own_mean")).alias("mean_bp"), F.when(as_fitted, F.col("sd_bp")).otherwise(F.col("own_sd")).alias("sd_bp"),
        F.when(F.col("moved") == 1, F.col("n") / F.col("total")).otherwise(F.col("weight")).alias("fraction"), F.col("n").alias("effective_read_count"), F.coalesce(F.col("n") / F.nullif("total", F.lit(0)), F.lit(0.0)).alias("effective_allele_freq"),
        (F.col("peak_alias") == "WT").alias("is_wt"), F.coalesce("parent_peak_alias", "peak_alias").alias("parent_peak_alias"), "refinement_level", F.coalesce("split_by", F.lit("")).alias("split_by"),
    )
    base = F.coalesce(F.max(F.when(F.col("is_wt"), F.col("mean_bp"))).over(every), F.lit(float(settings.wt_amplicon_length)))
    return rows.withColumn("putative_itd_size", F.col("mean_bp") - base).orderBy(F.desc("fraction"), "peak_alias")
