"""The pipeline: propose alleles from reads, test them in competition, report those with enough support.

Reads stay in Spark throughout. The driver sees the length histogram, at most a handful of peaks and candidate alleles,
and the calls. Finding nothing is a result; errors are not turned into one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandemlake.assay import WT, Settings
from tandemlake.operators import aliases, consensus, insertions, observed, peaks, quantify, split, validation
from tandemlake.operators.lineage import cut


@dataclass
class Result:
    summary: DataFrame
    references: DataFrame
    audit: DataFrame
    peaks: DataFrame | None
    validation: DataFrame | None
    reason: str = ""
    insertions: DataFrame | None = None
    consensus: DataFrame | None = None
    unresolved: DataFrame | None = None  # peaks with insertions but no consensus
    assigned: DataFrame | None = None  # reads under the alias they have after all splits and merges


_EMPTY_CONSENSUS = consensus.CONSENSUS + ", duplication_identity double, normalized_flank_reads long"
_EMPTY_SUMMARY = "ref_alias string, n_itd_reads long, n_total_reads long, allele_frequency double, plus_reads long, minus_reads long, strand_ratio double, odds_ratio double, fisher_p double"


def exact_calls(reads: DataFrame, settings: Settings, min_af: float) -> DataFrame:
    """Calls without alignment: eligible observed alleles, supported by the reads that equal them. Reads are counted by
    sequence and strand before they meet the alleles, so no task holds the reads of a common sequence or their ids."""
    eligible = observed.discover(reads, settings).where("status = 'eligible'").select("allele", F.col("allele_id").alias("ref_alias"))
    named = eligible.unionByName(reads.sparkSession.createDataFrame([(WT, "WT")], "allele string, ref_alias string"))
    counted = reads.groupBy("read_seq", "strand").agg(F.count("*").alias("n"))
    support = counted.join(named, F.col("read_seq") == F.col("allele"))
    plus, minus = (F.coalesce(F.sum(F.when(F.col("strand") == s, F.col("n"))), F.lit(0)) for s in "+-")
    counts = support.groupBy("ref_alias").agg(F.sum("n").alias("n_reads"), plus.alias("plus_reads"), minus.alias("minus_reads"))
    return quantify.frequencies(counts, counts.agg(F.coalesce(F.sum("n_reads"), F.lit(0)).alias("n_total_reads")), min_af)


def run(reads: DataFrame, settings: Settings) -> Result:
    """reads: read_id, read_seq, read_qual, strand, read_len; trimmed and in the reference's orientation."""
    spark = reads.sparkSession
    reads = reads.select("read_id", "read_seq", "read_qual", "strand", F.col("read_len").cast("int").alias("read_len")).where(F.length("read_seq") > 0).cache()
    audit = observed.discover(reads, settings).cache() if settings.observed_rescue else None
    found = spark.createDataFrame([], _EMPTY_CONSENSUS)
    named: list[dict] = []
    frame, assigned, inserted, unresolved = None, None, None, None
    try:
        named, assigned = peaks.fit_length_peaks(reads, settings)
    except ValueError as nothing:
        if audit is None or audit.where("status = 'eligible'").isEmpty():
            return Result(spark.createDataFrame([], _EMPTY_SUMMARY), consensus.reference_alleles(found), audit, None, None, str(nothing))
        assigned = None
    if assigned is not None:
        frame = peaks.peaks_frame(spark, named)
        parents = assigned
        assigned = aliases.begin(assigned)
        if settings.subpeak_refinement:
            assigned = aliases.refined("_before", split.split_peaks(assigned.withColumn("_before", F.col("gmm_peak_alias")), settings), "sequence")
        assigned = cut(assigned.drop("read_qual"))
        sizes = _small(_child_sizes(assigned, frame, settings))
        windows = peaks.size_windows(sizes, settings.min_gmm_peak_distance, settings.itd_sd_factor, settings.min_itd_size, settings.max_itd_size)
        inserted = cut(insertions.extract_insertions(assigned.where("gmm_peak_alias <> 'WT'"), windows))
        modes = _small(insertions.length_modes(inserted.select("peak_alias", "ins_len"), "peak_alias", settings.min_haplotype_reads, settings.min_subpeak_fraction))
        if modes.groupBy("peak_alias").count().where("count > 1").count():
            assigned = cut(aliases.split_by_length(assigned, inserted, modes, settings))
            inserted = cut(aliases.follow(inserted, assigned))
        found = _small(consensus.peak_consensus(inserted, settings))
        unresolved = _small(inserted.select("peak_alias").distinct().join(F.broadcast(found), "peak_alias", "left_anti").withColumn("status", F.lit("no_resolved_consensus")))
        owners = consensus.merge_duplicates(found)
        found = found.join(F.broadcast(owners.where("peak_alias = owner").select("peak_alias")), "peak_alias", "left_semi")
        if not owners.where("peak_alias <> owner").isEmpty():
            assigned = aliases.merged(assigned, owners)
            inserted = aliases.follow(inserted, assigned)
        frame = _small(aliases.peak_table(frame, assigned, settings))
        reads = reads if not settings.validate_peak_reads_only else reads.join(parents.select("read_id"), "read_id", "left_semi")
    if audit is not None:
        found, audit = observed.add_observed(found, audit, settings)
        found = _small(found)
        audit = observed.annotate_candidates(audit, reads, assigned, unresolved, settings)
    references = consensus.reference_alleles(found, settings.genome)
    if found.isEmpty():
        return Result(spark.createDataFrame([], _EMPTY_SUMMARY), references, audit, frame, None, "no candidate allele", inserted, found, unresolved, assigned)
    validated = validation.competitive_validation(reads, references).cache()
    summary = quantify.allele_frequencies(validated, settings.min_allele_frequency)
    if audit is not None:
        audit = quantify.audit_status(audit, validated, summary)
    return Result(summary, references, audit, frame, validated, "", inserted, found, unresolved, assigned)


def mixed_consensus(found: DataFrame, most_minor: float = 0.15, most_unresolved: float = 0.05) -> DataFrame:
    """peak_alias, max_minor_fraction, n_fraction of consensus sequences that may stand for a mixture: a column with too
    heavy a second base, or too many unresolved bases."""
    unresolved = F.length(F.regexp_replace("consensus_seq", "[^N]", "")) / F.length("consensus_seq")
    return found.select("peak_alias", "max_minor_fraction", unresolved.alias("n_fraction")).where((F.col("max_minor_fraction") > most_minor) | (F.col("n_fraction") > most_unresolved))


def _small(rows: DataFrame, most: int = 4096) -> DataFrame:
    """The same rows, computed once: peaks, candidates and alleles are a handful, which a check bounds."""
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} rows where a handful of peaks was expected")
    return rows.sparkSession.createDataFrame(found, rows.schema)


def _child_sizes(assigned: DataFrame, frame: DataFrame, settings: Settings) -> DataFrame:
    """peak_alias, putative_itd_size, sd_bp of all aliases after splits: a child's from its own reads."""
    moments = assigned.groupBy(F.col("gmm_peak_alias").alias("peak_alias")).agg(F.avg("read_len").alias("mean"), F.stddev_pop("read_len").alias("sd"))
    wt = frame.where("is_wt").agg(F.coalesce(F.max("mean_bp"), F.lit(float(settings.wt_amplicon_length))).alias("wt_mean"))
    j = moments.join(F.broadcast(frame.select("peak_alias", "putative_itd_size", "sd_bp")), "peak_alias", "left").crossJoin(F.broadcast(wt))
    return j.select("peak_alias", F.coalesce("putative_itd_size", F.col("mean") - F.col("wt_mean")).alias("putative_itd_size"), F.coalesce("sd_bp", F.greatest("sd", F.lit(0.5))).alias("sd_bp"))
