"""Allele frequencies, strand bias, reporting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tandemlake.functions.statistics import fisher
from tandemlake.operators.lineage import cut


def final_support(validation: DataFrame) -> DataFrame:
    return validation.where((F.col("valid_support")) & (F.col("filter_reason") == "pass") & F.col("support_call").isin("ITD-supporting", "WT-supporting"))


def strand_counts(support: DataFrame, *more: Column) -> DataFrame:
    """ref_alias, n_reads (distinct), plus_reads, minus_reads, and aggregates that are added."""
    return support.groupBy("ref_alias").agg(F.countDistinct("read_id").alias("n_reads"), F.count_if(F.col("strand") == "+").alias("plus_reads"), F.count_if(F.col("strand") == "-").alias("minus_reads"), *more)


def allele_frequencies(validation: DataFrame, min_af: float = 0.05) -> DataFrame:
    """ref_alias, n_itd_reads, n_total_reads (all final support), allele_frequency, plus_reads, minus_reads, strand_ratio,
    odds_ratio, fisher_p of each ITD at or above min_af."""
    support = final_support(validation)
    # a row for each reference, from one pass over the reads
    counts = cut(strand_counts(support, F.count("*").alias("_rows")))
    return frequencies(counts.drop("_rows"), counts.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_total_reads")), min_af)


def frequencies(counts: DataFrame, total: DataFrame, min_af: float) -> DataFrame:
    """The same from strand_counts and the one row n_total_reads."""
    wt = counts.where("ref_alias = 'WT'").agg(F.coalesce(F.sum("plus_reads"), F.lit(0)).alias("wt_plus"), F.coalesce(F.sum("minus_reads"), F.lit(0)).alias("wt_minus"))
    rows = counts.where("ref_alias <> 'WT'").crossJoin(F.broadcast(total)).crossJoin(F.broadcast(wt)).withColumn("allele_frequency", F.col("n_reads") / F.col("n_total_reads")).where(F.col("allele_frequency") >= min_af)
    rows = rows.withColumn("f", fisher("plus_reads", "minus_reads", "wt_plus", "wt_minus"))
    ratio = F.col("plus_reads") / F.nullif(F.col("plus_reads") + F.col("minus_reads"), F.lit(0))
    return rows.select("ref_alias", F.col("n_reads").alias("n_itd_reads"), "n_total_reads", "allele_frequency", "plus_reads", "minus_reads", ratio.alias("strand_ratio"), "f.odds_ratio", "f.fisher_p").orderBy(F.desc("allele_frequency"), "ref_alias")


def strand_bias_flag(min_fold: float = 3.0, max_p: float = 0.05) -> Column:
    """Nearly all reads on one strand, or a significant odds ratio of at least min_fold either way."""
    share = F.col("plus_reads") / F.nullif(F.col("plus_reads") + F.col("minus_reads"), F.lit(0))
    odds = F.col("odds_ratio")
    far = (odds >= min_fold) | (odds <= 1 / min_fold)
    return F.coalesce((share <= 0.05) | (share >= 0.95) | ((F.col("fisher_p") <= max_p) & far), F.lit(False))


def audit_status(audit: DataFrame, validation: DataFrame, reported: DataFrame) -> DataFrame:
    """The audit with validated_reads, reported and final_status of candidates that competed."""
    counts = final_support(validation).where("support_call = 'ITD-supporting'").groupBy(F.col("ref_alias").alias("peak_alias")).agg(F.countDistinct("read_id").alias("_n"))
    named = reported.select(F.col("ref_alias").alias("peak_alias"), F.lit(True).alias("_r")).distinct()
    j = audit.join(F.broadcast(counts), "peak_alias", "left").join(F.broadcast(named), "peak_alias", "left")
    ran = F.col("peak_alias").isNotNull()
    status = F.when(F.col("_r"), "reported").when(F.col("_n") > 0, "below_reporting_af").otherwise("no_validated_support")
    return j.withColumns({"validated_reads": F.when(ran, F.coalesce("_n", F.lit(0))), "reported": F.when(ran, F.coalesce("_r", F.lit(False))), "final_status": F.when(ran, status)}).drop("_n", "_r")


def final_profiles(validation: DataFrame, reported: DataFrame) -> DataFrame:
    """ref_alias, read_len, n of the reads that support each reported call."""
    support = final_support(validation).join(F.broadcast(reported.select("ref_alias").distinct()), "ref_alias", "left_semi")
    return support.groupBy("ref_alias", "read_len").agg(F.countDistinct("read_id").alias("n"))


def final_support_lengths(validation: DataFrame, reads: DataFrame, summary: DataFrame) -> DataFrame:
    """ref_alias, read_id, read_len of the reads behind each reported call. Raises ValueError if a read appears twice, has
    no length, or a call's reads aren't as many as reported."""
    support = final_support(validation).join(F.broadcast(summary.select("ref_alias", "n_itd_reads")), "ref_alias").select("ref_alias", "read_id", "n_itd_reads")
    joined = support.join(reads.select("read_id", F.length("read_seq").alias("read_len")), "read_id", "left")
    bad = joined.groupBy("ref_alias").agg(F.count("*").alias("n"), F.countDistinct("read_id").alias("ids"), F.count_if(F.col("read_len").isNull()).alias("missing"), F.max("n_itd_reads").alias("reported"))
    wrong = bad.where("n <> ids or missing > 0 or n <> reported").limit(5).collect()
    if wrong:
        raise ValueError(f"final support does not agree with the reported calls: {wrong}")
    return joined.select("ref_alias", "read_id", "read_len")


def display_labels(calls: DataFrame) -> DataFrame:
    """Adds label: size, with a letter where several calls have it."""
    w = Window.partitionBy("itd_len")
    letter = F.when(F.count("*").over(w) > 1, F.char(F.lit(64) + F.row_number().over(w.orderBy("ref_alias")))).otherwise("")
    return calls.withColumn("label", F.concat(F.col("itd_len").cast("string"), F.lit(" bp"), F.when(letter != "", F.concat(F.lit(" "), letter)).otherwise("")))


def cluster_agreement(pairs: DataFrame) -> DataFrame:
    """n, ari, homogeneity, completeness of rows (truth, label)."""
    cells = pairs.groupBy("truth", "label").agg(F.count("*").cast("double").alias("c"))
    by = lambda k: cells.groupBy(k).agg(F.sum("c").alias("s"))
    two = lambda x: F.sum(F.col(x) * (F.col(x) - 1) / 2)
    ent = lambda x: F.sum(F.col(x) * F.log(F.col(x)))
    c = cells.agg(F.sum("c").alias("n"), two("c").alias("pc"), ent("c").alias("hc"))
    t = by("truth").agg(two("s").alias("pt"), ent("s").alias("ht"))
    p = by("label").agg(two("s").alias("pl"), ent("s").alias("hl"))
    j = c.crossJoin(F.broadcast(t)).crossJoin(F.broadcast(p))
    pairs_ = F.col("n") * (F.col("n") - 1) / 2
    expected = F.col("pt") * F.col("pl") / pairs_
    top = (F.col("pt") + F.col("pl")) / 2 - expected
    n = F.col("n")
    h_t, h_l, h_both = F.log(n) - F.col("ht") / n, F.log(n) - F.col("hl") / n, F.log(n) - F.col("hc") / n
    part = lambda h, other: F.when(h <= 1e-12, F.lit(1.0)).otherwise(1 - (h_both - other) / h)
    return j.select(n.cast("long").alias("n"), F.when(top == 0, F.lit(1.0)).otherwise((F.col("pc") - expected) / top).alias("ari"), part(h_t, h_l).alias("homogeneity"), part(h_l, h_t).alias("completeness"))
