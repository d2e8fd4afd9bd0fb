"""Observed haplotypes: exact recurrence between two located anchors, fully relational."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandemlake.assay import WT, Settings, anchor_coordinates
from tandemlake.functions import sequence as S
from tandemlake.kernels import anchors
from tandemlake.kernels.msa import boundary_interval
from tandemlake.operators.reads import distinct_sequences


_PAIR = T.StructType([T.StructField("outcome", T.StringType()), *[T.StructField(c, T.IntegerType()) for c in ("x", "y", "lm", "rm")]])
_PLACE = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("identity", T.DoubleType())])


def locate_anchors(sequences: DataFrame, settings: Settings, ref: str = WT) -> DataFrame:
    """Adds outcome, x, y (left and right anchor) and their mismatches lm, rm to distinct sequences (column seq)."""
    start, stop = anchor_coordinates(len(ref), settings.anchor_length, settings.anchor_shift)
    n, k = settings.anchor_length, settings.anchor_max_mismatches
    left, right = ref[start : start + n], ref[stop - n : stop]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([anchors.locate(s, left, right, k) for s in batch["seq"]], columns=["outcome", "x", "y", "lm", "rm"], index=batch.index)
            yield pd.concat([batch, found.astype({c: "Int32" for c in ("x", "y", "lm", "rm")})], axis=1)

    # a batch function, not an expression: as one, the optimiser would copy tests of its result to the reads that join it
    return sequences.mapInPandas(run, T.StructType([*sequences.schema, *_PAIR]))


def anchored_windows(reads: DataFrame, settings: Settings, ref: str = WT) -> DataFrame:
    """Per read: read_id, strand, mean_q, outcome, window (anchors as in the reference, interior as read), net, lm, rm.

    Anchors are located once for each distinct sequence."""
    rows = reads.select("read_id", "strand", F.upper("read_seq").alias("seq"), S.mean_quality(F.col("read_qual")).alias("mean_q"))
    return rows.join(_windows(rows, settings, ref), "seq")


def _windows(rows: DataFrame, settings: Settings, ref: str) -> DataFrame:
    """The distinct sequences (seq) of rows with their anchors' outcome, window and net."""
    start, stop = anchor_coordinates(len(ref), settings.anchor_length, settings.anchor_shift)
    n = settings.anchor_length
    located = locate_anchors(distinct_sequences(rows, "seq"), settings, ref)
    interior = S.mid(F.col("seq"), F.col("x") + n, F.col("y") - F.col("x") - n)
    located = located.withColumn("window", F.when(F.col("outcome") == "anchored", F.concat(F.lit(ref[start : start + n]), interior, F.lit(ref[stop - n : stop]))))
    return located.withColumn("net", F.length("window") - (stop - start))


def discover(reads: DataFrame, settings: Settings, ref: str = WT) -> DataFrame:
    """The audit: a row for each positive window with its support, status and, if a pure insertion explains it, the
    insertion's boundary, sequence and duplication identity.

    Reads are counted by sequence, strand and mean quality before they are shuffled, so a sequence that most reads have is a
    few rows; a median is selected from the counts of a window's distinct qualities, which partial aggregates merge."""
    start, stop = anchor_coordinates(len(ref), settings.anchor_length, settings.anchor_shift)
    n = settings.anchor_length
    counted = reads.groupBy(F.upper("read_seq").alias("seq"), "strand", S.mean_quality(F.col("read_qual")).alias("mean_q")).agg(F.count("*").alias("n"))
    found = _windows(counted, settings, ref).where((F.col("net") > 0) & (F.col("net") <= settings.max_itd_size))
    windows = counted.join(found, "seq")
    changed = F.col("lm") + F.col("rm") > 0
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    audit = windows.groupBy("window", F.col("net").alias("net_size")).agg(
        F.sum("n").alias("exact_reads"), total(F.col("strand") == "+").alias("plus"), F.coalesce(F.percentile("mean_q", F.lit(0.5), F.col("n")), F.lit(0.0)).alias("median_q"), total(~changed).alias("exact_flank_reads"),
        total(changed).alias("normalized_flank_reads"), F.sum(F.col("lm") * F.col("n")).alias("left_anchor_substitutions"), F.sum(F.col("rm") * F.col("n")).alias("right_anchor_substitutions"), F.max("lm").alias("max_left_anchor_substitutions"), F.max("rm").alias("max_right_anchor_substitutions"),
    )
    audit = audit.withColumns({"minus": F.col("exact_reads") - F.col("plus"), "allele": F.concat(F.lit(ref[:start]), "window", F.lit(ref[stop:]))})
    audit = audit.withColumn("allele_id", S.allele_id(F.col("allele")))

    # every boundary of the interval writes the same allele; the one of the best adjacent copy, then the least, is reported
    @F.pandas_udf(_PLACE)
    def decompose(alleles: pd.Series) -> pd.DataFrame:
        rows = []
        for a in alleles:
            low, high = boundary_interval(a, ref)
            low, high = max(low, start + n), min(high, stop - n)
            rows.append(anchors.place(ref, a, low, high) if low <= high else (None, None))
        return pd.DataFrame(rows, columns=["pos", "identity"]).astype({"pos": "Int32", "identity": "Float64"})

    audit = audit.withColumn("_best", decompose("allele"))
    status = (
        F.when(F.col("net_size") < settings.min_itd_size, "below_min_size").when(~S.is_resolved(F.col("window")), "unresolved_bases").when(F.col("exact_reads") < settings.min_observed_reads, "insufficient_recurrence")
        .when(F.least("plus", "minus") < 2, "insufficient_strand_support").when(F.col("median_q") < 20, "low_quality").when(F.col("_best.pos").isNull(), "not_single_complete_insertion").otherwise("eligible")
    )
    audit = audit.withColumn("status", status)
    good = F.col("status") == "eligible"
    audit = audit.withColumns({"duplication_identity": F.when(good, F.col("_best.identity")), "insertion_pos": F.when(good, F.col("_best.pos"))})
    return audit.withColumn("insertion_seq", S.mid(F.col("allele"), F.col("insertion_pos"), F.col("net_size"))).drop("_best")


def sequence_alternatives(candidates: DataFrame) -> DataFrame:
    """allele_id, alternatives: other candidates of one length that differ in at most one base, comma-joined.

    Such a pair has the first or the second half in common, so only alleles that share a half are compared."""
    size = F.length("allele")
    middle = F.floor(size / 2).cast("int")
    halves = F.array(F.struct(F.lit(0).alias("side"), S.head(F.col("allele"), middle).alias("half")), F.struct(F.lit(1).alias("side"), S.tail(F.col("allele"), middle).alias("half")))
    keyed = candidates.select("allele_id", "allele", size.alias("size"), F.explode(halves).alias("h")).select("allele_id", "allele", "size", "h.side", "h.half")
    a, b = keyed.alias("a"), keyed.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("size", "side", "half")]
    near = (F.col("a.allele_id") != F.col("b.allele_id")) & (F.levenshtein(F.col("a.allele"), F.col("b.allele"), 1) >= 0)
    pairs = a.join(b, [*same, near]).select(F.col("a.allele_id").alias("allele_id"), F.col("b.allele_id").alias("other")).distinct()
    found = pairs.groupBy("allele_id").agg(F.array_join(F.array_sort(F.collect_list("other")), ",").alias("alternatives"))
    return candidates.select("allele_id").join(found, "allele_id", "left").select("allele_id", F.coalesce("alternatives", F.lit("")).alias("alternatives"))


#: Statuses of candidates that were eligible before add_observed.
_CANDIDATES = ("eligible", "existing_candidate", "added_for_competition", "candidate_cap")


def annotate_candidates(audit: DataFrame, reads: DataFrame, assigned: DataFrame | None, unresolved: DataFrame | None, settings: Settings, ref: str = WT) -> DataFrame:
    """The audit with, for each candidate: source_assignments (peaks of the reads that show it, as alias:reads by alias,
    None for reads of no peak), failed_consensus_exact_reads (those of peaks without a consensus), sequence_alternatives and
    a note. assigned: read_id, gmm_peak_alias; unresolved: peak_alias."""
    candidates = audit.where(F.col("status").isin(*_CANDIDATES)).select("allele_id", "allele", "window")
    members = anchored_windows(reads, settings, ref).join(F.broadcast(candidates.select("allele_id", "window")), "window").select("allele_id", "read_id")
    if assigned is None:
        members = members.withColumn("alias", F.lit("None"))
    else:
        members = members.join(assigned.select("read_id", F.col("gmm_peak_alias").alias("alias")), "read_id", "left").withColumn("alias", F.coalesce("alias", F.lit("None")))
    by_alias = members.groupBy("allele_id", "alias").agg(F.count("*").alias("n"))
    failed = by_alias.withColumn("failed", F.lit(False))
    if unresolved is not None:
        failed = by_alias.join(F.broadcast(unresolved.select(F.col("peak_alias").alias("alias"), F.lit(True).alias("failed"))), "alias", "left")
    entry = F.array_sort(F.collect_list(F.struct("alias", F.concat_ws(":", "alias", F.col("n").cast("string")).alias("text"))))
    sources = failed.groupBy("allele_id").agg(F.array_join(entry["text"], ";").alias("source_assignments"), F.sum(F.when(F.col("failed"), F.col("n")).otherwise(0)).alias("failed_consensus_exact_reads"))
    other = sequence_alternatives(candidates).withColumnRenamed("alternatives", "sequence_alternatives")
    out = audit.join(F.broadcast(sources), "allele_id", "left").join(F.broadcast(other), "allele_id", "left")
    kind = F.when(F.col("sequence_alternatives") != "", "alternatives of one base were seen; separate clones are not shown").otherwise("recurrent interior sequence, found without length peaks")
    flanks = F.format_string("; anchors corrected to the reference in %d of %d reads; adjacent duplication identity %.1f%%", F.col("normalized_flank_reads"), F.col("exact_reads"), F.col("duplication_identity") * 100)
    return out.withColumn("note", F.when(F.col("sequence_alternatives").isNotNull(), F.concat(kind, flanks)))


def add_observed(consensus: DataFrame, audit: DataFrame, settings: Settings, ref: str = WT) -> tuple[DataFrame, DataFrame]:
    """Consensus rows with the strongest new eligible alleles appended up to the cap, and the audit with final statuses."""
    from pyspark.sql.window import Window

    known = consensus.select(S.reconstruct_allele(F.lit(ref), F.col("consensus_ins_pos_ref"), F.col("consensus_seq")).alias("allele"), F.col("peak_alias").alias("known_alias")).groupBy("allele").agg(F.min("known_alias").alias("known_alias"))
    room = consensus.agg(F.greatest(F.lit(settings.max_itds) - F.count("*"), F.lit(0)).alias("room"))
    eligible = audit.where("status = 'eligible'").join(F.broadcast(known), "allele", "left")
    fresh = eligible.where("known_alias is null").withColumn("_rank", F.row_number().over(Window.orderBy(F.desc("exact_reads"), "window")))
    fresh = fresh.crossJoin(F.broadcast(room)).withColumn("final", F.when(F.col("_rank") <= F.col("room"), "added_for_competition").otherwise("candidate_cap"))
    alias = F.concat(F.lit("ITD_OBS_"), "allele_id")
    added = fresh.where("final = 'added_for_competition'").select(
        alias.alias("peak_alias"), F.col("insertion_seq").alias("consensus_seq"), F.col("net_size").alias("consensus_len"), F.col("insertion_pos").alias("consensus_ins_pos_ref"), F.col("exact_reads").alias("n_total_reads"),
        F.lit(1).cast("long").alias("n_unique"), F.lit(0.0).alias("max_minor_fraction"), "duplication_identity", "normalized_flank_reads",
    )
    final = fresh.select("allele_id", "final", F.when(F.col("final") == "added_for_competition", alias).alias("peak_alias")).union(eligible.where("known_alias is not null").select("allele_id", F.lit("existing_candidate"), "known_alias"))
    logged = audit.join(final, "allele_id", "left").withColumn("status", F.coalesce("final", "status")).drop("final")
    return consensus.unionByName(added, allowMissingColumns=True), logged
