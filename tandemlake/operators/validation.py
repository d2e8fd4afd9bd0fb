"""Competitive validation: every read against every reference allele, winner, margin and breakpoints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tandemlake.functions import sequence as S
from tandemlake.kernels.align import VALIDATION, align_batch
from tandemlake.operators.reads import distinct_sequences

BETA = 500.0
EPSILON = 1e-8


def support_scores(scores: DataFrame, beta: float = BETA) -> DataFrame:
    """Adds prob_score (softmax of score_used over a read's references) and z_score to rows read_id, ref_alias, score_used."""
    w = Window.partitionBy("read_id")
    e = F.exp(beta * (F.col("score_used") - F.max("score_used").over(w)))
    scored = scores.withColumn("_e", e).withColumn("prob_score", F.col("_e") / (F.sum("_e").over(w) + EPSILON)).drop("_e")
    return scored.withColumn("z_score", (F.col("prob_score") - F.avg("prob_score").over(w)) / (F.stddev_pop("prob_score").over(w) + EPSILON))


def rank_references(scored: DataFrame, metric: str) -> DataFrame:
    """The best reference of each read with its runner-up; ties go to the wild type, then to the lesser alias."""
    w = Window.partitionBy("read_id").orderBy(F.desc(metric), F.when(F.col("ref_alias") == "WT", 0).otherwise(1), "ref_alias")
    ranked = scored.withColumns({
        "_rank": F.row_number().over(w), "second_best_ref": F.lead("ref_alias").over(w), "second_best_score": F.lead(metric).over(w), "prob_score_second": F.lead("prob_score").over(w),
    })
    best = ranked.where("_rank = 1").drop("_rank")
    return best.withColumns({"metric_value": F.col(metric), "delta": F.col(metric) - F.col("second_best_score"), "prob_delta": F.col("prob_score") - F.col("prob_score_second")})


def classify_support(binary: bool, z: float = 1.0, margin: float = 0.05) -> Column:
    """ITD-supporting, WT-supporting or Ambiguous, from delta (two references) or z-score and probability margin."""
    itd = F.when(F.col("ref_alias").contains("ITD"), "ITD-supporting").otherwise("WT-supporting")
    other = F.when(F.col("ref_alias").startswith("ITD"), "WT-supporting").otherwise("ITD-supporting")
    if binary:
        return F.when(F.col("delta") >= margin, itd).when(F.col("delta") <= -margin, other).otherwise("Ambiguous")
    return F.when((F.col("metric_value") >= z) & (F.col("prob_delta") >= margin), itd).otherwise("Ambiguous")


def breakpoint_reason(gap_window: int = 15, max_gap: int = 5, min_pid: float = 0.9, max_wt_gap: int = 10) -> Column:
    """pass or why not, from blocks, pct_identity, ref_alias, ins_pos and itd_len (null: no consensus)."""
    low, high = F.col("ins_pos") - gap_window, F.col("ins_pos") + F.col("itd_len") + gap_window
    blocks = F.col("blocks")
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(blocks) - 2, F.lit(0))), lambda i: F.struct(F.get(blocks, i).alias("a"), F.get(blocks, i + 1).alias("b")))
    near = F.filter(pairs, lambda p: p.b.isNotNull() & (p.a.t1 <= high) & (p.b.t0 >= low))
    gaps = F.aggregate(near, F.lit(0), lambda acc, p: acc + (p.b.t0 - p.a.t1) + (p.b.q0 - p.a.q1))
    inserted = F.aggregate(S.insertion_blocks(blocks), F.lit(0), lambda acc, g: acc + g["size"])
    low_pid = F.concat(F.lit("low_pid("), F.format_string("%.2f", F.col("pct_identity")), F.lit(")"))
    wt = F.when(F.col("pct_identity") < min_pid, low_pid).when(inserted > max_wt_gap, F.concat(F.lit("wt_with_gaps("), inserted.cast("string"), F.lit(" bp)"))).otherwise("pass")
    itd = F.when(F.col("pct_identity") < min_pid, low_pid).when(gaps > max_gap, F.concat(F.lit("too_many_gaps("), gaps.cast("string"), F.lit(")"))).otherwise("pass")
    missing = F.lit("missing_alignment_blocks")
    return (
        F.when(F.col("ref_alias") == "WT", F.when(blocks.isNull(), missing).otherwise(wt)).when(F.col("ref_alias").startswith("ITD"), F.when(F.col("ins_pos").isNull(), "missing_insertion_position").when(blocks.isNull(), missing).otherwise(itd))
        .otherwise(F.concat(F.lit("unknown_alias:"), F.col("ref_alias")))
    )


_BLOCKS = "array<struct<t0:int,t1:int,q0:int,q1:int>>"
_STANDINGS = f"seq string, ref_alias string, score double, pct_identity double, span_identity double, adjusted_score double, blocks {_BLOCKS}, score_used double, prob_score double, second_best_ref string, second_best_score double, prob_score_second double, metric_value double, delta double, prob_delta double"


def standings(scores: np.ndarray, aliases: list[str], beta: float = BETA) -> dict[str, np.ndarray]:
    """What support_scores and rank_references say of a batch at once: scores has a row for each sequence and a column for
    each reference. Winner and runner-up (columns; -1 without one), and the softmax and the metric of both."""
    rows, n = scores.shape
    e = np.exp(beta * (scores - scores.max(1, keepdims=True)))
    p = e / (e.sum(1, keepdims=True) + EPSILON)
    metric = p if n == 2 else (p - p.mean(1, keepdims=True)) / (p.std(1, keepdims=True) + EPSILON)
    # ties go to the wild type, then to the lesser alias: the first column of the best
    order = np.array(sorted(range(n), key=lambda i: (aliases[i] != "WT", aliases[i])))
    at = np.arange(rows)
    first = order[metric[:, order].argmax(1)]
    rest = metric.copy()
    rest[at, first] = -np.inf
    second = order[rest[:, order].argmax(1)] if n > 1 else np.full(rows, -1)
    none = np.full(rows, np.nan)
    return {"first": first, "second": second, "prob": p[at, first], "prob_second": p[at, second] if n > 1 else none, "metric": metric[at, first], "metric_second": metric[at, second] if n > 1 else none}


def align_to_references(reads: DataFrame, references: DataFrame, alpha: float = 2.0, beta: float = BETA) -> DataFrame:
    """One row for each distinct read sequence: the reference that wins, with its alignment (score, identities, blocks), its
    softmax and metric, and the runner-up's. A sequence meets all references in one task, so nothing is ranked by a shuffle.
    References are at most seven rows, which a check bounds, collected and sent with the function."""
    refs = [(r.ref_alias, r.ref_seq) for r in references.select("ref_alias", "ref_seq").orderBy("ref_alias").limit(65).collect()]
    if len(refs) > 64:
        raise ValueError("competitive validation takes at most 64 references")
    aliases = [alias for alias, _ in refs]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seqs = batch["seq"].tolist()
            found = [align_batch(ref, seqs, VALIDATION) for _, ref in refs]
            lengths = np.array([len(s) for s in seqs])
            span, used = np.zeros((2, len(seqs), len(refs)))
            for k, (_, ref) in enumerate(refs):
                aligned = np.array([a.aligned or 1 for a in found[k]])
                span[:, k] = np.array([a.matches for a in found[k]]) / np.maximum(np.maximum(lengths, len(ref)), 1)
                used[:, k] = np.maximum(0.0, (span[:, k] - alpha * np.array([a.inserted for a in found[k]]) / aligned) * (aligned / len(ref)))
            s = standings(used, aliases, beta)
            won = [found[k][i] for i, k in enumerate(s["first"].tolist())]
            at = np.arange(len(seqs))
            yield pd.DataFrame({
                "seq": seqs, "ref_alias": [aliases[k] for k in s["first"]], "score": [a.score / 100 for a in won], "pct_identity": [a.matches / a.aligned if a.aligned else 0.0 for a in won],
                "span_identity": span[at, s["first"]], "adjusted_score": used[at, s["first"]], "blocks": [[dict(zip(("t0", "t1", "q0", "q1"), b, strict=True)) for b in a.blocks] for a in won], "score_used": used[at, s["first"]],
                "prob_score": s["prob"], "second_best_ref": [aliases[k] if k >= 0 else None for k in s["second"]], "second_best_score": s["metric_second"], "prob_score_second": s["prob_second"],
                "metric_value": s["metric"], "delta": s["metric"] - s["metric_second"], "prob_delta": s["prob"] - s["prob_second"],
            })

    rows = distinct_sequences(reads).mapInPandas(run, _STANDINGS)
    missing = ("second_best_score", "prob_score_second", "delta", "prob_delta")
    return rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in missing}) if len(refs) == 1 else rows


def competitive_validation(reads: DataFrame, references: DataFrame) -> DataFrame:
    """One row for each read: its winner, margins, support_call, valid_support and filter_reason. Everything but the join
    back to reads is done once for each distinct sequence, in the task that aligns it; blocks don't leave it."""
    n = references.count()
    best = align_to_references(reads, references).withColumn("metric_type", F.lit("prob_delta" if n == 2 else "z_score")).withColumn("support_call", classify_support(n == 2))
    known = references.where("ref_alias <> 'WT'").select("ref_alias", F.col("local_pos").alias("ins_pos"), "itd_len")
    best = best.join(F.broadcast(known), "ref_alias", "left").withColumn("filter_reason", breakpoint_reason()).withColumn("valid_support", F.col("filter_reason") == "pass")
    return reads.select("read_id", "strand", F.col("read_seq").alias("seq"), F.length("read_seq").alias("read_len")).join(best.drop("blocks", "ins_pos", "itd_len"), "seq").drop("seq")
