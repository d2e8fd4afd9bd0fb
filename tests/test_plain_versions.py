"""Operators against plain versions of what they say."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandemlake.assay import WT
from tandemlake.operators import figures, validation
from tandemlake.operators.ranks import ranked


@pytest.mark.parametrize("n", [1, 2, 5])
def test_standings_equal_the_windows(spark, n):
    """Winner, runner-up and margins of the batch kernel are those of support_scores and rank_references over rows."""
    rng = np.random.default_rng(n)
    aliases = ["ITD_2", "WT", "ITD_1", "ITD_3", "ITD_9"][:n]
    scores = rng.random((60, n)).round(2)
    scores[:10] = 0.5  # ties
    s = validation.standings(scores, aliases)
    rows = [(i, a, float(v)) for i, row in enumerate(scores) for a, v in zip(aliases, row)]
    metric = "prob_score" if n == 2 else "z_score"
    best = validation.rank_references(validation.support_scores(spark.createDataFrame(rows, "read_id long, ref_alias string, score_used double")), metric)
    for r in best.collect():
        i = r.read_id
        assert aliases[s["first"][i]] == r.ref_alias and math.isclose(s["prob"][i], r.prob_score, abs_tol=1e-9) and math.isclose(s["metric"][i], r.metric_value, rel_tol=1e-6, abs_tol=1e-6)
        if n > 1:
            assert math.isclose(s["metric_second"][i], r.second_best_score, rel_tol=1e-6, abs_tol=1e-6) and math.isclose(s["prob"][i] - s["prob_second"][i], r.prob_delta, abs_tol=1e-9)
        else:
            assert s["second"][i] == -1 and r.second_best_ref is None


def test_ranks_of_a_hot_group(spark):
    """Places in groups, one of which has most rows, equal those of a sort."""
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.8 else rng.choice("ab"), rng.randrange(5), i) for i in range(2000)] + [(None, 1, -1), (None, 0, -2)]
    out = ranked(spark.createDataFrame(rows, "g string, x int, id long").repartition(7), "g", ["x", "id"]).collect()
    for g in {r[0] for r in rows}:
        want = [r for _, r in sorted((r[1:], r) for r in rows if r[0] == g)]
        got = sorted((r for r in out if r.g == g), key=lambda r: r._i)
        assert [(r.x, r.id) for r in got] == [r[1:] for r in want] and [r._i for r in got] == list(range(len(want))) and {r._n for r in got} == {len(want)}


def test_table_function_gives_the_rows_of_the_operator(spark):
    from tandemlake.functions import tables
    from tandemlake.operators.insertions import extract_insertions

    seqs = [WT, WT[:180] + WT[135:180] + WT[180:], WT[:120] + "ACGTACGTACGTAC" + WT[120:], WT[:50], ""]
    reads = spark.createDataFrame([(i, s, "+") for i, s in enumerate(seqs)] + [(9, None, "+")], "read_id long, read_seq string, strand string")
    tables.register(spark)
    got = spark.sql("SELECT read_id, i.* FROM {r}, LATERAL insertions_of(read_seq) i", r=reads)
    columns = ["read_id", "aln_score", "pct_identity", "ins_pos_ref", "ins_len", "ins_seq"]
    key = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    assert key(got) == key(extract_insertions(reads)) and got.count() >= 2


def test_alignment_text_and_differences(spark):
    from tandemlake.kernels.align import DISCOVERY, align_batch, gapped, render

    allele = WT[:180] + WT[135:180] + WT[180:]
    (a,) = align_batch(WT, [allele], DISCOVERY)
    top, bottom = gapped(WT, allele, a.blocks)
    assert top.replace("-", "") == WT and bottom.replace("-", "") == allele and len(top) == len(bottom) and top.count("-") == 45
    text = render(WT, allele, a.blocks, 60)
    assert "".join(line.split()[2] for line in text.splitlines() if line.startswith("query")) == bottom and text.count("|") == len(WT)
    rows = spark.createDataFrame([("A", 0, 60, "AC-GT"), ("A", 1, 30, "ACTGT"), ("A", 2, 10, "AC-GA")], "ref_alias string, rank int, n long, aligned string")
    got = figures.top_differences(rows, 2).collect()
    assert [(r.rank, r.shown) for r in got] == [(0, "....."), (1, "..T..")] and all(math.isclose(r.share, 0.4) for r in got)


def test_density_curve_and_gate(spark):
    rng = random.Random(2)
    rows = [("A", rng.choice([44, 45, 45, 46])) for _ in range(300)] + [("B", rng.choice([30, 33])) for _ in range(40)]
    df = spark.createDataFrame(rows, "peak_alias string, ins_len int")
    for r in figures.density_curve(df).collect():
        x = np.array([v for a, v in rows if a == r.peak_alias], float)
        h = x.std(ddof=1) * len(x) ** -0.2
        assert math.isclose(r.density, float(np.exp(-((r.x - x) ** 2) / (2 * h * h)).sum() / (len(x) * h * math.sqrt(2 * math.pi))), rel_tol=1e-9)
    assert figures.density_curve(df.unionByName(spark.createDataFrame([("C", 20)] * 3, "peak_alias string, ins_len int"))).count() == 0


def test_names_of_children_that_are_taken(spark):
    from tandemlake.operators.insertions import cluster_guardrails

    rows = [("ITD_1", i, "a" if i < 60 else "b") for i in range(100)]
    out = cluster_guardrails(spark.createDataFrame(rows, "parent string, read_id long, label string"), 20, 0.15, ["ITD_1", "ITD_1_H1", "ITD_1_H1_2"]).orderBy(F.desc("n")).collect()
    assert [r.child for r in out] == ["ITD_1_H1_3", "ITD_1_H2"]


def test_exact_calls_shuffle_counts_and_not_reads(spark, tmp_path):
    """However many reads have a sequence, what is shuffled for it are rows of counts; and no read's id is."""
    from tandemlake.assay import WT, Settings
    from tandemlake.plans.pipeline import exact_calls

    allele = WT[:180] + WT[135:180] + WT[180:]
    rows = [(i, allele if i % 4 == 0 else WT, "+-"[i % 3 == 0], "I" * (381 if i % 4 == 0 else 336)) for i in range(1200)]
    reads = spark.createDataFrame(rows, "read_id long, read_seq string, strand string, read_qual string")
    calls = exact_calls(reads, Settings(), 0.01)
    found = calls.collect()
    assert [(r.n_itd_reads, r.n_total_reads, r.plus_reads, r.minus_reads) for r in found] == [(300, 1200, 200, 100)]
    plan = calls._jdf.queryExecution().optimizedPlan().toString()
    assert "read_id" not in "".join(x for x in plan.splitlines() if "Join" in x or "Aggregate" in x)


def test_split_and_peak_table_pass_over_the_reads_three_times(spark):
    """Once for unique sequences, once for the clusters' counts and once for the peaks' moments, whatever the peaks."""
    from tandemlake.assay import Settings
    from tandemlake.operators import aliases, peaks
    from tandemlake.operators.split import split_peaks

    a, b = WT[:180] + WT[135:180] + WT[180:], WT[:120] + WT[75:120] + WT[120:]
    rows = [(i, s, "I" * len(s), len(s), p) for i, (s, p) in enumerate([(WT, "WT")] * 200 + [(a, "ITD_1")] * 120 + [(b, "ITD_1")] * 80)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for t in batches:
            seen.add(len(t))
            yield t

    reads = spark.createDataFrame(rows, "read_id long, read_seq string, read_qual string, read_len int, gmm_peak_alias string").repartition(2)
    reads = aliases.begin(reads.mapInPandas(count, reads.schema))
    frame = peaks.peaks_frame(spark, [{"alias": p, "mean_bp": m, "sd_bp": 1.0, "fraction": 0.5, "effective_read_count": 200, "putative_itd_size": m - 336.0, "is_wt": p == "WT"} for p, m in (("WT", 336.0), ("ITD_1", 381.0))])
    split = aliases.refined("_before", split_peaks(reads.withColumn("_before", F.col("gmm_peak_alias")), Settings()), "sequence")
    table = aliases.peak_table(frame, split, Settings()).collect()
    assert [(r.peak_alias, r.effective_read_count, r.putative_itd_size) for r in table] == [("WT", 200, 0.0), ("ITD_1_H1", 120, 45.0), ("ITD_1_H2", 80, 45.0)]
    assert seen.value <= 3 * len(rows)


def test_derived_reads_use_all_cores(spark):
    from tandemlake.fixtures import noisy_reads, reads

    for of in (reads, noisy_reads):
        assert of(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_pipeline_sums_qualities_once_and_counts_support_in_one_pass(spark):
    from tandemlake.assay import Settings
    from tandemlake.functions import sequence as S
    from tandemlake.operators import observed, quantify

    reads = spark.createDataFrame([(1, WT, "+", "I" * 336)], "read_id long, read_seq string, strand string, read_qual string")
    assert observed.discover(reads, Settings())._jdf.queryExecution().optimizedPlan().toString().count("mean_quality(") == 1
    quals = ["I5+", None, "", "~", "!!", "é5"]
    got = [r.m for r in spark.createDataFrame([(q,) for q in quals], "q string").coalesce(1).select(S.mean_quality(F.col("q")).alias("m")).collect()]
    assert got == [(sum(q.encode()) - 33 * len(q)) / len(q) if q else None for q in quals]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for t in batches:
            seen.add(len(t))
            yield t

    rows = [(i, "+-"[i % 2], a, f"{a[:3]}-supporting", "pass", True) for i, a in enumerate(["WT"] * 60 + ["ITD"] * 40)]
    table = spark.createDataFrame(rows, "read_id long, strand string, ref_alias string, support_call string, filter_reason string, valid_support boolean").repartition(2)
    calls = quantify.allele_frequencies(table.mapInPandas(count, table.schema)).collect()
    assert [(r.ref_alias, r.n_itd_reads, r.n_total_reads, r.plus_reads, r.minus_reads) for r in calls] == [("ITD", 40, 100, 20, 20)]
    assert seen.value == len(rows)
