"""From a simulated BAM file to matched calls."""

import json

import pytest
from pyspark.sql import functions as F

from tandemlake.__main__ import run_sample
from tandemlake.assay import WT, Settings, reverse_complement
from tandemlake.functions import sequence as S
from tandemlake.plans import pipeline
from tandemlake.plans.evaluate import SCENARIOS, Haplotype, match_calls, same_itd, simulate
from tandemlake.sources.bam import write_bam
from tandemlake.sources.sinks import read_tsv, read_vcf


def test_simulated_sample(spark, tmp_path):
    rows = simulate(spark, "C", 600, seed=7).collect()
    assert {r.haplotype for r in rows} == {"WT", "ITD_A", "ITD_B"}
    records = []
    for r in rows:
        back = r.strand == "-"
        seq, qual = (reverse_complement(r.read_seq), r.read_qual[::-1]) if back else (r.read_seq, r.read_qual)
        records.append((f"r{r.read_id}", 16 if back else 0, 0, 28033881, 60, [(len(seq), "M")], seq, qual))
    path = str(tmp_path / "s.bam")
    write_bam(path, [("chr13", 114364328)], records)
    n = run_sample(spark, path, str(tmp_path / "out"), "s", Settings())
    calls = [(str(c.pos), c.inserted, c.pos - 28033880, float(c.info["AF"])) for c in read_vcf(spark, str(tmp_path / "out/s.vcf")).collect()]
    truth = [(h.name, h.inserted, h.pos, h.share) for h in SCENARIOS["C"] if h.size]
    found, _ = match_calls(truth, calls)
    assert n >= 1 and "ITD_A" in found
    assert abs(next(c[3] for c in calls if c[0] == found["ITD_A"]) - 0.32) < 0.08
    assert (tmp_path / "out/s.html").exists()
    support = read_tsv(spark, str(tmp_path / "out/read_support"))
    assert support.count() > 0 and {"read_id", "ref_alias", "valid_support"} <= set(support.columns)
    assert read_tsv(spark, str(tmp_path / "out/insertions")).count() > 0 and read_tsv(spark, str(tmp_path / "out/consensus")).count() >= 1
    assert (tmp_path / "out/unresolved_consensus").exists()
    # the figures' data: shares of all peaks sum to 1, children have theirs in the VCF, alignments and members of each call
    peaks = read_tsv(spark, str(tmp_path / "out/peaks")).collect()
    assert abs(sum(p.fraction for p in peaks) - 1) < 1e-6 and sum(p.effective_read_count for p in peaks) > 0
    found_calls = read_vcf(spark, str(tmp_path / "out/s.vcf")).collect()
    assert any(c.info["AF_GMM"] != "." for c in found_calls)
    labels = read_tsv(spark, str(tmp_path / "out/reported_calls")).collect()
    assert len(labels) == n and all(r.label.startswith(f"{r.itd_len} bp") for r in labels)
    texts = [p.read_text() for p in (tmp_path / "out").glob("alignment_*.txt")]
    assert len(texts) == n and all("target" in t and "|||" in t and "---" in t for t in texts)
    members = spark.read.json(str(tmp_path / "out/membership")).groupBy("ref_alias").count().collect()
    assert {r.ref_alias: r["count"] for r in members} == {r.ref_alias: r.n_itd_reads for r in labels}
    for name in ("length_profile", "insertion_sizes", "insertion_density", "pileup", "support_lengths", "support_alignment", "column_agreement", "allele_differences", "genome_view"):
        assert read_tsv(spark, str(tmp_path / "out" / name)).count() > 0, name
    stages = [json.loads(x) for x in (tmp_path / "out/stages.jsonl").read_text().splitlines()]
    assert next(x for x in stages if x["stage"] == "anchors")["anchored"] > 0
    # without its tables, a run leaves calls, report, log and texts
    assert run_sample(spark, path, str(tmp_path / "bare"), "s", Settings(), keep_tables=False) == n
    assert not [p.name for p in (tmp_path / "bare").iterdir() if p.is_dir() and p.name != "summary"]


def test_no_reads(spark, tmp_path):
    path = str(tmp_path / "e.bam")
    write_bam(path, [("chr13", 114364328)], [])
    assert run_sample(spark, path, str(tmp_path / "out"), "e", Settings()) == 0
    assert (tmp_path / "out/e.vcf").read_text().startswith("##fileformat")


def calls_of(spark, scenario, n, seed):
    reads = simulate(spark, scenario, n, seed=seed)
    seq = F.when(F.col("strand") == "-", S.reverse_complement(F.col("read_seq"))).otherwise(F.col("read_seq"))
    qual = F.when(F.col("strand") == "-", F.reverse("read_qual")).otherwise(F.col("read_qual"))
    turned = reads.withColumns({"read_seq": seq, "read_qual": qual}).select("read_id", "read_seq", "read_qual", "strand", "read_len")
    result = pipeline.run(turned, Settings())
    refs = {r.ref_alias: r for r in result.references.collect()}
    return [(r.ref_alias, refs[r.ref_alias].itd_seq, refs[r.ref_alias].local_pos, r.allele_frequency) for r in result.summary.collect()], result


@pytest.mark.parametrize(("scenario", "seed"), [("C", 11), ("C", 12), ("D", 11)])
def test_two_alleles_of_one_size_in_reads_with_errors(spark, scenario, seed):
    """Nearly all reads unique: the denoiser alone tells both alleles apart, and they are called near their shares."""
    calls, _ = calls_of(spark, scenario, 2500, seed)
    planted = [(h.name, h.inserted, h.pos, h.share) for h in SCENARIOS[scenario] if h.size]
    found, extra = match_calls(planted, calls)
    share = {c[0]: c[3] for c in calls}
    assert set(found) == {"ITD_A", "ITD_B"} and not extra
    assert all(abs(share[found[name]] - part) < 0.06 for name, _, _, part in planted)


@pytest.mark.parametrize("seed", [21, 22, 23])
def test_one_allele_is_not_split(spark, monkeypatch, seed):
    """A single allele at a long-read error rate gives one call, in several seeds."""
    monkeypatch.setitem(SCENARIOS, "one", [Haplotype("WT", 0.6), Haplotype("ITD_A", 0.4, 45, 180)])
    calls, _ = calls_of(spark, "one", 1500, seed)
    assert len(calls) == 1 and same_itd(calls[0][1], SCENARIOS["one"][1].inserted, calls[0][2], 180) and abs(calls[0][3] - 0.4) < 0.05
