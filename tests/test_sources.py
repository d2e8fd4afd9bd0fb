"""Formats and reports, and the pipeline's empty result."""

import random
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThanOrEqual

from tandemlake.assay import WT, Settings
from tandemlake.operators import consensus, observed
from tandemlake.plans import pipeline
from tandemlake.sources import sinks
from tandemlake.operators.reads import keep_last
from tandemlake.sources.bam import BamReader, bins_of, join_parts, register, write_bam, write_index
from tandemlake.sources.fastq import dedup_reads, fastq_records, read_fastq, write_fastq


def test_bam_round_trip(spark, tmp_path):
    path = str(tmp_path / "a.bam")
    records = [("r1", 0, 0, 28033301, 60, [(10, "M"), (3, "I"), (7, "M")], "ACGTACGTACGTACGTACGT", "I" * 20), ("r2", 16, 0, 28034790, 10, [(5, "M")], "ACGTN", ""), ("r3", 4, -1, 0, 0, [], "ACG", "5+I")]
    write_bam(path, [("chr13", 114364328)], records)
    register(spark)
    df = spark.read.format("bam").load(path)
    got = {r.read_name: r for r in df.collect()}
    assert got["r1"].seq == records[0][6] and got["r1"].pos == 28033301 and got["r1"].pos_end == 28033301 + 16 and got["r1"].cigar == "10M3I7M"
    assert got["r2"].qual is None and got["r3"].chrom is None
    assert [r.read_name for r in df.where("mapq >= 20").collect()] == ["r1"]


def test_fastq(spark, tmp_path):
    """Records, places in order, and the last of equal ids."""
    p = tmp_path / "a.fastq"
    p.write_text("@a x\nACGT\n+\nIIII\n@b rc\nacg\n+\n@II\n@a\nTTTT\n+\n5555\n")
    rows = {(r.read_id, i): r for i, r in enumerate(sorted(read_fastq(spark, str(p)).collect(), key=lambda r: r.place))}
    assert rows[("b", 1)].strand == "-" and rows[("b", 1)].read_seq == "ACG" and rows[("b", 1)].read_qual == "@II"
    last = {r.read_id: (r.read_seq, r.n_rows) for r in dedup_reads(read_fastq(spark, str(p))).collect()}
    assert last == {"a": ("TTTT", 2), "b": ("ACG", 1)}
    out = [r.value for r in fastq_records(spark.createDataFrame([("x", "ACG", None)], "read_id string, read_seq string, read_qual string")).collect()]
    assert out == ["@x\nACG\n+\nIII"]


def test_fastq_splits(spark, tmp_path):
    """Every way to cut the bytes gives each record once, also with qualities that look like headers."""
    rng = random.Random(2)
    want = []
    for i in range(60):
        n = rng.randint(1, 30)
        want.append((f"r{i}", "".join(rng.choice("ACGT") for _ in range(n)), "".join(rng.choice("@+I") for _ in range(n))))
    (tmp_path / "a.fastq").write_text("".join(f"@{a} x\n{b}\n+\n{c}\n" for a, b, c in want))
    for size in (40, 137, 1 << 20):
        got = sorted(read_fastq(spark, str(tmp_path), size).collect(), key=lambda r: r.place)
        assert [(r.read_id, r.read_seq, r.read_qual) for r in got] == want


def test_bam_splits_index_and_duplicates(spark, tmp_path):
    """Many blocks, cut anywhere, give each record once and in order; an index and the sort order change no result."""
    rng = random.Random(6)
    records = []
    for i in range(4000):
        n = rng.randint(1, 400)
        records.append((f"r{i % 3900}", rng.choice([0, 16]), 0, 1 + 20 * i, rng.randrange(61), [(n, "M")], "".join(rng.choice("ACGTN") for _ in range(n)), "".join(chr(33 + rng.randrange(60)) for _ in range(n))))
    path = str(tmp_path / "a.bam")
    write_bam(path, [("chr13", 114364328), ("chr14", 1000)], [*records, ("last", 4, -1, 0, 0, [], "", "")])
    register(spark)
    for size in (700, 100_000, 1 << 30):
        got = sorted(spark.read.format("bam").option("splitsize", str(size)).load(path).collect(), key=lambda r: r.place)
        assert [(r.read_name, r.flag, r.pos, r.mapq, r.seq, r.qual) for r in got[:-1]] == [(a, b, d, e, g, h) for a, b, _, d, e, _, g, h in records]
        assert got[-1].read_name == "last" and got[-1].chrom is None
    near = lambda: sorted(r.read_name for r in spark.read.format("bam").option("splitsize", "50000").load(path).where("chrom = 'chr13' and pos <= 62000 and pos_end >= 60000 and mapq >= 20").collect())
    want = sorted(r[0] for r in records if r[3] <= 62000 and r[3] + r[5][0][0] - 1 >= 60000 and r[4] >= 20)
    assert near() == want and want
    for bins in (False, True):
        write_index(path, bins)
        reader = BamReader(path)
        list(reader.pushFilters([EqualTo(("chrom",), "chr13"), GreaterThanOrEqual(("pos_end",), 60000)]))
        assert reader.partitions()[0].start > 0 and near() == want
    twice = spark.read.format("bam").load(path).where("read_name = 'r7'").collect()
    assert len(twice) == 2
    one = keep_last(spark.read.format("bam").load(path), ["read_name"], [F.col("place")]).where("read_name = 'r7'").first()
    assert one.seq == records[3907][6] and one.n_rows == 2


def test_binned_index_reads_the_region_only(spark, tmp_path):
    """Any region gives the records that a whole scan gives, and the bytes of its parts grow with it; long records are found
    from their bins, and those of another contig and the unplaced tail aren't read."""
    rng = random.Random(8)
    places = sorted(rng.randrange(1, 3_000_000) for _ in range(9000))
    records = [(f"r{i}", 0, 0, p, 60, [(60, "M")] if i % 500 else [(30, "M"), (200_000, "N"), (30, "M")], "ACGT" * 15, "I" * 60) for i, p in enumerate(places)]
    records += [(f"o{i}", 0, 1, 1 + 50 * i, 60, [(60, "M")], "ACGT" * 15, "I" * 60) for i in range(3000)] + [(f"u{i}", 4, -1, 0, 0, [], "ACGT", "IIII") for i in range(3000)]
    path = str(tmp_path / "b.bam")
    write_bam(path, [("chr13", 114364328), ("chr14", 200000)], records)

    def read(contig, low, high):
        reader = BamReader(path, 1 << 16)
        assert not list(reader.pushFilters([EqualTo(("chrom",), contig), GreaterThanOrEqual(("pos_end",), low), LessThanOrEqual(("pos",), high)]))
        parts = reader.partitions()
        return sorted(row[0] for part in parts for row in reader.read(part)), sum(p.end - p.start for p in parts)

    regions = [("chr13", 1, 3_300_000), ("chr13", 1_000_000, 1_000_500), ("chr13", 2_900_000, 2_999_999), ("chr13", 500_000, 900_000), ("chr14", 100, 120), ("chr14", 1, 200_000), ("chr13", 50_000_000, 60_000_000)]
    whole = [read(*r)[0] for r in regions]
    write_index(path)
    bytes_read = []
    for r, want in zip(regions, whole):
        got, n = read(*r)
        assert got == want, r
        bytes_read.append(n)
    size = (tmp_path / "b.bam").stat().st_size
    assert bytes_read[-1] == 0 and bytes_read[4] < size / 3 and bytes_read[2] < bytes_read[0] and bytes_read[0] < 0.85 * size
    assert bins_of(0, 1) == [0, 1, 9, 73, 585, 4681] and len(bins_of(0, 1 << 29)) == 37449


def test_bam_reads_in_linear_time(tmp_path):
    """Ten times the records take about ten times as long."""
    took = []
    for n in (2000, 20000):
        path = str(tmp_path / f"{n}.bam")
        write_bam(path, [("chr13", 114364328)], [(f"r{i}", 0, 0, 1 + i, 60, [(300, "M")], "ACGT" * 75, "I" * 300) for i in range(n)])
        reader = BamReader(path, 1 << 30)
        began = time.perf_counter()
        assert sum(1 for part in reader.partitions() for _ in reader.read(part)) == n
        took.append(time.perf_counter() - began)
    assert took[1] < 40 * took[0]


def test_vcf_and_report(spark, tmp_path):
    calls = spark.createDataFrame([("ITD_1", 180, WT[135:180])], "peak_alias string, consensus_ins_pos_ref int, consensus_seq string")
    summary = spark.createDataFrame([("ITD_1", 40, 100, 0.4, 22, 18, 0.55, 1.1, 0.8)], "ref_alias string, n_itd_reads long, n_total_reads long, allele_frequency double, plus_reads long, minus_reads long, strand_ratio double, odds_ratio double, fisher_p double")
    refs = consensus.reference_alleles(calls)
    path = str(tmp_path / "a.vcf")
    assert sinks.write_vcf(path, "s", sinks.vcf_lines(summary, refs)) == 1
    row = sinks.read_vcf(spark, path).first()
    assert row.pos == 28033881 + 179 and row.inserted == WT[135:180] and row.info["AF"] == "0.40000" and row.info["ITD_LEN"] == "45"
    assert sinks.write_vcf(path, "s", None) == 0
    call = Row(**(summary.first().asDict() | {"itd_len": 45, "itd_seq": WT[135:180], "genomic_pos": 28034060}))
    page = sinks.html_report("s", [call], [(336, 60), (381, 40)])
    assert "40 of 100" in page and ">1.1<" in page and "Ex14" in page and page.count("<line") == 2
    two = [Row(**(call.asDict() | {"ref_alias": "ITD_2", "itd_seq": "ACN" * 15})), call]
    assert "45 bp A" in sinks.html_report("s", two) and "45 bp B" in sinks.html_report("s", two) and "<mark>N</mark>" in sinks.html_report("s", two)
    assert "fewer than 50 reads" in page and "<svg" in page and "No internal" in sinks.html_report("s", [], reason="nothing")
    log = str(tmp_path / "log.jsonl")
    sinks.record_stage(log, "a", rows=1)
    sinks.record_stage(log, "b")
    assert len(open(log).readlines()) == 2


def _reads(spark, seqs):
    rows = [(i, s, "I" * len(s), "+" if i % 2 else "-", len(s)) for i, s in enumerate(seqs)]
    return spark.createDataFrame(rows, "read_id long, read_seq string, read_qual string, strand string, read_len int")


def test_observed_statuses(spark):
    itd = WT[:180] + WT[135:180] + WT[180:]
    short = WT[:180] + "ACGT" + WT[180:]
    rare = WT[:120] + WT[75:120] + WT[120:]
    audit = {r.net_size * 1000 + r.exact_reads: r.status for r in observed.discover(_reads(spark, [itd] * 24 + [short] * 30 + [rare] * 18), Settings()).collect()}
    assert audit == {45024: "eligible", 4030: "below_min_size", 45018: "insufficient_recurrence"}


def test_wild_type_alone_is_a_negative_result(spark):
    result = pipeline.run(_reads(spark, [WT] * 300), Settings())
    assert result.summary.isEmpty() and result.reason


def test_candidates_are_annotated(spark):
    """Peaks of the reads that show an allele, alternatives of one base, and what of it a VCF line says."""
    a = WT[:180] + WT[135:180] + WT[180:]
    b = WT[:180] + WT[135:150] + ("A" if WT[150] != "A" else "C") + WT[151:180] + WT[180:]
    c = WT[:120] + WT[75:120] + WT[120:]
    rows = _reads(spark, [a] * 30 + [b] * 26 + [c] * 24 + [WT] * 10)
    assigned = rows.where("read_id % 3 <> 0").withColumn("gmm_peak_alias", F.when(F.col("read_id") < 40, "ITD_1").otherwise("ITD_2"))
    unresolved = spark.createDataFrame([("ITD_2", "x")], "peak_alias string, status string")
    audit = observed.annotate_candidates(observed.discover(rows, Settings()), rows, assigned, unresolved, Settings())
    got = {r.allele: r for r in audit.where("status = 'eligible'").collect()}
    ids = {s: r.allele_id for s, r in got.items()}
    assert got[a].source_assignments == "ITD_1:20;None:10" and got[a].failed_consensus_exact_reads == 0
    assert got[b].source_assignments == "ITD_1:6;ITD_2:11;None:9" and got[b].failed_consensus_exact_reads == 11
    assert got[a].sequence_alternatives == ids[b] and got[b].sequence_alternatives == ids[a] and got[c].sequence_alternatives == ""
    assert "clones" in got[a].note and "without length peaks" in got[c].note
    named = audit.withColumn("peak_alias", F.when(F.col("allele") == a, "ITD_1"))
    calls = spark.createDataFrame([("ITD_1", 180, WT[135:180])], "peak_alias string, consensus_ins_pos_ref int, consensus_seq string")
    summary = spark.createDataFrame([("ITD_1", 40, 100, 0.4, 22, 18, 0.55, 1.1, 0.8)], "ref_alias string, n_itd_reads long, n_total_reads long, allele_frequency double, plus_reads long, minus_reads long, strand_ratio double, odds_ratio double, fisher_p double")
    line = sinks.vcf_lines(summary, consensus.reference_alleles(calls), None, named).first().line
    assert ";SEQUENCE_UNCERTAINTY;DUP_IDENTITY=1.0000;FLANK_NORMALIZED_READS=0" in line


def test_truth_tables_self_check_and_score(spark):
    from tandemlake.plans.evaluate import SCENARIOS, score, self_check, simulate, truth_haplotypes, truth_reads

    reads = simulate(spark, "D", 400, seed=3).cache()
    haps = truth_haplotypes(reads, "D")
    assert self_check(haps, 400, 400) == [] and len(self_check(haps, 400, 399)) == 1
    wrong = haps.withColumn("realised_af", F.lit(0.5)).withColumn("itd_seq", F.lit("ACG"))
    assert len(self_check(wrong, 400, 400)) == 4
    t = truth_reads(reads, "D").collect()
    assert len(t) == 400 and all((r.is_itd, r.itd_len) == ((0, 0) if r.haplotype == "WT" else (1, 45)) for r in t)
    truth = [(h.name, h.inserted, h.pos, h.share) for h in SCENARIOS["D"] if h.size]
    calls = [("x", truth[0][1], truth[0][2], 0.30), ("z", "ACGT" * 9, 40, 0.02)]
    found = spark.createDataFrame([("x", "ACNN"), ("y", "ACG")], "peak_alias string, consensus_seq string")
    s = score(truth, calls, found, reads.select("read_id", F.col("haplotype").alias("gmm_peak_alias")), reads)
    assert [r["recovered"] for r in s.haplotypes] == [True, False] and s.extra == ["z"] and s.mean_af_error == s.max_af_error == 0.02
    assert (s.consensus_ns, s.peaks_with_ns) == (2, 1) and s.agreement["ari"] == 1.0
    assert score(truth, []).mean_af_error is None


def test_parts_appear_whole_or_not_at_all(spark, tmp_path):
    """BAM and FASTQ parts of tasks read back as they were written and join by blocks; a task that fails leaves nothing, a second
    write needs to overwrite, and overwriting leaves no part of the first."""
    rng = random.Random(3)
    rows = [(f"r{i}", 16 if i % 2 else 0, "chr13" if i % 9 else None, 1 + i if i % 9 else 0, i % 61, "50M" if i % 9 else "*", "".join(rng.choice("ACGTN") for _ in range(50 + i % 7)), None if i % 5 == 0 else "F" * (50 + i % 7)) for i in range(3000)]
    df = spark.createDataFrame(rows, "read_name string, flag int, chrom string, pos int, mapq int, cigar string, seq string, qual string")
    register(spark)
    path = str(tmp_path / "bam")
    save = lambda d, mode, n: d.repartition(n).write.format("bam").option("contigs", '[["chr13", 114364328], ["chr14", 5]]').mode(mode).save(path)
    save(df, "append", 4)

    def got(at):
        return sorted((r.read_name, r.flag, r.chrom, r.pos, r.mapq, r.cigar, r.seq, r.qual) for r in spark.read.format("bam").load(at).collect())

    want = sorted(rows)
    key = lambda r: (r[0], r[1], r[2] or "", r[3], r[4], r[5], r[6], r[7] or "")
    assert sorted(map(key, spark.read.format("bam").load(path).select("read_name", "flag", "chrom", "pos", "mapq", "cigar", "seq", "qual").collect())) == sorted(map(key, rows)) and want
    names = sorted(p.name for p in (tmp_path / "bam").iterdir())
    assert names == [f"part-{i:05d}.bam" for i in range(4)]
    join_parts(path, str(tmp_path / "one/joined.bam"))
    assert spark.read.format("bam").load(str(tmp_path / "one/joined.bam")).count() == 3000
    with pytest.raises(Exception, match="parts already"):
        save(df, "append", 1)
    bad = df.withColumn("chrom", F.when(F.col("read_name") == "r77", "chrUn").otherwise(F.col("chrom")))
    with pytest.raises(Exception, match="chrUn"):
        save(bad, "overwrite", 3)
    assert sorted(p.name for p in (tmp_path / "bam").iterdir()) == names and spark.read.format("bam").load(path).count() == 3000
    save(df.limit(10), "overwrite", 2)
    assert spark.read.format("bam").load(path).count() == 10 and len(list((tmp_path / "bam").iterdir())) == 2
    reads = spark.createDataFrame([(f"q{i}", "ACGT" * (1 + i % 3), None if i % 4 == 0 else "I" * 4) for i in range(40)] + [("empty", "", None)], "read_id string, read_seq string, read_qual string")
    write_fastq(reads.repartition(3), str(tmp_path / "fq"))
    back = read_fastq(spark, str(tmp_path / "fq")).collect()
    assert len(back) == 40 and all(len(r.read_qual) == len(r.read_seq) for r in back) and len(list((tmp_path / "fq").glob("part-*.fastq"))) == 3
