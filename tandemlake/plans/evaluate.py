"""Simulated samples and the score of calls against their truth."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemlake.assay import WT, reverse_complement
from tandemlake.kernels.rotation import least_rotation, rotational_identity


@dataclass(frozen=True)
class Haplotype:
    name: str
    share: float
    size: int = 0
    pos: int = 0
    substitutions: tuple[int, ...] = ()

    @property
    def inserted(self) -> str:
        copy = list(WT[self.pos - self.size : self.pos])
        for i in self.substitutions:
            copy[i] = copy[i].translate(str.maketrans("ACGT", "CGTA"))
        return "".join(copy)

    @property
    def allele(self) -> str:
        return WT[: self.pos] + self.inserted + WT[self.pos :]


# Mixtures of alleles, and error rates of a read's base (mismatch, insertion, deletion).
SCENARIOS = {
    "A": [Haplotype("WT", 0.55), Haplotype("ITD_A", 0.20, 45, 180), Haplotype("ITD_B", 0.12, 45, 120), Haplotype("ITD_C", 0.08, 30, 180), Haplotype("ITD_D", 0.05, 45, 180, (5, 20, 35))],
    "B": [Haplotype("WT", 0.965), Haplotype("ITD_A", 0.020, 45, 180), Haplotype("ITD_B", 0.015, 45, 120)],
    "C": [Haplotype("WT", 0.60), Haplotype("ITD_A", 0.32, 45, 180), Haplotype("ITD_B", 0.08, 45, 120)],
    "D": [Haplotype("WT", 0.60), Haplotype("ITD_A", 0.28, 45, 180), Haplotype("ITD_B", 0.12, 45, 120)],
}
ERRORS = (0.00569, 0.00298, 0.00435)


def homopolymer_weights(seq: str, factor: float = 4.0) -> np.ndarray:
    """Indel weights of bases: ``factor`` in runs of three or more, with mean 1."""
    s = np.frombuffer(seq.encode(), np.uint8)
    run = np.concatenate([[True], s[1:] != s[:-1]])
    group = np.cumsum(run) - 1
    w = np.where(np.bincount(group)[group] >= 3, factor, 1.0)
    return w / w.mean()


def with_errors(seq: str, rng: np.random.Generator) -> tuple[str, str]:
    """The sequence with random errors, and its qualities: low at errors."""
    w, u = homopolymer_weights(seq), rng.random((len(seq), 3))
    bases, quals = [], []
    for i, c in enumerate(seq):
        if u[i, 2] < ERRORS[2] * w[i]:
            continue
        wrong = u[i, 0] < ERRORS[0]
        bases.append("ACGT"[("ACGT".index(c) + 1 + rng.integers(3)) % 4] if wrong else c)
        quals.append("+" if wrong else "I")
        if u[i, 1] < ERRORS[1] * w[i]:
            bases.append("ACGT"[rng.integers(4)])
            quals.append("+")
    return "".join(bases), "".join(quals)


def simulate(spark: SparkSession, scenario: str, n_reads: int, seed: int = 42) -> DataFrame:
    """read_id, haplotype (truth), strand, read_seq and read_qual (in sequencing orientation), read_len. A read depends on
    its number and the seed alone."""
    parts = SCENARIOS[scenario]
    shares = np.cumsum([h.share for h in parts])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i in batch["id"]:
                rng = np.random.default_rng([seed, int(i)])
                h = parts[min(int(np.searchsorted(shares, rng.random(), side="right")), len(parts) - 1)]
                seq, qual = with_errors(h.allele, rng)
                strand = "+" if rng.random() < 0.5 else "-"
                rows.append((int(i), h.name, strand, seq if strand == "+" else reverse_complement(seq), qual if strand == "+" else qual[::-1], len(seq)))
            yield pd.DataFrame(rows, columns=["read_id", "haplotype", "strand", "read_seq", "read_qual", "read_len"])

    return spark.range(n_reads).mapInPandas(run, "read_id long, haplotype string, strand string, read_seq string, read_qual string, read_len int")


#: The scorer's tolerance of sizes, the further one of places, and the least identity of rotations.
SIZE_TOLERANCE, PLACE_SLACK, LEAST_IDENTITY = 2, 2, 0.85


def same_itd(called: str, true: str, called_pos: int, true_pos: int, min_identity: float = LEAST_IDENTITY, tolerance: int = SIZE_TOLERANCE) -> bool:
    """Do two insertions tell of one duplication: nearly one size, and either one is a rotation of the other, wherever they
    stand, or they stand at one place, or one whole copy before or after it, and some rotation has enough identity."""
    if abs(len(called) - len(true)) > tolerance:
        return False
    if called and least_rotation(called) == least_rotation(true):
        return True
    apart = min(abs(called_pos - true_pos), abs(called_pos - true_pos + len(true)), abs(called_pos - len(called) - true_pos))
    return apart <= tolerance + PLACE_SLACK and rotational_identity(called, true) >= min_identity


def itd_pairs(truth: DataFrame, calls: DataFrame, min_identity: float = LEAST_IDENTITY, tolerance: int = SIZE_TOLERANCE) -> DataFrame:
    """name and call of all pairs that same_itd accepts. truth: name, seq, pos; calls: call, seq, pos. Rotations of each other
    meet at their canonical rotation; other candidates at a size and a stretch of places, one row for each that is near enough."""

    @F.pandas_udf("string")
    def canonical(seq: pd.Series) -> pd.Series:
        return seq.map(least_rotation)

    @F.pandas_udf("boolean")
    def same(a: pd.Series, b: pd.Series, pa: pd.Series, pb: pd.Series) -> pd.Series:
        return pd.Series([same_itd(x, y, int(p), int(q), min_identity, tolerance) for x, y, p, q in zip(a, b, pa, pb, strict=True)], dtype=bool)

    reach = tolerance + PLACE_SLACK
    width = 2 * reach + 1
    t = truth.where("seq <> ''").select("name", F.col("seq").alias("t_seq"), F.col("pos").alias("t_pos"))
    c = calls.where("seq <> ''").select("call", F.col("seq").alias("c_seq"), F.col("pos").alias("c_pos"))
    turned = t.withColumn("key", canonical("t_seq")).join(c.withColumn("key", canonical("c_seq")), "key").drop("key")
    sizes = F.explode(F.sequence(F.length("c_seq") - tolerance, F.length("c_seq") + tolerance))
    # a call's places: its own, a true copy's length further and its own length back, each within reach of a stretch
    place = F.explode(F.array("c_pos", F.col("c_pos") + F.col("size"), F.col("c_pos") - F.length("c_seq")))
    bins = lambda p: F.floor(p / width)
    spread = c.withColumn("size", sizes).withColumn("at", place).withColumn("bin", F.explode(F.array_distinct(F.array(bins(F.col("at") - reach), bins(F.col("at") + reach)))))
    near = t.withColumns({"size": F.length("t_seq"), "bin": bins(F.col("t_pos"))}).join(spread, ["size", "bin"]).select(*turned.columns).distinct()
    return turned.unionByName(near.where(same("c_seq", "t_seq", "c_pos", "t_pos"))).select("name", "call").distinct()


def match_calls(truth: list[tuple[str, str, int, float]], calls: list[tuple[str, str, int, float]]) -> tuple[dict[str, str], list[str]]:
    """Greedy one-to-one matches of truth to calls (name, insertion, position, frequency), both in the order given; and the
    calls left over. At most a handful of each."""
    used: set[str] = set()
    found: dict[str, str] = {}
    for name, ins, pos, _ in truth:
        for call, other, place, _ in calls:
            if call not in used and same_itd(other, ins, place, pos):
                found[name] = call
                used.add(call)
                break
    return found, [c[0] for c in calls if c[0] not in used]


def truth_reads(reads: DataFrame, scenario: str) -> DataFrame:
    """read_id, haplotype, is_itd, itd_len, ins_pos_local, strand, observed_len of simulated reads."""
    known = reads.sparkSession.createDataFrame([(h.name, int(h.size > 0), h.size, h.pos if h.size else None) for h in SCENARIOS[scenario]], "haplotype string, is_itd int, itd_len int, ins_pos_local int")
    return reads.join(F.broadcast(known), "haplotype").select("read_id", "haplotype", "is_itd", "itd_len", "ins_pos_local", "strand", F.col("read_len").alias("observed_len"))


def truth_haplotypes(reads: DataFrame, scenario: str) -> DataFrame:
    """haplotype, target_af, realised_af, n_reads, itd_len, ins_pos_local, itd_seq of a scenario and its simulated reads."""
    parts = SCENARIOS[scenario]
    known = reads.sparkSession.createDataFrame([(i, h.name, h.share, h.size, h.pos if h.size else None, h.inserted if h.size else "") for i, h in enumerate(parts)], "place int, haplotype string, target_af double, itd_len int, ins_pos_local int, itd_seq string")
    counts = reads.groupBy("haplotype").agg(F.count("*").alias("n_reads"))
    total = reads.count()
    n = F.coalesce("n_reads", F.lit(0))
    return known.join(F.broadcast(counts), "haplotype", "left").orderBy("place").select("haplotype", "target_af", (n / F.lit(max(total, 1))).alias("realised_af"), n.alias("n_reads"), "itd_len", "ins_pos_local", "itd_seq")


def self_check(haplotypes: DataFrame, n_reads: int, n_records: int) -> list[str]:
    """What is wrong with a simulated sample: shares off their targets by more than four deviations (and a percent), equal
    insertions under two names, or other numbers of reads than asked for. haplotypes: truth_haplotypes, a handful."""
    rows = haplotypes.collect()
    problems = []
    for r in rows:
        if abs(r.realised_af - r.target_af) > max(0.01, 4 * (r.target_af * (1 - r.target_af) / max(n_reads, 1)) ** 0.5):
            problems.append(f"{r.haplotype}: share {r.realised_af:.4f} for a target of {r.target_af:.4f}")
    seen: dict[str, str] = {}
    for r in rows:
        if r.itd_len and seen.setdefault(r.itd_seq, r.haplotype) != r.haplotype:
            problems.append(f"{seen[r.itd_seq]} and {r.haplotype} have one inserted sequence")
    told = sum(r.n_reads for r in rows)
    if not told == n_reads == n_records:
        problems.append(f"{n_reads} reads asked for, {told} in the truth, {n_records} in the file")
    return problems


@dataclass(frozen=True)
class Score:
    """Calls against the truth: a row for each planted insertion, and totals."""

    haplotypes: list[dict]
    extra: list[str]
    mean_af_error: float | None
    max_af_error: float | None
    consensus_ns: int
    peaks_with_ns: int
    agreement: dict | None


def score(truth: list[tuple[str, str, int, float]], calls: list[tuple[str, str, int, float]], consensus: DataFrame | None = None, assigned: DataFrame | None = None, reads: DataFrame | None = None) -> Score:
    """truth and calls: name, insertion, position, frequency. consensus: peak_alias, consensus_seq, for its unresolved bases.
    assigned (read_id, gmm_peak_alias) and reads (read_id, haplotype): the agreement of clusters over reads that both have."""
    from tandemlake.operators.quantify import cluster_agreement

    found, extra = match_calls(truth, calls)
    by_name = {c[0]: c for c in calls}
    rows = []
    for name, inserted, _, share in truth:
        call = by_name.get(found.get(name))
        rows.append({"haplotype": name, "true_af": share, "true_len": len(inserted), "recovered": call is not None, "called": call[0] if call else None, "af_error": round(call[3] - share, 4) if call else None, "len_error": len(call[1]) - len(inserted) if call else None})
    errors = [abs(r["af_error"]) for r in rows if r["recovered"]]
    ns, with_ns = 0, 0
    if consensus is not None:
        n = F.length(F.regexp_replace("consensus_seq", "[^N]", ""))
        totals = consensus.agg(F.sum(n).alias("ns"), F.count_if(n > 0).alias("peaks")).first()
        ns, with_ns = totals.ns or 0, totals.peaks or 0
    agreement = None
    if assigned is not None and reads is not None:
        both = reads.select("read_id", F.col("haplotype").alias("truth")).join(assigned.select("read_id", F.col("gmm_peak_alias").alias("label")), "read_id")
        agreement = None if both.isEmpty() else cluster_agreement(both).first().asDict()
    return Score(rows, extra, round(sum(errors) / len(errors), 4) if errors else None, max(errors) if errors else None, int(ns), int(with_ns), agreement)
