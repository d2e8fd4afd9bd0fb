"""Splitting peaks by sequence: a registry of methods that label each read of a peak."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandemlake.assay import Settings
from tandemlake.kernels.denoise import QUALITIES, TURNS, Denoiser, Partition, compare, denoise, error_rates, expected_errors, first_level, flat_rates, levels, log_chances, may_search, not_expected, owners, surplus, transitions, unlikely
from tandemlake.operators.insertions import guarded, relabel
from tandemlake.operators.lineage import cut, remove, stage

#: Bytes of sequences that a pass holds at once.
PASS_BYTES = 1 << 22
#: Bytes of unique sequences up to which a peak is denoised by one task in a single pass; larger ones take rounds of passes.
TASK_BYTES = 1 << 21


def unique_sequences(reads: DataFrame) -> DataFrame:
    """gmm_peak_alias, seq, n, first (least read_id) and qual (mean quality of each base, a byte each) of a peak's unique sequences.
    Reads without qualities, or of another length than these, count as quality 0. Sums are taken in each batch and then over
    rows sorted by sequence, so that no task holds the reads of a common one."""
    at = reads.schema["read_id"].dataType.simpleString()
    schema = f"gmm_peak_alias string, seq string, n long, first {at}, sums binary"
    rows = reads.where(F.col("gmm_peak_alias").isNotNull()).select("gmm_peak_alias", F.upper("read_seq").alias("seq"), F.col("read_id").alias("first"), ("read_qual" if "read_qual" in reads.columns else F.lit(None).cast("string").alias("read_qual")))

    def total(seq: str, quals: list[str]) -> np.ndarray:
        return np.frombuffer("".join(quals).encode("latin-1", "replace"), np.uint8).reshape(len(quals), len(seq)).sum(0, dtype=np.int64) - 33 * len(quals)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            t = t.dropna(subset=["seq"])
            groups = t.groupby(["gmm_peak_alias", "seq"], sort=False)
            out = groups.agg(n=("first", "size"), first=("first", "min")).reset_index()
            seqs, quals = out["seq"].tolist(), [[] for _ in range(len(out))]
            for k, q in zip(groups.ngroup().tolist(), t["read_qual"].tolist(), strict=True):
                if q is not None and len(q) == len(seqs[k]):
                    quals[k].append(q)
            out["sums"] = [total(s, q).tobytes() for s, q in zip(seqs, quals, strict=True)]
            yield out[["gmm_peak_alias", "seq", "n", "first", "sums"]]

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None

        def row() -> tuple:
            peak, seq, n, first, total = held
            return peak, seq, n, first, np.clip(np.round(total / n), 0, QUALITIES - 1).astype(np.uint8).tobytes()

        for t in batches:
            out = []
            for peak, seq, n, first, total in t.itertuples(index=False):
                total = np.frombuffer(total, np.int64)
                if held is not None and held[:2] == (peak, seq):
                    held = peak, seq, held[2] + n, min(held[3], first), held[4] + total
                else:
                    if held is not None:
                        out.append(row())
                    held = peak, seq, n, first, total
            yield pd.DataFrame(out, columns=["gmm_peak_alias", "seq", "n", "first", "qual"])
        if held is not None:
            yield pd.DataFrame([row()], columns=["gmm_peak_alias", "seq", "n", "first", "qual"])

    parts = rows.mapInPandas(sums, schema).repartition("gmm_peak_alias", "seq").sortWithinPartitions("gmm_peak_alias", "seq")
    return parts.mapInPandas(merged, schema.replace("sums", "qual"))


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, pd.DataFrame]]:
    """A peak's rows in a batch, a few megabytes at a time."""
    for t in batches:
        for peak, part in t.groupby("gmm_peak_alias", sort=False):
            where = part["seq"].str.len().cumsum() // PASS_BYTES
            for _, piece in part.groupby(where, sort=False):
                yield peak, piece.reset_index(drop=True)


def _chances(t: pd.DataFrame, p: Partition, known: list[str]) -> np.ndarray:
    """Log chances of the rows under each centre, from their alignments to the known sequences; a centre is its own."""
    seqs, quals = t["seq"].tolist(), t["qual"].tolist()
    beside = t["beside"].tolist()
    out = np.stack([log_chances(seqs, quals, [b[known.index(c)] for b in beside], p.rates) for c in p.centres], 1)
    place = {c: k for k, c in enumerate(p.centres)}
    for i, s in enumerate(seqs):
        if s in place:
            out[i], out[i, place[s]] = -np.inf, 0
    return out


class _Rounds:
    """The state of denoising: unique sequences with their alignments to each centre tried so far lie in Spark; the driver
    holds, for each peak, its centres, their totals and the error rates, all of which are bounded by peaks and alleles."""

    def __init__(self, counts: DataFrame, settings: Denoiser) -> None:
        self.settings = settings
        self.sizes = {r.gmm_peak_alias: (r.n, r.u) for r in counts.groupBy("gmm_peak_alias").agg(F.sum("n").alias("n"), F.count("*").alias("u")).collect()}
        tops = counts.groupBy("gmm_peak_alias").agg(F.min_by(F.struct("n", "first", "seq"), F.struct(-F.col("n"), F.col("seq"))).alias("c")).collect()
        self.tops = {r.gmm_peak_alias: r.c.seq for r in tops}
        #: what is told of a centre: its count and first read
        self.facts = {(r.gmm_peak_alias, r.c.seq): (r.c.n, r.c["first"]) for r in tops}
        self.known: dict[str, list[str]] = {p: [] for p in self.tops}
        self.state = counts.withColumn("beside", F.array().cast("array<binary>"))
        self.staged: DataFrame | None = None
        self.align(self.tops)

    def align(self, fresh: dict[str, str]) -> None:
        """Adds the alignments to a sequence of each peak named."""
        fresh = {p: c for p, c in fresh.items() if c not in self.known[p]}
        if not fresh:
            return
        settings, schema = self.settings, self.state.schema

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for peak, t in _pieces(batches):
                if peak in fresh:
                    t["beside"] = [[*b, x] for b, x in zip(t["beside"], compare(fresh[peak], t["seq"].tolist(), settings), strict=True)]
                yield t

        before, self.state = self.staged, stage(self.state.mapInPandas(run, schema))
        self.staged = self.state
        if before is not None:
            remove(before)
        for p, c in fresh.items():
            self.known[p] = [*self.known[p], c]

    def assign(self, parts: dict[str, Partition], least: dict[str, int] | None = None) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
        """By peak: reads of each centre, and counts of substitutions by quality, of the reads at the level ``least`` only."""
        known = self.known

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            totals = {p: np.zeros(len(v.centres), np.int64) for p, v in parts.items()}
            cells = {p: np.zeros(16 * QUALITIES, np.int64) for p in parts}
            for peak, t in _pieces(batches):
                if peak not in parts:
                    continue
                chance, n = _chances(t, parts[peak], known[peak]), t["n"].to_numpy()
                owner = owners(chance, parts[peak].totals)
                totals[peak] += np.bincount(owner, weights=n, minlength=len(totals[peak])).astype(np.int64)
                if least:
                    t = t[levels(chance[np.arange(len(t)), owner]) >= least[peak]]
                    owner, n = owner[t.index], n[t.index]
                where = [known[peak].index(c) for c in parts[peak].centres]
                found, of = transitions(t["seq"].tolist(), t["qual"].tolist(), [b[where[k]] for b, k in zip(t["beside"], owner, strict=True)])
                cells[peak] += np.bincount(found, weights=n[of], minlength=16 * QUALITIES).astype(np.int64)
            rows = [(p, 0, k, int(x)) for p, v in totals.items() for k, x in enumerate(v) if x] + [(p, 1, k, int(x)) for p, v in cells.items() for k, x in enumerate(v) if x]
            yield pd.DataFrame(rows, columns=["peak", "what", "k", "x"])

        totals = {p: np.zeros(len(v.centres), np.int64) for p, v in parts.items()}
        cells = {p: np.zeros(16 * QUALITIES, np.int64) for p in parts}
        for r in self.state.mapInPandas(run, "peak string, what int, k int, x long").groupBy("peak", "what", "k").agg(F.sum("x").alias("x")).collect():
            (cells if r.what else totals)[r.peak][r.k] = r.x
        return totals, {p: c.reshape(4, 4, QUALITIES) for p, c in cells.items()}

    def first_levels(self, parts: dict[str, Partition]) -> dict[str, int]:
        """By peak the level of chances from which reads teach the first rates."""
        known = self.known

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for peak, t in _pieces(batches):
                rows = pd.DataFrame({"peak": peak, "level": levels(_chances(t, parts[peak], known[peak]).max(1)), "n": t["n"]})
                yield rows[t["seq"] != parts[peak].centres[0]]

        counts: dict[str, np.ndarray] = {p: np.zeros(1 << 14) for p in parts}
        for r in self.state.mapInPandas(run, "peak string, level int, n long").groupBy("peak", "level").agg(F.sum("n").alias("n")).collect():
            counts[r.peak][-r.level] = r.n
        return {p: first_level(c) for p, c in counts.items()}

    def candidates(self, parts: dict[str, Partition]) -> dict[str, str]:
        """The next centre of each peak: of the sequences that can't be errors the least likely one, or one seen once."""
        known, settings, sizes = self.known, self.settings, self.sizes
        at = self.state.schema["first"].dataType.simpleString()

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for peak, t in _pieces(batches):
                if peak not in parts:
                    continue
                part = parts[peak]
                chance = _chances(t, part, known[peak])
                owner, n = owners(chance, part.totals), t["n"].to_numpy()
                value = surplus(n, chance[np.arange(len(t)), owner], part.totals[owner], sizes[peak][1], settings)
                new = unlikely(value, n, settings) & ~t["seq"].isin(part.centres).to_numpy()
                where = [known[peak].index(c) for c in part.centres]
                new = not_expected(new, t["seq"].tolist(), t["qual"].tolist(), [b[where[k]] for b, k in zip(t["beside"], owner.tolist(), strict=True)], n, part.totals[owner], part.flat, settings)
                rows = t.loc[new, ["gmm_peak_alias", "seq", "n", "first"]].assign(once=n[new] == 1, worth=np.where(n[new] == 1, expected_errors(t["qual"][new].tolist()), value[new]))
                best = rows.sort_values(["worth", "n", "seq"], ascending=[True, False, True]).groupby("once").head(1)
                yield best.assign(unlikely=best["once"].map(rows.groupby("once")["n"].sum()))

        tested = self.state.mapInPandas(run, f"gmm_peak_alias string, seq string, n long, first {at}, once boolean, worth double, unlikely long")
        best = F.min_by(F.struct("n", "first", "seq"), F.struct("worth", -F.col("n"), "seq")).alias("c")
        found = {}
        for r in sorted(tested.groupBy("gmm_peak_alias", "once").agg(best, F.sum("unlikely").alias("unlikely")).collect(), key=lambda r: r.once):
            peak = r.gmm_peak_alias
            if peak not in found and (not r.once or may_search(parts[peak], r.unlikely, sizes[peak][0], settings)):
                self.facts[peak, r.c.seq] = r.c.n, r.c["first"]
                found[peak] = r.c.seq
        return found

    def run(self) -> dict[str, Partition]:
        one = {p: Partition([c], np.array([self.sizes[p][0]])) for p, c in self.tops.items()}
        for least in (None, self.first_levels):
            for p, cells in self.assign(one, least and least(one))[1].items():
                one[p].rates, one[p].flat = error_rates(cells), flat_rates(cells)
        done: dict[str, Partition] = {}
        todo, found = one, {}
        for turn in range(TURNS):
            # new centres, one a peak and pass, until none is found
            parts = {p: Partition([self.tops[p]], np.array([self.sizes[p][0]]), v.rates, flat=v.flat) for p, v in todo.items()}
            growing, cells = dict(parts), {}
            while growing:
                totals, learned = self.assign(growing)
                cells |= learned
                for p, t in totals.items():
                    growing[p].totals = t
                new = self.candidates(growing)
                self.align(new)
                growing = {p: v for p, v in growing.items() if p in new}
                for p, c in new.items():
                    growing[p].add(c, self.facts[p, c][0])
            done |= parts
            again = {p: Partition(v.centres, v.totals, error_rates(cells[p]), flat=flat_rates(cells[p])) for p, v in parts.items()}
            todo = {p: v for p, v in again.items() if p not in found or found[p].centres != v.centres or not np.allclose(np.log(found[p].rates), np.log(v.rates), atol=1e-3)}
            found = again
            if not todo:
                break
        return done

    def labels(self, parts: dict[str, Partition]) -> DataFrame:
        """gmm_peak_alias, seq and owner, the number of its centre."""
        known = self.known

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for peak, t in _pieces(batches):
                yield t[["gmm_peak_alias", "seq"]].assign(owner=owners(_chances(t, parts[peak], known[peak]), parts[peak].totals))

        return self.state.mapInPandas(run, "gmm_peak_alias string, seq string, owner int")


def denoise_labels(reads: DataFrame, settings: Settings, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The reads with label: the cluster of their sequence, by the centre's rank. Peaks with fewer than twice the least child
    size get none."""
    targets = reads if settings.cluster_wt_peak else reads.where("gmm_peak_alias <> 'WT'")
    counts = stage(unique_sequences(targets))
    sizes = {r.gmm_peak_alias: r.b for r in counts.groupBy("gmm_peak_alias").agg(F.sum("n").alias("n"), F.sum(F.length("seq")).alias("b")).collect() if r.n >= 2 * settings.min_haplotype_reads}
    small = sorted(p for p, b in sizes.items() if b <= task_bytes)
    found = _in_tasks(counts.where(F.col("gmm_peak_alias").isin(small)), settings.denoiser)
    rounds = None
    if len(small) < len(sizes):
        rounds = _Rounds(counts.where(F.col("gmm_peak_alias").isin(sorted(sizes.keys() - set(small)))), settings.denoiser)
        found = found.unionByName(_by_rounds(rounds))
    labels = stage(found.select("gmm_peak_alias", F.col("seq").alias("_s"), "label"))
    remove(counts, *([rounds.state] if rounds else []))
    return reads.withColumn("_s", F.upper("read_seq")).join(labels, ["gmm_peak_alias", "_s"], "left").drop("_s")


def _ranked(facts: list[tuple]) -> list[str]:
    """Labels of centres, given their counts and first reads: in the order of their reads, the earliest on ties."""
    order = sorted(range(len(facts)), key=lambda k: (-facts[k][0], facts[k][1]))
    return [f"c{order.index(k):04d}" for k in range(len(facts))]


def _in_tasks(counts: DataFrame, settings: Denoiser) -> DataFrame:
    """gmm_peak_alias, seq and label of peaks whose unique sequences are few: each one is a group."""

    def run(t: pd.DataFrame) -> pd.DataFrame:
        owner = denoise(t["seq"].tolist(), t["n"].tolist(), quals=t["qual"].tolist(), settings=settings)
        centres = sorted(set(owner))
        label = dict(zip(centres, _ranked([(t["n"][c], t["first"][c]) for c in centres]), strict=True))
        return t[["gmm_peak_alias", "seq"]].assign(label=[label[c] for c in owner])

    return counts.groupBy("gmm_peak_alias").applyInPandas(run, "gmm_peak_alias string, seq string, label string")


def _by_rounds(rounds: _Rounds) -> DataFrame:
    """The same of peaks of any size."""
    parts = rounds.run()
    names = [(p, k, name) for p, v in parts.items() for k, name in enumerate(_ranked([rounds.facts[p, c] for c in v.centres]))]
    label = rounds.state.sparkSession.createDataFrame(names, "gmm_peak_alias string, owner int, label string")
    return rounds.labels(parts).join(F.broadcast(label), ["gmm_peak_alias", "owner"]).select("gmm_peak_alias", "seq", "label")


def no_labels(reads: DataFrame, settings: Settings) -> DataFrame:
    return reads.withColumn("label", F.lit(None).cast("string"))


METHODS: dict[str, Callable[[DataFrame, Settings], DataFrame]] = {"denoise": denoise_labels, "none": no_labels}


def split_peaks(reads: DataFrame, settings: Settings) -> DataFrame:
    """Reads with gmm_peak_alias refined by the configured method under the size guardrails."""
    if settings.haplotype_method not in METHODS:
        raise ValueError(f"unknown haplotype method {settings.haplotype_method!r}; known: {', '.join(sorted(METHODS))}")
    labelled = METHODS[settings.haplotype_method](reads, settings)
    counts = cut(labelled.groupBy(F.col("gmm_peak_alias").alias("parent"), "label").agg(F.count("*").alias("n")))
    used = [r.parent for r in counts.select("parent").distinct().collect()]  # a handful of peaks
    children = cut(guarded(counts, settings.min_haplotype_reads, settings.min_subpeak_fraction, used))
    split = relabel(labelled, children, F.col("label")).drop("label")
    return _keep_wild_type(split, settings) if settings.cluster_wt_peak else split


def _keep_wild_type(reads: DataFrame, settings: Settings) -> DataFrame:
    """Of the wild-type peak's children, the one closest to the reference's length within tolerance is the wild type again."""
    apart = F.abs(F.avg("read_len") - settings.wt_amplicon_length)
    child = reads.where(F.col("gmm_peak_alias").startswith("ITD_WT_H")).groupBy("gmm_peak_alias").agg(apart.alias("apart")).where(F.col("apart") <= settings.wt_peak_tolerance)
    closest = child.agg(F.min(F.struct("apart", "gmm_peak_alias")).alias("c")).select(F.col("c.gmm_peak_alias").alias("_wt"))
    return reads.crossJoin(F.broadcast(closest)).withColumn("gmm_peak_alias", F.when(F.col("gmm_peak_alias") == F.col("_wt"), "WT").otherwise(F.col("gmm_peak_alias"))).drop("_wt")
