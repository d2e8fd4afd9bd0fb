"""Kernels against brute force and known answers."""

import math
import random

import numpy as np
import pytest

from tandemlake.assay import FORWARD_PRIMER, REVERSE_PRIMER, WT, Settings, anchor_coordinates, resolve_contig, reverse_complement
from tandemlake.functions.statistics import fisher_exact, law_of_total_variance
from tandemlake.kernels import anchors, mixture, msa
from tandemlake.kernels.align import DISCOVERY, LOCATOR, VALIDATION, align_batch, score_of
from tandemlake.kernels.denoise import denoise
from tandemlake.kernels.trim import ends_of, trim_read
from tandemlake.operators.insertions import length_modes
from tandemlake.operators.peaks import merge_close, name_peaks, refine_length, window_floor


def best_score(t: str, q: str, s) -> int:
    """Plain dynamic programming over (row, column, state)."""
    low = -(10**9)
    n, m = len(t), len(q)
    end = lambda k: s.end_open + (k - 1) * s.end_extend if k else 0
    h = [[low] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if i == 0 or j == 0:
                h[i][j] = end(i + j)
                continue
            v = h[i - 1][j - 1] + (s.match if t[i - 1] == q[j - 1] else s.mismatch)
            for k in range(1, j + 1):
                o, e = (s.end_open, s.end_extend) if i == n else (s.ins_open, s.ins_extend)
                v = max(v, h[i][j - k] + o + (k - 1) * e)
            for k in range(1, i + 1):
                o, e = (s.end_open, s.end_extend) if j == m else (s.del_open, s.del_extend)
                v = max(v, h[i - k][j] + o + (k - 1) * e)
            h[i][j] = v
    return h[n][m]


@pytest.mark.parametrize("scoring", [DISCOVERY, VALIDATION, LOCATOR])
def test_alignment_is_optimal(scoring):
    rng = random.Random(5)
    for _ in range(40):
        t = "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 14)))
        qs = ["".join(rng.choice("ACGT") for _ in range(rng.randint(1, 16))) for _ in range(3)]
        for q, a in zip(qs, align_batch(t, qs, scoring), strict=True):
            assert a.score == best_score(t, q, scoring)
            if a.blocks:
                assert score_of(t, q, a.blocks, scoring) <= a.score


def test_alignment_finds_the_insertion():
    allele = WT[:180] + WT[135:180] + WT[180:]
    a = align_batch(WT, [allele], DISCOVERY)[0]
    assert a.inserted == 45 and a.matches == len(WT)


def test_known_answers():
    assert anchor_coordinates(300, 16, 4) == (21, 283) and anchor_coordinates(300, 16, 0) == (25, 279)
    assert window_floor("ITD_2", {"ITD_1": 30.0, "ITD_2": 36.0, "ITD_3": 80.0}, 8) == 3.0
    assert window_floor("ITD_3", {"ITD_1": 30.0, "ITD_3": 80.0}, 8) == 8.0 and window_floor("x", {}, 4) == 4.0
    odds, p = fisher_exact(6, 3, 2, 7)
    assert odds == 7.0 and round(p, 6) == round((math.comb(9, 6) * math.comb(9, 2) + math.comb(9, 7) * math.comb(9, 1) + math.comb(9, 8)) * 2 / math.comb(18, 8), 6)
    assert resolve_contig(["2", "13"]) == "13"
    with pytest.raises(ValueError):
        resolve_contig(["chr2"])
    for bad in ((300, 0, 4), (300, 16, 26), (300, 135, 4)):
        with pytest.raises(ValueError):
            anchor_coordinates(*bad)
    with pytest.raises(ValueError):
        Settings(min_observed_reads=1)


def test_context_window():
    assert msa.context_window([(10, 12), (11, 15), (40, 41)], [5, 4, 1], 100, flank=3) == (8, 57)
    assert msa.context_window([(10, 12), (11, 15), (40, 41)], [5, 4, 1], 100, flank=3, share=0.9) == (8, 86)
    assert msa.context_window([(50, 60), (20, 30), (80, 81), (9, 10)], [6, 2, 2, 1], 100, flank=0, share=0.7) == (30, 50)
    rng = random.Random(77)
    for _ in range(200):
        spans = [(a := rng.randrange(80), a + rng.randrange(12)) for _ in range(rng.randint(1, 8))]
        w = [rng.randint(1, 9) for _ in spans]
        left, right = msa.context_window(spans, w, 100, flank=0)
        low, high = left, 100 - right
        assert sum(x for (a, b), x in zip(spans, w, strict=True) if a <= high and b >= low) >= 0.95 * sum(w)
        # it holds a point of the most weight, and no end could be drawn in
        most = max(sum(x for (a, b), x in zip(spans, w, strict=True) if a <= p <= b) for p in range(100))
        assert any(sum(x for (a, b), x in zip(spans, w, strict=True) if a <= p <= b) == most for p in range(low, high + 1))
        if low < high:
            assert any(b == low for _, b in spans) or any(a == low for a, _ in spans)


def test_length_modes(spark):
    def modes(counts, least, share):
        rows = spark.createDataFrame([("p", x) for x, n in counts.items() for _ in range(n)], "peak string, ins_len int")
        return sorted((r["mode"], r.n) for r in length_modes(rows, "peak", least, share).collect())

    assert modes({30: 100, 31: 8, 32: 3, 36: 60, 37: 58, 60: 20, 61: 25}, 10, 0.05) == [(30, 100), (36, 60), (61, 25)]
    assert modes({50: 100, 51: 70, 52: 65, 53: 80}, 10, 0.05) == [(50, 100)]  # no valley
    assert modes({20: 40, 22: 40, 25: 40}, 5, 0.1) == [(20, 40), (25, 40)]  # 22 is too near
    assert modes({20: 4, 40: 90}, 5, 0.01) == [(40, 90)] and modes({20: 4}, 5, 0.01) == []


def test_weighted_consensus_against_counting():
    rng = random.Random(19)
    for _ in range(200):
        rows = ["".join(rng.choice("ACGT--") for _ in range(12)) for _ in range(rng.randint(1, 7))]
        w = [rng.randint(0, 5) for _ in rows]
        got = msa.weighted_consensus(rows, w, 0.6, 0.5)
        total = sum(w) or 1
        columns = [list(zip(c, w, strict=True)) for c in zip(*rows, strict=True)]
        covers = [sum(x for c, x in col if c != "-") for col in columns]
        keep = [j for j in range(12) if covers[j] / total >= 0.5] or [covers.index(max(covers))]
        text = ""
        for j in [j for j in keep if any(c != "-" for c, _ in columns[j])]:
            sums = {c: sum(x for d, x in columns[j] if d == c) for c, _ in columns[j] if c != "-"}
            best = next(c for c, _ in columns[j] if c != "-" and sums[c] == max(sums.values()))
            text += best if covers[j] and sums[best] / covers[j] >= 0.6 else "N"
        assert got.sequence == text


def test_boundary_interval_is_the_brute_force_set():
    rng = random.Random(7)
    for _ in range(300):
        ref = "".join(rng.choice("AC") for _ in range(rng.randint(3, 12)))
        p, ins = rng.randint(0, len(ref)), "".join(rng.choice("AC") for _ in range(rng.randint(1, 6)))
        allele = ref[:p] + ins + ref[p:]
        valid = [k for k in range(len(ref) + 1) if allele.startswith(ref[:k]) and allele.endswith(ref[k:]) and len(allele) >= len(ref)]
        low, high = msa.boundary_interval(allele, ref)
        assert valid == list(range(low, high + 1))


def test_anchor_hits_are_exhaustive():
    rng = random.Random(8)
    for _ in range(100):
        seq, anchor = "".join(rng.choice("ACGTN") for _ in range(70)), "".join(rng.choice("ACGT") for _ in range(7))
        brute = [(p, sum(a != b for a, b in zip(seq[p : p + 7], anchor, strict=True))) for p in range(64) if "N" not in seq[p : p + 7]]
        assert anchors.hits(seq, anchor, 3) == [x for x in brute if x[1] <= 3]


def test_anchor_pairs():
    left, right = WT[15:35], WT[305:325]
    changed = WT[:16] + "A" + WT[17:]
    assert anchors.locate(WT, left, right, 3)[:3] == ("anchored", 15, 305)
    assert anchors.locate(changed, left, right, 3)[3] == int(changed[16] != WT[16])
    assert anchors.locate(WT + WT, left, right, 3)[0] == "ambiguous_anchor_pair"
    assert anchors.locate(WT[40:], left, right, 3)[0] == "missing_left_anchor"


def test_primer_trim():
    right = reverse_complement(FORWARD_PRIMER)
    junk = "GATTACA"
    assert trim_read(junk + WT + junk, REVERSE_PRIMER, right) == ("+", 7, 7 + len(WT))
    assert trim_read(reverse_complement(junk + WT), REVERSE_PRIMER, right) == ("-", 7, 7 + len(WT))
    assert trim_read("ACGT" * 100, REVERSE_PRIMER, right, 0.0) is None
    cost, start = ends_of("TTACGTT", "ACG")
    assert cost.min() == 0 and start[cost.argmin()] == 2


def test_mixture_and_peaks():
    rng = np.random.default_rng(42)
    x, n = np.unique(np.concatenate([rng.normal(336, 1, 4000), rng.normal(381, 1, 2000)]).round().astype(int), return_counts=True)
    mean, sd, share = mixture.select(x, n, 7)
    peaks = name_peaks(merge_close([{"orig_id": i, "mean_bp": m, "sd_bp": s, "fraction": f} for i, (m, s, f) in enumerate(zip(mean, sd, share, strict=True))], 10), Settings())
    assert [p["alias"] for p in peaks] == ["WT", "ITD_1"] and abs(peaks[1]["putative_itd_size"] - 45) < 0.2
    m, s = law_of_total_variance([1, 1], [336, 338], [0.5, 0.5])
    assert m == 337 and math.isclose(s, math.sqrt(1.25))
    assert len(refine_length([(381, 200), (387, 150), (380, 20), (388, 15)])) == 2 and len(refine_length([(381, 300), (382, 20)])) == 1


def test_denoise_separates_a_planted_mixture():
    a = WT[:180] + WT[135:180] + WT[180:]
    b = WT[:120] + WT[75:120] + WT[120:]
    errors = [a[:i] + ("A" if a[i] != "A" else "C") + a[i + 1 :] for i in range(30, 60)]
    seqs, counts = [a, b, *errors], [800, 200, *[2] * 30]
    owner = denoise(seqs, counts)
    assert owner[0] != owner[1] and set(owner) == {0, 1} and all(o == 0 for o in owner[2:])


def test_star_consensus():
    base = WT[100:200]
    rows = msa.star([base, base[:50] + "A" + base[50:], base[:20] + base[21:]])
    assert len({len(r) for r in rows}) == 1 and [r.replace("-", "") for r in rows][0] == base
    assert msa.weighted_consensus(rows, [90, 5, 5]).sequence == base
    mixed = msa.weighted_consensus(["ACGT", "ACTT"], [80, 20])
    assert mixed.sequence == "ACGT" and math.isclose(mixed.max_minor, 0.2)
    assert msa.weighted_consensus(["ACGT", "ACTT"], [60, 40]).sequence == "ACNT"


def test_simulated_insertions_match_their_truth():
    from tandemlake.plans.evaluate import SCENARIOS, match_calls, same_itd, with_errors

    a, b = SCENARIOS["A"][1], SCENARIOS["A"][2]
    rotated = a.inserted[7:] + a.inserted[:7]
    assert same_itd(a.inserted, rotated, 180, 180) and not same_itd(a.inserted, a.inserted[:30], 180, 180) and not same_itd(a.inserted, b.inserted, 180, 120)
    found, extra = match_calls([("A", a.inserted, 180, 0.2), ("B", b.inserted, 120, 0.1)], [("x", rotated, 180, 0.2), ("y", b.inserted, 120, 0.1), ("z", "ACGT" * 10, 50, 0.05)])
    assert found == {"A": "x", "B": "y"} and extra == ["z"]
    seq, qual = with_errors(a.allele, np.random.default_rng(1))
    assert len(seq) == len(qual) and abs(len(seq) - len(a.allele)) < 15


def test_denoise_labels_of_all_uniques(spark):
    """A peak of more than 2000 unique sequences: each read is labelled, as the kernel labels all of them at once."""
    from tandemlake.assay import Settings
    from tandemlake.kernels.denoise import denoise
    from tandemlake.operators.split import denoise_labels

    rng = random.Random(5)
    major = "".join(rng.choice("ACGT") for _ in range(300))
    minor = major[:100] + "".join("ACGT"[("ACGT".index(c) + 1) % 4] for c in major[100:112]) + major[112:]
    third = major[:150] + "ACGTTGCAACGT" + major[150:]

    def wrong(s):
        for i in rng.sample(range(len(s)), 2):
            s = s[:i] + rng.choice("ACGT".replace(s[i], "")) + s[i + 1 :]
        return s

    seqs = [major] * 600 + [minor] * 300 + [third] * 200 + [wrong(major) for _ in range(1500)] + [wrong(minor) for _ in range(900)] + [wrong(third) for _ in range(200)]
    rng.shuffle(seqs)
    rows = [(i, s, len(s), p) for p in ("ITD_1", "ITD_2") for i, s in enumerate(seqs)] + [(i, major, 300, "ITD_3") for i in range(3)]
    reads = spark.createDataFrame([(j, *r[1:]) for j, r in enumerate(rows)], "read_id long, read_seq string, read_len int, gmm_peak_alias string")
    out = denoise_labels(reads, Settings()).toPandas()
    assert len(out) == len(rows) and out[out.gmm_peak_alias == "ITD_3"].label.isna().all()
    first, count = {}, {}
    for i, s in enumerate(seqs):
        first.setdefault(s, i)
        count[s] = count.get(s, 0) + 1
    unique = sorted(count, key=lambda s: (-count[s], first[s]))
    assert len(unique) > 2000
    owner = denoise(unique, [count[s] for s in unique], settings=Settings().denoiser)
    want = {s: f"c{o:04d}" for s, o in zip(unique, owner, strict=True)}
    assert len(set(owner)) == 3
    for peak in ("ITD_1", "ITD_2"):
        part = out[out.gmm_peak_alias == peak]
        assert part.label.tolist() == [want[s] for s in part.read_seq]


def test_denoise_in_a_task_as_by_rounds(spark):
    """Peaks below and above the size of a task get the same labels, with and without qualities."""
    from tandemlake.assay import Settings
    from tandemlake.operators.split import denoise_labels

    rng = random.Random(3)
    major = "".join(rng.choice("ACGT") for _ in range(80))
    minor = major[:30] + "".join("ACGT"[("ACGT".index(c) + 1) % 4] for c in major[30:36]) + major[36:]

    def wrong(s):
        i = rng.randrange(len(s))
        return s[:i] + rng.choice("ACGT".replace(s[i], "")) + s[i + 1 :]

    seqs = [major] * 200 + [minor] * 90 + [wrong(major) for _ in range(60)] + [wrong(minor) for _ in range(30)]
    rows = [(2 * i + k, s, len(s), p, rng.choice("5+I") * len(s) if k else None) for k, p in enumerate(("ITD_1", "ITD_2")) for i, s in enumerate(seqs)]
    reads = spark.createDataFrame(rows, "read_id long, read_seq string, read_len int, gmm_peak_alias string, read_qual string")
    label = lambda most: {r.read_id: r.label for r in denoise_labels(reads, Settings(), most).collect()}
    within = label(1 << 21)
    assert within == label(0)
    assert set(within.values()) == {"c0000", "c0001"}


def test_denoise_of_a_deep_peak_whose_errors_crowd_at_some_places():
    """Depth alone makes no centre of an error, where half of the places have all of them and mean qualities differ by row."""
    rng = random.Random(8)
    base = "".join(rng.choice("ACGT") for _ in range(300))
    errors = [base[:i] + "C" + base[i + 1 :] for i in range(40, 280, 4) if base[i] != "C"]
    quals = [bytes([30]) * 300] + [bytes([q % 7 + 27]) * 300 for q in range(len(errors))]
    for depth in (1, 100):
        assert set(denoise([base, *errors], [9000 * depth] + [8 * depth] * len(errors), quals=quals)) == {0}


def test_log_tail_against_exact_sums():
    """Poisson tails against sums of all terms that matter, for means from 1e-6 to 1e7 on both sides of the count."""
    from tandemlake.kernels.denoise import log_at_least, log_tail

    def exact(count, mean):
        reach = int(60 * math.sqrt(max(count, mean)) + 200)
        k = np.arange(count, max(count, int(mean)) + reach, dtype=float)
        logs = k * math.log(mean) - mean - np.concatenate([[math.lgamma(count + 1)], math.lgamma(count + 1) + np.cumsum(np.log(k[1:]))])
        return logs.max() + math.log(np.exp(logs - logs.max()).sum())

    cases = [(100, 950.0), (950, 100.0), (2, 1e-6), (1, 0.3), (5, 5.0), (10**5, 1.01e5), (10**6, 0.99e6), (10**7, 1e7), (10**7 - 20000, 1e7), (10**7 + 40000, 1e7), (3, 1e7)]
    for count, mean in cases:
        assert math.isclose(float(log_at_least(np.array([count]), np.array([mean]))[0]), min(exact(count, mean), 0), rel_tol=1e-6, abs_tol=1e-7)
    seen = log_tail(np.array([2.0, 1.0]), np.array([0.5, 1e-12]))
    assert math.isclose(seen[0], math.log((1 - 1.5 * math.exp(-0.5)) / (1 - math.exp(-0.5)))) and abs(seen[1]) < 1e-9


@pytest.mark.parametrize("depth", [1, 10, 100])
def test_deep_peaks_are_not_split(depth):
    """One true sequence with its one-base errors at uneven counts is one centre at every depth."""
    rng = np.random.default_rng(1)
    base = "".join(rng.choice(list("ACGT"), 60))
    errors = [base[:i] + c + base[i + 1 :] for i in range(60) for c in "ACGT" if c != base[i]]
    counts = [100_000 * depth] + [int(x) * depth for x in rng.integers(60, 220, len(errors))]
    assert set(denoise([base, *errors], counts)) == {0}


def test_banded_alignment_equals_the_full_matrix():
    """Scores against a cell-by-cell table with free ends and cheap gaps in homopolymers, where the band holds the best path;
    and a narrow band never scores more."""
    from tandemlake.kernels import denoise as d

    rng = random.Random(3)

    def full(c, s, gap_c, gap_s):
        h = [[0] * (len(s) + 1) for _ in range(len(c) + 1)]
        for i in range(1, len(c) + 1):
            for j in range(1, len(s) + 1):
                h[i][j] = max(h[i - 1][j - 1] + (d.MATCH if c[i - 1] == s[j - 1] else d.MISMATCH), h[i - 1][j] + gap_c[i - 1], h[i][j - 1] + gap_s[j - 1])
        return max(max(h[-1]), max(row[-1] for row in h))

    def gaps(s):
        x = d.in_homopolymer(d.codes([s])[0])[0]
        return [-1 if v else d.GAP for v in x]

    centre = "".join(rng.choice("ACGT") for _ in range(40)) + "AAAA" + "".join(rng.choice("ACGT") for _ in range(20))
    seqs = [centre]
    for _ in range(30):
        s = list(centre)
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(s))
            s[at : at + rng.randrange(2)] = rng.choice(["", "A", "CG", "T"])
        seqs.append("".join(s))
    c = d.codes([centre])[0][0]
    x, sizes = d.codes(seqs)
    beside, score = d.banded(c, x, sizes, 100, -1)
    assert score.tolist() == [full(centre, s, gaps(centre), gaps(s)) for s in seqs]
    assert beside[0].tolist() == c.tolist() + [4] * (x.shape[1] - len(c))
    assert (d.banded(c, x, sizes, 2, -1)[1] <= score).all()
    # alone or in a batch, a sequence has one alignment
    for i in (3, 9):
        one, size = d.codes([seqs[i]])
        assert d.banded(c, one, size, 5, -1)[0][0].tolist() == d.banded(c, x, sizes, 5, -1)[0][i][: len(seqs[i])].tolist()


def test_error_rates_and_chances():
    """Chances against a product over aligned bases; rates near those that made the reads, falling with quality."""
    from tandemlake.kernels import denoise as d

    rng = np.random.default_rng(6)
    base = "".join(rng.choice(list("ACGT"), 200))
    true = {q: 10 ** (-q / 10) for q in (10, 20, 30)}
    seqs, quals = [], []
    for _ in range(3000):
        q = rng.choice([10, 20, 30], 200)
        wrong = rng.random(200) < np.array([true[v] for v in q])
        seqs.append("".join("ACGT"[("ACGT".index(c) + rng.integers(1, 4)) % 4] if w else c for c, w in zip(base, wrong)))
        quals.append(bytes(q.astype(np.uint8)))
    beside = [d.codes([base])[0][0].tobytes()] * len(seqs)
    cells, _ = d.transitions(seqs, quals, beside)
    rates = d.error_rates(np.bincount(cells, minlength=16 * d.QUALITIES).reshape(4, 4, d.QUALITIES))
    for q, p in true.items():
        assert abs(1 - np.mean([rates[a, a, q] for a in range(4)]) - p) < 0.25 * p
    assert np.allclose(rates.sum(1), 1)
    got = d.log_chances(seqs[:20], quals[:20], beside[:20], rates)
    for s, q, v in zip(seqs[:20], quals[:20], got):
        assert math.isclose(v, sum(math.log(rates["ACGT".index(a), "ACGT".index(b), k]) for a, b, k in zip(base, s, q)))
    # the regression passes through a parabola
    x = np.arange(12.0)
    assert np.allclose(d.smooth(x, 2 - 0.3 * x + 0.05 * x * x, np.ones(12), x), 2 - 0.3 * x + 0.05 * x * x)


def test_rotations_against_all_of_them():
    from tandemlake.kernels.rotation import least_rotation, rotation_matches, rotational_identity
    from tandemlake.plans.evaluate import same_itd

    rng = random.Random(2)
    for _ in range(200):
        a = "".join(rng.choice("ACGTN") for _ in range(rng.randrange(1, 30)))
        b = "".join(rng.choice("ACGTN") for _ in range(rng.randrange(1, 30))) if rng.random() < 0.7 else a[len(a) // 3 :] + a[: len(a) // 3]
        turns = [a[i:] + a[:i] for i in range(len(a))]
        assert rotation_matches(a, b).tolist() == [sum(x == y and x != "N" for x, y in zip(t, b)) for t in turns]
        assert least_rotation(a) == min(turns)
        identity = max(sum(x == y and x != "N" for x, y in zip(t, b)) for t in turns) / max(len(a), len(b))
        assert math.isclose(rotational_identity(a, b), identity)
        pa, pb = rng.randrange(80), rng.randrange(80)
        near = min(abs(pa - pb), abs(pa - (pb - len(b))), abs(pa - len(a) - pb)) <= 4
        assert same_itd(a, b, pa, pb) == (abs(len(a) - len(b)) <= 2 and (b in turns or (near and identity >= 0.85)))
    assert least_rotation("") == "" and rotational_identity("", "A") == 0


def test_itd_pairs_join(spark):
    """Pairs of the join are those that same_itd accepts among all pairs."""
    from tandemlake.plans.evaluate import itd_pairs, same_itd

    rng = random.Random(7)
    seqs = [WT[p : p + n] for p in range(60, 200, 9) for n in (30, 31, 45)]
    truth = [(f"t{i}", s, rng.randrange(60, 200)) for i, s in enumerate(seqs)]
    calls = [(f"c{i}", s[k:] + s[:k] if i % 2 else s[: len(s) - 1], t[2] + rng.choice([0, 3, 4, 5, len(s), -len(s), 60])) for i, (t, s) in enumerate(zip(truth, seqs)) for k in (rng.randrange(len(s)),)]
    got = {tuple(r) for r in itd_pairs(spark.createDataFrame(truth, "name string, seq string, pos int"), spark.createDataFrame(calls, "call string, seq string, pos int")).collect()}
    assert got == {(n, c) for n, a, p in truth for c, b, q in calls if same_itd(b, a, q, p)} and len(got) > 20


def test_alignment_in_a_band_as_without_one():
    """A band is only believed where no path outside can be as good: the same blocks as the whole matrix, at every scoring."""
    from tandemlake.kernels import align as a

    rng = random.Random(4)

    def wrong(s, edits):
        for _ in range(edits):
            i, what = rng.randrange(len(s)), rng.random()
            s = s[:i] + (rng.choice("ACGT") if what < 0.4 else rng.choice("ACGT") * rng.randint(1, 4) + s[i:] if what < 0.7 else "") + s[i + 1 :]
            s = s or "A"
        return s

    for scoring in (a.VALIDATION, a.DISCOVERY, a.LOCATOR, a.Scoring(2, -1, -2, -1, -2, -1, -2, -1)):
        for letters in ("AC", "ACGT"):
            for size in (1, 9, 40, 90):
                target = "".join(rng.choice(letters) for _ in range(size))
                queries = [wrong(target, rng.randint(0, 6)) for _ in range(20)] + [wrong(target[:20] + target[5:], 2)]
                want = a.align_batch(target, queries, scoring, ())
                for bands in ((0, 1, 3), a.BANDS):
                    assert a.align_batch(target, queries, scoring, bands) == want


def test_alignment_of_long_reads_stays_in_its_band():
    """Reads of a few edits, against their own allele and another one, don't fill the whole matrix."""
    from tandemlake.kernels import align as a

    rng = random.Random(6)
    target = "".join(rng.choice("ACGT") for _ in range(330))
    reads = [target, target[:50] + "A" + target[51:200] + "C" + target[201:], target[:150] + target[105:150] + target[150:], target[:99] + target[100:]]
    whole, seen = a._align, []
    a._align = lambda *x: seen.append(x) or whole(*x)
    try:
        a.align_batch(target, reads, a.VALIDATION)
    finally:
        a._align = whole
    assert not seen
