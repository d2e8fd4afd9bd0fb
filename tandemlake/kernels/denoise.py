"""Divisive denoising of unique sequences by abundance, under an error model learned from the same reads.

Each sequence of a peak is aligned to the peak's centres in a band; the chance that a read of a centre comes out as this
sequence is the product of the rates of the substitutions between them, each at its base's quality (gaps tell nothing, as
long as the band can hold them). A sequence whose count is too large for its centre's reads, by a Poisson test, is a new
centre. Rates follow from the reads as they are assigned: counts by substitution and quality, smoothed over quality by
weighted local regression; partition and rates are fitted in turn until both stand still.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

#: Qualities that are told apart: 0 .. QUALITIES - 1.
QUALITIES = 64
#: Scores of the alignment, shared k-mers below which two sequences aren't compared, bounds of a rate, the
#: regression's span, and turns of partition and rates.
MATCH, MISMATCH, GAP = 5, -4, -8
WORD, WORD_DISTANCE = 5, 0.42
LEAST_RATE, MOST_RATE = 1e-7, 0.25
SPAN = 0.75
TURNS = 10
PATIENCE = 5
_LOW = -(1 << 28)

_CODE = np.full(256, 4, np.uint8)
_CODE[list(b"ACGT")] = range(4)
_CODE[list(b"acgt")] = range(4)


@dataclass(frozen=True)
class Denoiser:
    """Parameters. least_fold: rates are averages over places, so a centre has to exceed its expected count by a factor as
    well, at any depth. flat_fold: the same under the rates of all qualities together, for sequences seen more than once: places
    may err many times as often as the average, and few reads teach a rare quality's rates. An allele below ten times the rate of
    one substitution is less than the guardrails keep apart. singletons: where reads are nearly all unique, a sequence seen once may be a centre too. Its chance
    isn't conditioned on being seen, and has to be below the root of omega, since many have to agree: of those below, the one
    with the fewest expected errors begins, as long as all of them are least_reads and least_share of the peak's reads, and
    until PATIENCE such centres gathered too few."""

    omega: float = 1e-40
    band: int = 32
    homopolymer_gap: int = -1
    singletons: bool = False
    least_fold: float = 4.0
    flat_fold: float = 10.0
    least_reads: int = 20
    least_share: float = 0.15


def log_at_least(count: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Log of P(X >= count) of Poisson variables: the regularised lower incomplete gamma function, by its series where the mean
    is below the count and by the continued fraction of its complement beyond. Terms are added until they change nothing."""
    a, x = np.broadcast_arrays(np.asarray(count, float), np.asarray(mean, float))
    out = np.where(a <= 0, 0.0, -np.inf)
    todo = (a > 0) & (x > 0)
    log_gamma = np.vectorize(math.lgamma, otypes=[float])
    low = np.flatnonzero((todo & (x < a + 1)).ravel())
    if len(low):
        n, m = a.ravel()[low], x.ravel()[low]
        term, total, k = np.ones(len(low)), np.ones(len(low)), 0
        live = np.arange(len(low))
        while len(live):
            k += 1
            term[live] *= m[live] / (n[live] + k)
            total[live] += term[live]
            live = live[term[live] > 1e-17 * total[live]]
        out.ravel()[low] = n * np.log(m) - m - log_gamma(n + 1) + np.log(total)
    high = np.flatnonzero((todo & (x >= a + 1)).ravel())
    if len(high):
        n, m = a.ravel()[high], x.ravel()[high]
        b = m + 1 - n
        c, d = np.full(len(high), 1e300), 1 / b
        h, k, live = d.copy(), 0, np.arange(len(high))
        while len(live):
            k += 1
            f = -k * (k - n[live])
            b[live] += 2
            d[live] = 1 / (f * d[live] + b[live])
            c[live] = b[live] + f / c[live]
            change = c[live] * d[live]
            h[live] *= change
            live = live[np.abs(change - 1) > 1e-15]
        rest = np.exp(np.minimum(n * np.log(m) - m - log_gamma(n) + np.log(h), 0))
        out.ravel()[high] = np.log1p(-np.minimum(rest, 1 - 1e-16))
    return out


def log_tail(count: np.ndarray, mean: np.ndarray, seen: bool = True) -> np.ndarray:
    """Log of P(X >= count), given X >= 1 if ``seen``."""
    mean = np.asarray(mean, float)
    with np.errstate(divide="ignore"):
        return np.minimum(log_at_least(count, mean) - (np.log(-np.expm1(-mean)) if seen else 0.0), 0.0) if mean.size else np.zeros(0)


def codes(seqs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Base codes (A C G T: 0 to 3, all else 4), a row for each sequence, and their lengths."""
    sizes = np.array([len(s) for s in seqs], np.int64)
    out = np.full((len(seqs), int(sizes.max(initial=0))), 4, np.uint8)
    out[np.arange(out.shape[1]) < sizes[:, None]] = _CODE[np.frombuffer("".join(seqs).encode(), np.uint8)]
    return out, sizes


def in_homopolymer(x: np.ndarray, least: int = 3) -> np.ndarray:
    """Which bases of each row lie in a run of at least ``least``."""
    n, width = x.shape
    run = np.ones((n, width), np.int64)
    for j in range(1, width):
        run[:, j] += run[:, j - 1] * (x[:, j] == x[:, j - 1])
    for j in range(width - 2, -1, -1):
        run[:, j] = np.where(x[:, j] == x[:, j + 1], run[:, j + 1], run[:, j])
    return (run >= least) & (x < 4)


def banded(centre: np.ndarray, x: np.ndarray, sizes: np.ndarray, band: int, homopolymer_gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Best alignments of rows of codes to the centre, all at once: for each base the code of the centre's base beside it (4 where
    there is none), and the scores. Gaps at the ends are free; others cost less within a homopolymer of the sequence that has
    the base. ``band`` is how far the two may be shifted, beside the difference of their lengths."""
    n, (rows, width) = len(centre), x.shape
    below, above = band + np.maximum(n - sizes, 0), band + np.maximum(sizes - n, 0)
    lo, hi = int(below.max()), int(above.max())
    k = np.arange(lo + hi + 1)
    in_band = (k >= (lo - below)[:, None]) & (k <= (lo + above)[:, None])
    # bases and gap costs of the reads, so that row i of the band is a slice that starts at i
    pad = np.full((rows, lo + max(n, width) + hi + 2), 9, np.uint8)
    pad[:, lo + 1 : lo + 1 + width] = x
    cost = np.zeros((rows, pad.shape[1]), np.int32)
    cost[:, lo + 1 : lo + 1 + width] = np.where(in_homopolymer(x), homopolymer_gap, GAP)
    cost = np.cumsum(cost, axis=1, dtype=np.int32)
    down = np.where(in_homopolymer(centre[None]), homopolymer_gap, GAP)[0]
    at = np.arange(rows)
    score = np.where((k - lo >= 0) & (k - lo <= sizes[:, None]) & in_band, 0, _LOW).astype(np.int32)
    moves = np.empty((n, rows, len(k)), np.uint8)
    best, best_i = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    best_j = np.minimum(sizes, 0)
    for i in range(1, n + 1):
        bases = pad[:, i : i + len(k)]
        j = i + k - lo
        side = score + np.where(bases == centre[i - 1], MATCH, MISMATCH).astype(np.int32) if centre[i - 1] < 4 else score + np.int32(MISMATCH)
        above_ = np.full_like(score, _LOW)
        above_[:, :-1] = score[:, 1:] + np.int32(down[i - 1])
        here = np.maximum(side, above_)
        move = (above_ > side).astype(np.uint8)
        if lo - i >= 0:
            here[:, lo - i], move[:, lo - i] = 0, 3
        here[(j < 0) | (j > sizes[:, None]) | ~in_band] = _LOW
        gaps = cost[:, i : i + len(k)]
        across = np.maximum.accumulate(here - gaps, axis=1) + gaps
        across[(j > sizes[:, None]) | ~in_band] = _LOW
        move[across > here] = 2
        score, moves[i - 1] = across, move
        # the reads' last bases: what is left of the centre is free
        ends = sizes - i + lo
        ok = (ends >= 0) & (ends < len(k))
        value = np.where(ok, score[at, np.clip(ends, 0, len(k) - 1)], _LOW)
        better = value >= best
        best[better], best_i[better], best_j[better] = value[better], i, sizes[better]
    last = score.argmax(1)
    better = score[at, last] > best
    best[better], best_i[better], best_j[better] = score[at, last][better], n, (n + last - lo)[better]
    beside = np.full((rows, width), 4, np.uint8)
    i, j, live = best_i.copy(), best_j.copy(), np.flatnonzero((best_i > 0) & (best_j > 0))
    while len(live):
        a, b = i[live], j[live]
        m = moves[a - 1, live, b - a + lo]
        pair = live[m == 0]
        beside[pair, j[pair] - 1] = centre[i[pair] - 1]
        i[live] -= (m == 0) | (m == 1)
        j[live] -= (m == 0) | (m == 2)
        live = live[(m != 3) & (i[live] > 0) & (j[live] > 0)]
    return beside, best


def _words(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Counts of k-mers of A, C, G and T, a row for each sequence."""
    rows, width = x.shape
    value, ok = np.zeros((rows, max(width - WORD + 1, 0)), np.int64), np.ones((rows, max(width - WORD + 1, 0)), bool)
    for j in range(WORD):
        part = x[:, j : j + value.shape[1]]
        value = value * 4 + part
        ok &= part < 4
    flat = (np.arange(rows)[:, None] * 4**WORD + value)[ok]
    return np.bincount(flat, minlength=rows * 4**WORD).reshape(rows, 4**WORD)


def compare(centre: str, seqs: list[str], settings: Denoiser, size: int = 512) -> list[bytes | None]:
    """Of each sequence the centre's bases beside its own (see banded), or None if they share too few k-mers."""
    c, _ = codes([centre])
    own = _words(c, np.array([len(centre)]))[0]
    out: list[bytes | None] = []
    for a in range(0, len(seqs), size):
        x, sizes = codes(seqs[a : a + size])
        shared = np.minimum(_words(x, sizes), own).sum(1)
        most = np.maximum(np.minimum(sizes, len(centre)) - WORD + 1, 1)
        near = np.flatnonzero(1 - shared / most <= WORD_DISTANCE)
        found: list[bytes | None] = [None] * len(x)
        if len(near):
            beside, _ = banded(c[0], x[near], sizes[near], settings.band, settings.homopolymer_gap)
            for i, row in zip(near.tolist(), beside, strict=True):
                found[i] = row[: sizes[i]].tobytes()
        out += found
    return out


def transitions(seqs: list[str], quals: list[bytes], beside: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Cells (centre's base, base, quality), numbered, of all aligned pairs of bases; and the sequence that each is of."""
    there = [i for i, b in enumerate(beside) if b is not None]
    if not there:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    from_ = np.frombuffer(b"".join(beside[i] for i in there), np.uint8).astype(np.int64)
    to = _CODE[np.frombuffer("".join(seqs[i] for i in there).encode(), np.uint8)].astype(np.int64)
    q = np.minimum(np.frombuffer(b"".join(quals[i] for i in there), np.uint8), QUALITIES - 1).astype(np.int64)
    ok = (from_ < 4) & (to < 4)
    return ((from_ * 4 + to) * QUALITIES + q)[ok], np.repeat(there, [len(beside[i]) for i in there])[ok]


def log_chances(seqs: list[str], quals: list[bytes], beside: list[bytes | None], rates: np.ndarray) -> np.ndarray:
    """Log of the chance of each sequence as a read of the centre; minus infinity for those that weren't aligned."""
    cells, of = transitions(seqs, quals, beside)
    total = np.bincount(of, weights=np.log(rates).ravel()[cells], minlength=len(seqs))
    return np.where([b is None for b in beside], -np.inf, total)


def smooth(q: np.ndarray, y: np.ndarray, weight: np.ndarray, at: np.ndarray, span: float = SPAN) -> np.ndarray:
    """Weighted local quadratic regression of y on q at the points ``at``; flat beyond the ends of q."""
    points, place = np.unique(np.clip(at, q.min(), q.max()), return_inverse=True)
    out, least = np.empty(len(points)), min(len(q), max(3, math.ceil(span * len(q))))
    for i, x in enumerate(points):
        away = np.abs(q - x)
        reach = np.sort(away)[least - 1] * (1 + 1e-9) + 1e-9
        w = weight * np.clip(1 - (away / reach) ** 3, 0, None) ** 3
        degree = min(2, int((w > 0).sum()) - 1)
        if degree < 1:
            out[i] = (w * y).sum() / w.sum() if w.sum() > 0 else y[away.argmin()]
            continue
        design = np.stack([(q - x) ** d for d in range(degree + 1)], 1) * np.sqrt(w)[:, None]
        out[i] = np.linalg.lstsq(design, y * np.sqrt(w), rcond=None)[0][0]
    return out[place]


def error_rates(counts: np.ndarray) -> np.ndarray:
    """Rates [centre's base, base, quality] from counts of the same shape."""
    rates = np.empty(counts.shape)
    every = np.arange(counts.shape[2])
    for a in range(4):
        total = counts[a].sum(0)
        q = np.flatnonzero(total)
        for b in range(4):
            if b != a:
                if len(q):
                    fitted = smooth(q.astype(float), np.log10((counts[a, b, q] + 1) / total[q]), total[q].astype(float), every)
                    rates[a, b] = np.clip(10.0 ** np.clip(fitted, -20, 0), LEAST_RATE, MOST_RATE)
                else:
                    rates[a, b] = LEAST_RATE
        rates[a, a] = 1 - rates[a, [b for b in range(4) if b != a]].sum(0)
    return rates


def flat_rates(counts: np.ndarray) -> np.ndarray:
    """Rates from the same counts that are equal for all qualities: what few bases of a rare quality can't lead astray."""
    found = counts.sum(2).astype(float)
    total = np.maximum(found.sum(1), 1)
    rates = np.clip((found + 1) / total[:, None], LEAST_RATE, MOST_RATE)
    for a in range(4):
        rates[a, a] = 1 - rates[a, [b for b in range(4) if b != a]].sum()
    return np.repeat(rates[:, :, None], counts.shape[2], 2)


def levels(log_chance: np.ndarray) -> np.ndarray:
    """Whole numbers, 0 at most, in which log chances are counted."""
    return np.floor(np.maximum(log_chance, -9999)).astype(np.int64)


def first_level(counts: np.ndarray) -> int:
    """The level from which reads teach the first rates: twice as far down as the best quarter of those that differ from the
    centre, and ten more. counts: these at the levels 0, -1, ... . With all reads, another allele's would make rates under
    which it is no surprise."""
    return -2 * int(np.searchsorted(np.cumsum(counts), counts.sum() / 4)) - 10


def owners(log_chance: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The centre (a column) from which each row's sequence is expected most often; the first one on ties."""
    with np.errstate(divide="ignore"):
        return (log_chance + np.log(totals)).argmax(1)


def surplus(counts: np.ndarray, log_chance: np.ndarray, totals: np.ndarray, uniques: int, settings: Denoiser) -> np.ndarray:
    """Log of the chance of so many reads of a sequence, times the sequences tested; 0 where no centre may begin. log_chance
    and totals: of each sequence's own centre."""
    mean = totals * np.exp(log_chance)
    out = np.zeros(len(counts))
    for may, seen in ((counts > 1, True), ((counts == 1) & settings.singletons, False)):
        may = may & (counts > settings.least_fold * mean)
        if may.any():
            out[may] = np.minimum(log_tail(counts[may], np.maximum(mean[may], 1e-300), seen) + math.log(max(uniques, 1)), 0)
    return out


def expected_errors(quals: list[bytes]) -> np.ndarray:
    """Sum of the error chances that the qualities state."""
    q = np.frombuffer(b"".join(quals), np.uint8)
    return np.bincount(np.repeat(np.arange(len(quals)), [len(x) for x in quals]), weights=10.0 ** (-q / 10), minlength=len(quals))


def unlikely(value: np.ndarray, counts: np.ndarray, settings: Denoiser) -> np.ndarray:
    """Which sequences can't be errors, by their surplus."""
    return value < math.log(settings.omega) * np.where(counts > 1, 1.0, 0.5)


def not_expected(rows: np.ndarray, seqs: list[str], quals: list[bytes], beside: list[bytes | None], counts: np.ndarray, totals: np.ndarray, flat: np.ndarray, settings: Denoiser) -> np.ndarray:
    """Of the rows given (a mask) those that exceed their expected count under the flat rates by the flat fold as well, or
    are seen once. beside, totals: of each sequence's own centre."""
    out, test = rows.copy(), np.flatnonzero(rows & (counts > 1))
    if len(test):
        chance = log_chances([seqs[i] for i in test], [quals[i] for i in test], [beside[i] for i in test], flat)
        out[test] = counts[test] > settings.flat_fold * totals[test] * np.exp(chance)
    return out


def may_search(part: Partition, apart: int, reads: int, settings: Denoiser) -> bool:
    """May a sequence seen once begin a centre: ``apart`` of the peak's reads can't be errors of its centres."""
    failed = sum(t < settings.least_reads for t, once in zip(part.totals, part.once, strict=True) if once)
    return failed < PATIENCE and apart >= max(settings.least_reads, settings.least_share * reads)


@dataclass
class Partition:
    """Centres of a peak in the order in which they began, with the reads that each has."""

    centres: list
    totals: np.ndarray
    rates: np.ndarray = field(default_factory=lambda: np.full((4, 4, QUALITIES), MOST_RATE))
    once: list[bool] = field(default_factory=lambda: [False])
    flat: np.ndarray = field(default_factory=lambda: np.full((4, 4, QUALITIES), MOST_RATE))

    def add(self, centre, count: int) -> None:
        self.centres, self.totals, self.once = [*self.centres, centre], np.append(self.totals, count), [*self.once, count == 1]


def denoise(seqs: list[str], counts: list[int], omega: float = 1e-40, quals: list[bytes] | None = None, settings: Denoiser | None = None) -> list[int]:
    """The centre (an index) of each unique sequence, all in memory: what operators.split does over tables."""
    settings = settings or Denoiser(omega=omega)
    quals = quals or [bytes(len(s)) for s in seqs]
    n = np.array(counts, np.int64)
    order = sorted(range(len(seqs)), key=lambda i: (-counts[i], seqs[i]))
    if len(order) < 2:
        return list(range(len(seqs)))
    beside: dict[int, list[bytes | None]] = {}
    columns: dict[int, np.ndarray] = {}  # chances under the rates of the turn

    def column(c: int, rates: np.ndarray) -> np.ndarray:
        if c not in beside:
            beside[c] = compare(seqs[c], seqs, settings)
        if c not in columns:
            columns[c] = log_chances(seqs, quals, beside[c], rates)
        return columns[c]

    def chance(centres: list[int], rates: np.ndarray) -> np.ndarray:
        out = np.stack([column(c, rates) for c in centres], 1)
        for k, c in enumerate(centres):
            out[c] = -np.inf  # a centre is its own
            out[c, k] = 0
        return out

    def learn(centres: list[int], owner: np.ndarray) -> np.ndarray:
        total = np.zeros(16 * QUALITIES)
        for k, c in enumerate(centres):
            mine = np.flatnonzero(owner == k)
            cells, of = transitions([seqs[i] for i in mine], [quals[i] for i in mine], [beside[c][i] for i in mine])
            total += np.bincount(cells, weights=n[mine][of], minlength=len(total))
        return total.reshape(4, 4, QUALITIES)

    first = [order[0]]
    beside[order[0]] = compare(seqs[order[0]], seqs, settings)
    rates = error_rates(learn(first, np.zeros(len(seqs), int)))
    level = levels(chance(first, rates)[:, 0])
    others = np.where(np.arange(len(n)) == order[0], 0, n)
    cells = learn(first, np.where(level >= first_level(np.bincount(-level, weights=others)), 0, -1))
    rates, flat = error_rates(cells), flat_rates(cells)
    found: list[int] = []
    errors = expected_errors(quals)
    for _ in range(TURNS):
        columns.clear()
        part = Partition(list(first), np.array([n.sum()]))
        while True:
            p = chance(part.centres, rates)
            taught = owners(p, part.totals)
            part.totals = np.bincount(taught, weights=n, minlength=len(part.centres))
            owner = owners(p, part.totals)
            of = part.totals[owner]
            value = surplus(n, p[np.arange(len(n)), owner], of, len(seqs), settings)
            below = unlikely(value, n, settings)
            below[part.centres] = False
            below = not_expected(below, seqs, quals, [beside[part.centres[k]][i] for i, k in enumerate(owner.tolist())], n, of, flat, settings)
            new = [i for i in order if below[i]]
            often, once = [i for i in new if n[i] > 1], [i for i in new if n[i] == 1]
            if often:
                best = min(often, key=lambda i: value[i])
            elif once and may_search(part, len(once), int(n.sum()), settings):
                best = min(once, key=lambda i: errors[i])
            else:
                break
            part.add(best, int(n[best]))
        cells = learn(part.centres, taught)
        before, rates, flat = rates, error_rates(cells), flat_rates(cells)
        if part.centres == found and np.allclose(np.log(before), np.log(rates), atol=1e-3):
            break
        found = part.centres
    return [part.centres[k] for k in owner]
