"""Column functions on DNA strings. Boundaries count bases before them, from 0."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LETTERS, _PARTNERS = "ACGTN", "TGCAN"


def _n(x: Column | int) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, _LETTERS, _PARTNERS))


def head(seq: Column, n: Column | int) -> Column:
    """The first n bases."""
    return F.substring(seq, F.lit(1), _n(n).cast("int"))


def tail(seq: Column, n: Column | int) -> Column:
    """All bases from boundary n on."""
    return F.substring(seq, _n(n).cast("int") + 1, F.length(seq))


def mid(seq: Column, start: Column | int, size: Column | int) -> Column:
    return F.substring(seq, _n(start).cast("int") + 1, _n(size).cast("int"))


def reconstruct_allele(ref: Column, pos: Column, inserted: Column) -> Column:
    """ref with a sequence inserted at a boundary; an error if the boundary lies outside."""
    whole = F.concat(head(ref, pos), inserted, tail(ref, pos))
    return F.when((pos < 0) | (pos > F.length(ref)), F.raise_error(F.lit("insertion boundary outside the reference"))).otherwise(whole)


def shared_prefix(a: Column, b: Column) -> Column:
    """Number of leading bases two sequences have in common, by halving steps: eleven comparisons up to 2047 bases."""
    n = F.least(F.length(a), F.length(b))
    steps = F.array(*[F.lit(1 << k) for k in range(10, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda p, s: F.when((p + s <= n) & (F.substring(a, F.lit(1), p + s) == F.substring(b, F.lit(1), p + s)), p + s).otherwise(p))


def boundary_interval(allele: Column, ref: Column) -> tuple[Column, Column]:
    """Least and greatest boundary where the allele can be ref with one insertion."""
    suffix = shared_prefix(F.reverse(allele), F.reverse(ref))
    return F.greatest(F.lit(0), F.length(ref) - suffix), F.least(F.length(ref), shared_prefix(allele, ref))


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two sequences of one length."""
    places = F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1)))
    return F.size(F.filter(places, lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))


def allele_id(allele: Column) -> Column:
    return F.substring(F.sha2(allele, 256), 1, 12)


@F.pandas_udf(T.DoubleType())
def mean_quality(qual: pd.Series) -> pd.Series:
    """Mean Phred value of a quality string; null if it is null or empty. In Arrow batches: a lambda over every character
    is interpreted and took ten times as long. Sums are whole numbers, all of a batch at once."""
    out, there = np.full(len(qual), np.nan), [i for i, q in enumerate(qual) if q]
    if there:
        texts = qual.iloc[there].tolist()
        raw, size = [q.encode() for q in texts], np.array([len(q) for q in texts])
        ends = np.cumsum([len(b) for b in raw])
        out[there] = (np.add.reduceat(np.frombuffer(b"".join(raw), np.uint8), np.append(0, ends[:-1]), dtype=np.int64) - 33 * size) / size
    return pd.Series(out)


def repaired_quality(seq: Column, qual: Column) -> Column:
    """The quality string, or Q40 throughout where its length isn't the sequence's."""
    return F.when(F.length(seq) == F.coalesce(F.length(qual), F.lit(-1)), qual).otherwise(F.repeat(F.lit("I"), F.length(seq)))


def is_resolved(seq: Column) -> Column:
    return seq.rlike("^[ACGT]*$")


def is_rotation(a: Column, b: Column) -> Column:
    return (F.length(a) == F.length(b)) & F.concat(a, a).contains(b)


def root_alias(alias: Column) -> Column:
    """An alias without the suffixes of its splits."""
    return F.regexp_replace(alias, "(_H[0-9]+(_[0-9]+)?)+$", "")


def genomic_position(pos: Column, start: int, length: int) -> Column:
    """1-based coordinate of the base before a boundary."""
    return F.lit(start) + F.least(F.greatest(pos, F.lit(1)), F.lit(length)) - 1


def insertion_blocks(blocks: Column) -> Column:
    """Insertions (t, q, size) between neighbouring blocks (t0, t1, q0, q1)."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(blocks) - 1, F.lit(1))), lambda i: F.struct(F.get(blocks, i - 1).alias("a"), F.get(blocks, i).alias("b")))
    gaps = F.transform(F.filter(pairs, lambda x: x.b.isNotNull()), lambda x: F.struct(x.a.t1.alias("t"), x.a.q1.alias("q"), ((x.b.q0 - x.a.q1) - (x.b.t0 - x.a.t1)).alias("size")))
    return F.filter(gaps, lambda g: g["size"] > 0)
