"""Table functions for SQL: rows of a sequence, by LATERAL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from tandemlake.assay import WT
from tandemlake.kernels.align import DISCOVERY, align_batch, insertions


@udtf(returnType="aln_score double, pct_identity double, ins_pos_ref int, ins_len int, ins_seq string", useArrow=True)
class Insertions:
    """Each insertion of a sequence against the wild type, as operators.insertions.extract_insertions finds it; none for a null
    or empty sequence. Call it on distinct sequences: every call aligns one."""

    def eval(self, seq: str) -> Iterator[tuple]:
        if seq:
            (a,) = align_batch(WT, [seq], DISCOVERY)
            for at, q, n in insertions(a.blocks):
                yield a.score / 100, a.matches / a.aligned if a.aligned else 0.0, at, n, seq[q : q + n]


def register(spark: SparkSession) -> None:
    """Makes ``insertions_of(seq)`` known to SQL."""
    spark.udtf.register("insertions_of", Insertions)
