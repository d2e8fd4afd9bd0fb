"""Ranks within groups of any size: ordered ranges that are counted where they lie."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tandemlake.operators.lineage import stage


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds _i, a row's place in its group by ``order`` (from 0), and _n, the group's rows.

    Rows are cut into ranges of (group, order), each is counted by group, and a range's rows are numbered behind those of the
    ranges before it. So a group that holds most rows is spread over many ranges, and no task holds more than one."""
    keys = [F.col(group), *[F.col(c) for c in order]]
    ranges = stage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_range", F.spark_partition_id()))
    counts = ranges.groupBy(group, "_range").agg(F.count("*").alias("_rows"))
    by = Window.partitionBy(group)
    before = by.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col(group).alias("_g"), F.col("_range").alias("_r"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(by).alias("_n"))
    inner = Window.partitionBy(group, "_range").orderBy(*[F.col(c) for c in order])
    numbered = ranges.withColumn("_i", F.row_number().over(inner) - 1)
    both = numbered.join(base, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    return both.withColumn("_i", F.col("_i") + F.col("_before")).drop("_g", "_r", "_before", "_range")
