"""Times the headline queries and prints one line of JSON.

A query's time is the median of its runs, BENCH_RUNS of them, or of one where that took over SLOW seconds; calibration is the
time of a fixed loop of numpy and Python on one core before and after, which tells machines and their loads apart."""

from __future__ import annotations

import json
import os
import time
from statistics import median

import numpy as np
from pyspark.sql import SparkSession

from tandemlake.plans import catalogue

HEADLINE = [
    "length_histogram", "exact_primer_trim", "peak_band_assign", "boundary_interval", "anchor_locate", "observed_discovery", "dedup_with_counts", "panel_coverage", "weighted_consensus",
    "softmax_zscore", "rank_runner_up", "breakpoint_validate", "allele_frequency", "exact_itd_calls", "insertion_extract", "competitive_validation", "noisy_competition",
]


SLOW = 5.0


def calibrate() -> float:
    """Seconds of a fixed amount of work."""
    began = time.perf_counter()
    x = np.arange(1 << 20, dtype=np.float64)
    for _ in range(40):
        x = np.sqrt(x * 1.000001 + 1.0)
    total = 0
    for i in range(3_000_000):
        total += i & 7
    return time.perf_counter() - began


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    took, runs, before = {}, int(os.environ.get("BENCH_RUNS", "3")), calibrate()
    for name in HEADLINE:
        times: list[float] = []
        while len(times) < runs and (not times or times[0] <= SLOW):
            began = time.perf_counter()
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        took[name] = round(median(times), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "runs": runs, "calibration": [round(before, 3), round(calibrate(), 3)], "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0)}))
    spark.stop()


if __name__ == "__main__":
    main()
