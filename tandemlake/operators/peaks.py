"""Length peaks: mixture on the length histogram, merging, assignment, aliases, length refinement."""

from __future__ import annotations


import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tandemlake.assay import Settings
from tandemlake.functions.statistics import law_of_total_variance
from tandemlake.kernels import mixture
from tandemlake.operators.lineage import cut

PEAK_SCHEMA = "orig_id int, mean_bp double, sd_bp double, fraction double"


def component_filter(peaks: DataFrame, min_fraction: float, max_sd: float) -> DataFrame:
    return peaks.where((F.col("fraction") >= min_fraction) & (F.col("sd_bp") < max_sd))


def merge_close(rows: list[dict], distance: float) -> list[dict]:
    """Components by ascending mean; each joins the open group if it lies within ``distance`` of the group's first member.
    Groups pool by the law of total variance. At most a handful of rows, on the driver."""
    groups: list[list[dict]] = []
    for r in sorted(rows, key=lambda r: r["mean_bp"]):
        if groups and r["mean_bp"] - groups[-1][0]["mean_bp"] < distance:
            groups[-1].append(r)
        else:
            groups.append([r])
    out = []
    for g in groups:
        mean, sd = law_of_total_variance([r["fraction"] for r in g], [r["mean_bp"] for r in g], [r["sd_bp"] for r in g])
        out.append({"orig_id": min(r["orig_id"] for r in g), "members": [r["orig_id"] for r in g], "mean_bp": mean, "sd_bp": sd, "fraction": sum(r["fraction"] for r in g)})
    return out


def fit_components(histogram: DataFrame, settings: Settings) -> list[dict]:
    """Components of the mixture of the lowest BIC. The histogram has a row for each length in the read-length band, so its
    size is bounded by the settings, whatever the number of reads."""
    rows = histogram.where(F.col("read_len").between(0, settings.max_read_length)).orderBy("read_len").collect()
    if not rows:
        return []
    x, n = np.array([r.read_len for r in rows]), np.array([r.n for r in rows])
    mean, sd, share = mixture.select(x, n, settings.max_itds + 1, settings.force_k)
    return [{"orig_id": i, "mean_bp": float(m), "sd_bp": float(s), "fraction": float(f)} for i, (m, s, f) in enumerate(zip(mean, sd, share, strict=True))]


def band_assign(lengths: DataFrame, peaks: DataFrame, width: float = 2.0) -> DataFrame:
    """read_len, n_peaks, orig_id (of the only peak within width deviations), is_ambiguous. One row for each distinct
    length, so the range join is at most hundreds of rows by a handful of peaks."""
    near = lengths.select("read_len").distinct().join(F.broadcast(peaks), F.abs(F.col("read_len") - F.col("mean_bp")) <= width * F.col("sd_bp"), "left")
    g = near.groupBy("read_len").agg(F.count("orig_id").alias("n_peaks"), F.min("orig_id").alias("orig_id"))
    return g.select("read_len", "n_peaks", F.when(F.col("n_peaks") == 1, F.col("orig_id")).alias("orig_id"), (F.col("n_peaks") > 1).alias("is_ambiguous"))


def _log_density(x: Column) -> Column:
    return F.log("fraction") - F.log("sd_bp") - F.pow((x - F.col("mean_bp")) / F.col("sd_bp"), 2) / 2


def posterior_assign(lengths: DataFrame, peaks: DataFrame, threshold: float = 0.85) -> DataFrame:
    """read_len, orig_id, confidence: the likeliest peak of each distinct length if its posterior reaches the threshold."""
    scored = lengths.select("read_len").distinct().crossJoin(F.broadcast(peaks)).withColumn("_l", _log_density(F.col("read_len")))
    w = Window.partitionBy("read_len")
    scored = scored.withColumn("_e", F.exp(F.col("_l") - F.max("_l").over(w))).withColumn("p", F.col("_e") / F.sum("_e").over(w))
    best = scored.groupBy("read_len").agg(F.max_by(F.struct("orig_id", "p"), F.struct(F.col("p"), -F.col("orig_id"))).alias("b"))
    return best.select("read_len", F.when(F.col("b.p") >= threshold, F.col("b.orig_id")).alias("orig_id"), F.col("b.p").alias("confidence"))


def assign_reads(reads: DataFrame, components: list[dict], peaks: list[dict], settings: Settings) -> DataFrame:
    """Adds gmm_peak, confidence, is_ambiguous and gmm_peak_alias; keeps assigned, unambiguous reads. Modes: manual
    (bands), predict_proba (posteriors of the components), hybrid (bands that the posterior confirms)."""
    spark = reads.sparkSession
    merged = spark.createDataFrame([(p["orig_id"], p["mean_bp"], p["sd_bp"], p["fraction"], p["alias"]) for p in peaks], PEAK_SCHEMA + ", alias string")
    lengths = reads.select("read_len").distinct()
    table = band_assign(lengths, merged, settings.assign_width_factor).withColumn("confidence", F.lit(None).cast("double"))
    if settings.assign_mode != "manual":
        parts = spark.createDataFrame([(c["orig_id"], c["mean_bp"], c["sd_bp"], c["fraction"]) for c in components], PEAK_SCHEMA)
        owner = spark.createDataFrame([(m, p["orig_id"]) for p in peaks for m in p["members"]], "member int, owner int")
        post = posterior_assign(lengths, parts, settings.prob_threshold).join(F.broadcast(owner), F.col("orig_id") == F.col("member"), "left").select("read_len", F.col("owner").alias("p_id"), F.col("confidence").alias("p"))
        both = table.join(post, "read_len")
        if settings.assign_mode == "predict_proba":
            table = both.select("read_len", F.col("p_id").alias("orig_id"), F.lit(False).alias("is_ambiguous"), F.col("p").alias("confidence"))
        else:
            agree = F.col("orig_id").isNotNull() & F.col("orig_id").eqNullSafe(F.col("p_id"))
            table = both.select("read_len", F.when(agree, F.col("orig_id")).alias("orig_id"), (F.col("is_ambiguous") | (F.col("orig_id").isNotNull() & ~agree)).alias("is_ambiguous"), F.col("p").alias("confidence"))
    table = table.join(F.broadcast(merged.select("orig_id", "alias")), "orig_id").where("not is_ambiguous")
    # a row for each length; each later pass over the reads would make it again, from passes over all of them
    table = cut(table.select("read_len", F.col("orig_id").alias("gmm_peak"), "confidence", "is_ambiguous", F.col("alias").alias("gmm_peak_alias")))
    return reads.join(F.broadcast(table), "read_len")


def name_peaks(peaks: list[dict], settings: Settings) -> list[dict]:
    """Aliases by ascending mean; the closest peak within tolerance of the wild-type length is WT and keeps its number."""
    ordered = sorted(peaks, key=lambda p: p["mean_bp"])
    close = min(ordered, key=lambda p: abs(p["mean_bp"] - settings.wt_amplicon_length), default=None)
    wt = close if close and abs(close["mean_bp"] - settings.wt_amplicon_length) <= settings.wt_peak_tolerance else None
    base = wt["mean_bp"] if wt else float(settings.wt_amplicon_length)
    return [p | {"alias": "WT" if p is wt else f"ITD_{i}", "is_wt": p is wt, "putative_itd_size": p["mean_bp"] - base} for i, p in enumerate(ordered)]


def effective_counts(assigned: DataFrame) -> DataFrame:
    """gmm_peak_alias, effective_read_count and its share of all assigned reads."""
    counts = assigned.groupBy("gmm_peak_alias").agg(F.count("*").alias("effective_read_count"))
    return counts.withColumn("effective_allele_freq", F.col("effective_read_count") / F.sum("effective_read_count").over(Window.partitionBy(F.lit(0))))


def fit_length_peaks(reads: DataFrame, settings: Settings) -> tuple[list[dict], DataFrame]:
    """Named peaks and the assigned reads. Raises ValueError if no component passes the filter."""
    components = fit_components(reads.groupBy("read_len").agg(F.count("*").alias("n")), settings)
    kept = [c for c in components if c["fraction"] >= settings.min_gmm_fraction and c["sd_bp"] < settings.max_peak_sd]
    if not kept:
        raise ValueError("no length peak passes the component filter")
    peaks = name_peaks(merge_close(kept, settings.min_gmm_peak_distance), settings)
    assigned = assign_reads(reads, components, peaks, settings)
    counts = {r.gmm_peak_alias: (r.effective_read_count, r.effective_allele_freq) for r in effective_counts(assigned).collect()}
    return [p | dict(zip(("effective_read_count", "effective_allele_freq"), counts.get(p["alias"], (0, 0.0)), strict=True)) for p in peaks], assigned


def refine_length(histogram: list[tuple[int, int]], min_gain: float = 10, min_gap: float = 3, max_sd: float = 5, min_fraction: float = 0.15, min_reads: int = 150) -> list[tuple[float, float, float]]:
    """One peak's lengths as one component or, if two are clearly better, two: (mean, sd, share) of each."""
    x, n = np.array([a for a, _ in histogram]), np.array([b for _, b in histogram])
    one = mixture.fit(x, n, 1)
    whole = [(float(one[1][0]), float(one[2][0]), 1.0)]
    if n.sum() < min_reads or len(x) < 2:
        return whole
    two = mixture.fit(x, n, 2)
    gain = mixture.bic(one[0], 1, n.sum()) - mixture.bic(two[0], 2, n.sum())
    good = gain >= min_gain and two[1][1] - two[1][0] >= min_gap and (two[2] <= max_sd).all() and (two[3] >= min_fraction).all()
    return [(float(m), float(s), float(f)) for m, s, f in zip(*two[1:], strict=True)] if good else whole


def window_floor(alias: str, sizes: dict[str, float], distance: float) -> float:
    """Least half-width of a peak's insertion-size window: the merge distance, at most half way to any other ITD peak."""
    if alias not in sizes:
        return float(distance)
    return min([float(distance), *(abs(s - sizes[alias]) / 2 for a, s in sizes.items() if a != alias)])


def size_windows(peaks: DataFrame, distance: float, factor: float, low: float, high: float) -> DataFrame:
    """peak_alias, window_floor, size_min, size_max of each ITD peak; empty windows go."""
    itd = peaks.where(F.upper("peak_alias") != "WT")
    other = itd.select(F.col("peak_alias").alias("o_alias"), F.col("putative_itd_size").alias("o_size"))
    near = itd.join(F.broadcast(other), F.col("peak_alias") != F.col("o_alias"), "left").groupBy("peak_alias").agg(F.min(F.abs(F.col("o_size") - F.col("putative_itd_size")) / 2).alias("half"))
    w = itd.join(near, "peak_alias").withColumn("window_floor", F.least(F.lit(float(distance)), F.coalesce("half", F.lit(float(distance)))))
    half = F.greatest(F.col("sd_bp") * factor, F.col("window_floor"))
    w = w.select("peak_alias", "window_floor", F.greatest(F.col("putative_itd_size") - half, F.lit(float(low))).alias("size_min"), F.least(F.col("putative_itd_size") + half, F.lit(float(high))).alias("size_max"))
    return w.where("size_min <= size_max")


def peaks_frame(spark: SparkSession, peaks: list[dict]) -> DataFrame:
    rows = [(p["alias"], p["mean_bp"], p["sd_bp"], p["fraction"], int(p.get("effective_read_count", 0)), float(p.get("effective_allele_freq", 0.0)), p["putative_itd_size"], p["is_wt"]) for p in peaks]
    return spark.createDataFrame(rows, "peak_alias string, mean_bp double, sd_bp double, fraction double, effective_read_count long, effective_allele_freq double, putative_itd_size double, is_wt boolean")

