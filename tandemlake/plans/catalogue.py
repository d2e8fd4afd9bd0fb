"""Queries over reads derived from orders, and the same queries in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tandemlake import fixtures
from tandemlake.assay import AMPLICON, EXTRACTION, FORWARD_PRIMER, REVERSE_PRIMER, WT, Settings, anchor_coordinates, exons, reverse_complement
from tandemlake.fixtures import reads, with_reads
from tandemlake.functions import sequence as S
from tandemlake.operators import consensus, figures, insertions, observed, peaks, quantify, validation
from tandemlake.operators import reads as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def long(name: str):
    return F.col(name).cast("long").alias(name)


# Parameters of queries on fixed peaks: id, mean, deviation, share, alias.
PEAKS = [(0, 336.0, 1.0, 0.55, "WT"), (1, 366.0, 1.0, 0.08, "ITD_1"), (2, 381.0, 1.0, 0.37, "ITD_2")]
PEAKS_SQL = "peaks AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {m}::DOUBLE, {s}::DOUBLE, {f}::DOUBLE, '{a}')" for i, m, s, f, a in PEAKS) + ") v(orig_id, mean_bp, sd_bp, fraction, alias))"
# components as the reads of each allele have them
COMPONENTS_SQL = ", comps AS (SELECT row_number() OVER (ORDER BY avg(read_len), haplotype) - 1 AS orig_id, avg(read_len) AS mean_bp, stddev_pop(read_len) AS sd_bp, count(*) / (SELECT count(*) FROM reads)::DOUBLE AS fraction FROM reads GROUP BY haplotype)"
SETTINGS = Settings()
START, STOP = anchor_coordinates(len(WT), SETTINGS.anchor_length, SETTINGS.anchor_shift)
LEFT, RIGHT = WT[START : START + 20], WT[STOP - 20 : STOP]


def fixed_peaks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PEAKS, peaks.PEAK_SCHEMA + ", alias string")


# --- scans and reads ----------------------------------------------------------------------------------------------

_ALIGNED = ", aligned AS (SELECT read_id, mapq, CASE WHEN read_id % 17 = 0 THEN 4 WHEN strand = '-' THEN 16 ELSE 0 END + CASE WHEN read_id % 23 = 0 THEN 2048 ELSE 0 END AS flag, 28034500 + read_id % 900 AS pos, 28034500 + read_id % 900 + read_len - 1 AS pos_end, read_seq AS seq, read_qual AS qual FROM reads)"


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reads(spark, sf_dir)
    flag = F.when(F.col("read_id") % 17 == 0, 4).when(F.col("strand") == "-", 16).otherwise(0) + F.when(F.col("read_id") % 23 == 0, 2048).otherwise(0)
    pos = F.lit(28034500) + F.col("read_id") % 900
    return r.select("read_id", "mapq", flag.alias("flag"), pos.alias("pos"), (pos + F.col("read_len") - 1).alias("pos_end"), F.col("read_seq").alias("seq"), F.col("read_qual").alias("qual"))


@query(with_reads(f"{_ALIGNED} SELECT read_id, CAST(flag AS BIGINT) AS flag, CAST(pos AS BIGINT) AS pos FROM aligned WHERE flag & 4 = 0 AND mapq >= 20 AND pos <= {EXTRACTION['hg38'][1]} AND pos_end >= {EXTRACTION['hg38'][0]}"))
def region_scan(spark, sf_dir):
    return R.region_scan(aligned(spark, sf_dir), *EXTRACTION["hg38"], 20).select("read_id", long("flag"), long("pos"))


@query(with_reads(f"{_ALIGNED} SELECT read_id, CASE WHEN flag & 16 <> 0 THEN reverse(translate(seq, 'ACGTN', 'TGCAN')) ELSE seq END AS seq, CASE WHEN flag & 16 <> 0 THEN reverse(qual) ELSE qual END AS qual FROM aligned WHERE flag & 2304 = 0"))
def revcomp_orient(spark, sf_dir):
    return R.restore_orientation(aligned(spark, sf_dir)).select("read_id", "seq", "qual")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, n_rows FROM (SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC) AS k, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n_rows FROM lineitem) WHERE k = 1")
def dedup_last_read(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate", "l_partkey")
    return R.keep_last(rows, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate"), F.col("l_extendedprice"), F.col("l_partkey")]).select("l_orderkey", "l_linenumber", "l_extendedprice", "n_rows")


@query(with_reads("SELECT read_id, CAST(read_len AS BIGINT) AS read_len FROM reads WHERE read_len BETWEEN 336 AND 380"))
def length_filter(spark, sf_dir):
    return R.length_band(reads(spark, sf_dir), 336, 380).select("read_id", long("read_len"))


@query(with_reads("SELECT CAST(read_len AS BIGINT) AS read_len, count(*) AS n FROM reads GROUP BY 1"))
def length_histogram(spark, sf_dir):
    return R.length_histogram(reads(spark, sf_dir)).select(long("read_len"), "n")


_FWD = reverse_complement(FORWARD_PRIMER)
_JUNK = ", raw AS (SELECT read_id, CASE WHEN strand = '-' THEN reverse(translate(s, 'ACGTN', 'TGCAN')) ELSE s END AS s FROM (SELECT read_id, strand, concat(substr('GATTACAGATTACA', 1, CAST(read_id % 7 AS INT) + 1), read_seq, substr('CCATTGGC', 1, CAST(read_id % 5 AS INT) + 1)) AS s FROM reads))"


def flanked(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reads(spark, sf_dir)
    s = F.concat(S.mid(F.lit("GATTACAGATTACA"), 0, F.col("read_id") % 7 + 1), F.col("read_seq"), S.mid(F.lit("CCATTGGC"), 0, F.col("read_id") % 5 + 1))
    return r.select("read_id", F.when(F.col("strand") == "-", S.reverse_complement(s)).otherwise(s).alias("read_seq"), F.lit(None).cast("string").alias("read_qual"))


def _cut_sql(s: str) -> str:
    a, b = f"instr({s}, '{REVERSE_PRIMER}')", f"instr(reverse({s}), '{_FWD[::-1]}')"
    return f"CASE WHEN {a} > 0 AND {b} > 0 AND length({s}) - {b} + 1 - {a} + 1 >= {len(REVERSE_PRIMER) + len(_FWD)} THEN substr({s}, {a}, length({s}) - {b} + 1 - {a} + 1) END"


@query(with_reads(f"{_JUNK}, c AS (SELECT read_id, {_cut_sql('s')} AS f, {_cut_sql('r')} AS b FROM (SELECT read_id, s, reverse(translate(s, 'ACGTN', 'TGCAN')) AS r FROM raw)) SELECT read_id, coalesce(f, b) AS trimmed, CASE WHEN f IS NOT NULL THEN '+' ELSE '-' END AS strand FROM c WHERE coalesce(f, b) IS NOT NULL"))
def exact_primer_trim(spark, sf_dir):
    return R.exact_primer_trim(flanked(spark, sf_dir)).select("read_id", "trimmed", "strand")


# every derived read has at most one edit, so both primers are found at its ends, whatever stands beside them
@query(with_reads(f"{_JUNK} SELECT strand, CAST(read_len AS BIGINT) AS read_len, count(DISTINCT s) AS n FROM raw JOIN reads USING (read_id) GROUP BY 1, 2"))
def primer_trim(spark, sf_dir):
    """Approximate primers."""
    raw = flanked(spark, sf_dir)
    distinct = raw.groupBy("read_seq").agg(F.min("read_id").alias("read_id")).withColumn("read_qual", F.lit(None).cast("string"))
    return R.trim_primers(distinct, SETTINGS).groupBy("strand", long("read_len")).agg(F.count("*").alias("n"))


@query(with_reads("SELECT read_id, round(list_sum(list_transform(range(1, length(read_qual) + 1), lambda i: ascii(substr(read_qual, CAST(i AS INT), 1)) - 33)) / length(read_qual), 6) AS mean_q FROM reads"))
def mean_quality(spark, sf_dir):
    return reads(spark, sf_dir).select("read_id", F.round(S.mean_quality(F.col("read_qual")), 6).alias("mean_q"))


@query(with_reads("SELECT read_id, CASE WHEN read_id % 3 = 0 THEN repeat('I', length(read_seq)) ELSE read_qual END AS qual FROM reads WHERE length(read_seq) > 0"))
def quality_repair(spark, sf_dir):
    broken = F.when(F.col("read_id") % 3 == 0, F.lit("5")).otherwise(F.col("read_qual"))
    return reads(spark, sf_dir).where(F.length("read_seq") > 0).select("read_id", S.repaired_quality(F.col("read_seq"), broken).alias("qual"))


@query(with_reads("SELECT strand, count(*) AS n_reads, count(DISTINCT read_id) AS n_ids, count(*) FILTER (WHERE mapq >= 20) AS n_good FROM reads GROUP BY strand"))
def strand_totals(spark, sf_dir):
    return reads(spark, sf_dir).groupBy("strand").agg(F.count("*").alias("n_reads"), F.countDistinct("read_id").alias("n_ids"), F.count_if(F.col("mapq") >= 20).alias("n_good"))


# --- peaks --------------------------------------------------------------------------------------------------------

_BAND = f", {PEAKS_SQL}, band AS (SELECT l.read_len, count(orig_id) AS n_peaks, min(orig_id) AS oid FROM (SELECT DISTINCT read_len FROM reads) l LEFT JOIN peaks ON abs(l.read_len - mean_bp) <= 2 * sd_bp GROUP BY 1)"


@query(with_reads(f"{_BAND} SELECT CAST(read_len AS BIGINT) AS read_len, n_peaks, CASE WHEN n_peaks = 1 THEN CAST(oid AS BIGINT) END AS orig_id, n_peaks > 1 AS is_ambiguous FROM band"))
def peak_band_assign(spark, sf_dir):
    return peaks.band_assign(reads(spark, sf_dir), fixed_peaks(spark)).select(long("read_len"), "n_peaks", long("orig_id"), "is_ambiguous")


def _by_peak(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    parts = [{"orig_id": i, "members": [i], "mean_bp": m, "sd_bp": s, "fraction": f, "alias": a} for i, m, s, f, a in PEAKS]
    return peaks.assign_reads(reads(spark, sf_dir) if of is None else of, parts, parts, SETTINGS)


_ASSIGNED = f"{_BAND}, assigned AS (SELECT r.*, p.alias AS gmm_peak_alias FROM reads r JOIN band b USING (read_len) JOIN peaks p ON p.orig_id = b.oid WHERE b.n_peaks = 1)"


@query(with_reads(f"{_ASSIGNED} SELECT gmm_peak_alias, count(*) AS effective_read_count, round(count(*) / sum(count(*)) OVER (), 6) AS effective_allele_freq FROM assigned GROUP BY 1"))
def peak_effective_counts(spark, sf_dir):
    return peaks.effective_counts(_by_peak(spark, sf_dir)).withColumn("effective_allele_freq", F.round("effective_allele_freq", 6))


@query(with_reads(f", {PEAKS_SQL}, s AS (SELECT l.read_len, orig_id, ln(fraction) - ln(sd_bp) - power((l.read_len - mean_bp) / sd_bp, 2) / 2 AS lp FROM (SELECT DISTINCT read_len FROM reads) l, peaks), m AS (SELECT *, max(lp) OVER (PARTITION BY read_len) AS top FROM s), e AS (SELECT read_len, orig_id, exp(lp - top) / sum(exp(lp - top)) OVER (PARTITION BY read_len) AS p FROM m), k AS (SELECT *, row_number() OVER (PARTITION BY read_len ORDER BY p DESC, orig_id) AS rn FROM e) SELECT CAST(read_len AS BIGINT) AS read_len, CASE WHEN p >= 0.85 THEN CAST(orig_id AS BIGINT) END AS orig_id, round(p, 6) AS confidence FROM k WHERE rn = 1"))
def peak_posterior_assign(spark, sf_dir):
    return peaks.posterior_assign(reads(spark, sf_dir), fixed_peaks(spark)).select(long("read_len"), long("orig_id"), F.round("confidence", 6).alias("confidence"))


def _components(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reads(spark, sf_dir)
    total = r.agg(F.count("*").alias("total"))
    each = r.groupBy("haplotype").agg(F.avg("read_len").alias("mean_bp"), F.stddev_pop("read_len").alias("sd_bp"), F.count("*").alias("n")).crossJoin(F.broadcast(total))
    numbered = each.withColumn("orig_id", (F.row_number().over(Window.orderBy("mean_bp", "haplotype")) - 1).cast("int"))  # a row for each allele
    return numbered.select("orig_id", "mean_bp", "sd_bp", (F.col("n") / F.col("total")).alias("fraction"))


@query(with_reads(COMPONENTS_SQL + " SELECT CAST(orig_id AS BIGINT) AS orig_id, round(mean_bp, 6) AS mean_bp, round(sd_bp, 6) AS sd_bp, round(fraction, 6) AS fraction FROM comps WHERE fraction >= 0.06 AND sd_bp < 5"))
def component_filter(spark, sf_dir):
    return peaks.component_filter(_components(spark, sf_dir), 0.06, 5.0).select(long("orig_id"), *[F.round(c, 6).alias(c) for c in ("mean_bp", "sd_bp", "fraction")])


@query(with_reads(COMPONENTS_SQL + ", o AS (SELECT *, row_number() OVER (ORDER BY mean_bp) AS k FROM comps WHERE fraction >= 0.01 AND sd_bp < 5), g AS (SELECT k, mean_bp, sd_bp, fraction, mean_bp AS head FROM o WHERE k = 1 UNION ALL SELECT o.k, o.mean_bp, o.sd_bp, o.fraction, CASE WHEN o.mean_bp - g.head < 10 THEN g.head ELSE o.mean_bp END FROM g JOIN o ON o.k = g.k + 1), m AS (SELECT head, sum(fraction) AS fraction, sum(fraction * mean_bp) / sum(fraction) AS mean_bp FROM g GROUP BY head) SELECT round(m.mean_bp, 6) AS mean_bp, round(sqrt(sum(g.fraction * (g.sd_bp * g.sd_bp + power(g.mean_bp - m.mean_bp, 2))) / max(m.fraction)), 6) AS sd_bp, round(max(m.fraction), 6) AS fraction FROM g JOIN m USING (head) GROUP BY m.mean_bp").replace("WITH ", "WITH RECURSIVE ", 1))
def peak_merge_total_variance(spark, sf_dir):
    kept = peaks.component_filter(_components(spark, sf_dir), 0.01, 5.0).collect()
    rows = peaks.merge_close([r.asDict() for r in kept], 10.0)
    return spark.createDataFrame([(round(r["mean_bp"], 6), round(r["sd_bp"], 6), round(r["fraction"], 6)) for r in rows], "mean_bp double, sd_bp double, fraction double")


@query()
def gmm_fit(spark, sf_dir):
    """Fitted by EM; rows only."""
    parts = peaks.fit_components(R.length_histogram(reads(spark, sf_dir)), SETTINGS)
    return spark.createDataFrame([(p["orig_id"], round(p["mean_bp"], 3), round(p["sd_bp"], 3), round(p["fraction"], 4)) for p in parts], peaks.PEAK_SCHEMA)


# the peak's lengths are one hump, whose only component has their mean and, with the mixture's floor, their variance
@query(with_reads(f"{_ASSIGNED} SELECT round(avg(read_len), 3) AS mean_bp, round(sqrt(var_pop(read_len) + 0.001), 3) AS sd_bp, 1.0::DOUBLE AS fraction FROM assigned WHERE gmm_peak_alias = 'ITD_2'"))
def length_refinement(spark, sf_dir):
    """One or two components of a peak's lengths."""
    rows = R.length_histogram(_by_peak(spark, sf_dir).where("gmm_peak_alias = 'ITD_2'")).orderBy("read_len").collect()
    return spark.createDataFrame([(round(m, 3), round(s, 3), round(f, 4)) for m, s, f in peaks.refine_length([(r.read_len, r.n) for r in rows])], "mean_bp double, sd_bp double, fraction double")


_SIZES = ", sizes AS (SELECT haplotype AS peak_alias, avg(read_len) - 336.0 AS putative_itd_size, stddev_pop(read_len) AS sd_bp FROM reads GROUP BY 1)"


@query(with_reads(_SIZES + ", f AS (SELECT a.peak_alias, a.putative_itd_size AS m, a.sd_bp, least(10.0::DOUBLE, min(abs(b.putative_itd_size - a.putative_itd_size) / 2)) AS window_floor FROM sizes a JOIN sizes b ON a.peak_alias <> b.peak_alias AND b.peak_alias <> 'WT' WHERE a.peak_alias <> 'WT' GROUP BY ALL) SELECT peak_alias, round(window_floor, 6) AS window_floor, round(size_min, 6) AS size_min, round(size_max, 6) AS size_max FROM (SELECT peak_alias, window_floor, greatest(m - greatest(1.5 * sd_bp, window_floor), 12.0::DOUBLE) AS size_min, least(m + greatest(1.5 * sd_bp, window_floor), 300.0::DOUBLE) AS size_max FROM f) WHERE size_min <= size_max"))
def insertion_size_windows(spark, sf_dir):
    sizes = reads(spark, sf_dir).groupBy(F.col("haplotype").alias("peak_alias")).agg((F.avg("read_len") - 336.0).alias("putative_itd_size"), F.stddev_pop("read_len").alias("sd_bp"))
    return peaks.size_windows(sizes, 10.0, 1.5, 12, 300).select("peak_alias", *[F.round(c, 6).alias(c) for c in ("window_floor", "size_min", "size_max")])


@query(with_reads(f"{_ASSIGNED} SELECT gmm_peak_alias, round(avg(read_len), 6) AS mean_bp, round(stddev_pop(read_len), 6) AS sd_bp, count(DISTINCT read_len) > 1 AS has_shape FROM assigned GROUP BY 1"))
def peak_length_moments(spark, sf_dir):
    return _by_peak(spark, sf_dir).groupBy("gmm_peak_alias").agg(F.round(F.avg("read_len"), 6).alias("mean_bp"), F.round(F.stddev_pop("read_len"), 6).alias("sd_bp"), (F.countDistinct("read_len") > 1).alias("has_shape"))


@query(with_reads(f"{_ASSIGNED} SELECT read_id FROM reads WHERE read_id IN (SELECT read_id FROM assigned WHERE gmm_peak_alias = 'ITD_1')"))
def semi_join_peak_reads(spark, sf_dir):
    members = _by_peak(spark, sf_dir).where("gmm_peak_alias = 'ITD_1'").select("read_id")
    return reads(spark, sf_dir).join(members, "read_id", "left_semi").select("read_id")


@query(with_reads(f"{_ASSIGNED} SELECT read_id, CAST(read_len AS BIGINT) AS read_len FROM reads r WHERE NOT EXISTS (SELECT 1 FROM assigned a WHERE a.read_id = r.read_id AND a.gmm_peak_alias <> 'ITD_1')"))
def unresolved_antijoin(spark, sf_dir):
    resolved = _by_peak(spark, sf_dir).where("gmm_peak_alias <> 'ITD_1'")
    return reads(spark, sf_dir).join(resolved.select("read_id"), "read_id", "left_anti").select("read_id", long("read_len"))


# --- alleles and observed haplotypes ---------------------------------------------------------------------------------

_PREFIX = "coalesce(list_min(list_filter(range(1, least(length({a}), length({b})) + 1), lambda i: substr({a}, CAST(i AS INT), 1) <> substr({b}, CAST(i AS INT), 1))) - 1, least(length({a}), length({b})))"


def _interval_sql(a: str) -> tuple[str, str]:
    return f"greatest(0, {len(WT)} - {_PREFIX.format(a=f'reverse({a})', b=f'reverse(w)')})", f"least({len(WT)}, {_PREFIX.format(a=a, b='w')})"


_LOW, _HIGH = _interval_sql("read_seq")


@query(with_reads(", p AS (SELECT DISTINCT CAST(100 + read_id % 150 AS INT) AS pos, CAST(12 + read_id % 37 AS INT) AS size FROM reads) SELECT CAST(pos AS BIGINT) AS pos, CAST(size AS BIGINT) AS size, substr(w, 1, pos) || substr(w, pos - size + 1, size) || substr(w, pos + 1) AS allele FROM p, wt"))
def allele_reconstruct(spark, sf_dir):
    i = F.col("read_id")
    p = reads(spark, sf_dir).select((100 + i % 150).cast("int").alias("pos"), (12 + i % 37).cast("int").alias("size")).distinct()
    return p.select(long("pos"), long("size"), S.reconstruct_allele(F.lit(WT), F.col("pos"), S.mid(F.lit(WT), F.col("pos") - F.col("size"), F.col("size"))).alias("allele"))


@query(with_reads(f"SELECT read_seq, CAST({_LOW} AS BIGINT) AS low, CAST({_HIGH} AS BIGINT) AS high FROM (SELECT DISTINCT read_seq FROM reads), wt"))
def boundary_interval(spark, sf_dir):
    low, high = S.boundary_interval(F.col("read_seq"), F.lit(WT))
    return reads(spark, sf_dir).select("read_seq").distinct().select("read_seq", low.cast("long").alias("low"), high.cast("long").alias("high"))


@query(with_reads(f"SELECT read_seq, CAST({_LOW} AS BIGINT) AS ins_pos, length(read_seq) - {len(WT)} AS ins_len, substr(read_seq, CAST({_LOW} AS INT) + 1, length(read_seq) - {len(WT)}) AS ins_seq FROM (SELECT DISTINCT read_seq FROM reads), wt WHERE length(read_seq) > {len(WT)} AND {_LOW} <= {_HIGH}"))
def insertion_extract_exact(spark, sf_dir):
    found = insertions.exact_insertion(reads(spark, sf_dir).select(F.col("read_seq").alias("seq")).distinct())
    return found.select(F.col("seq").alias("read_seq"), long("ins_pos"), long("ins_len"), "ins_seq")


@query(with_reads("SELECT DISTINCT read_seq, substr(sha256(read_seq), 1, 12) AS allele_id, regexp_full_match(read_seq, '[ACGT]*') AS resolved FROM reads"))
def allele_id_sha(spark, sf_dir):
    return reads(spark, sf_dir).select("read_seq").distinct().select("read_seq", S.allele_id(F.col("read_seq")).alias("allele_id"), S.is_resolved(F.col("read_seq")).alias("resolved"))


def _hits_sql(anchor: str) -> str:
    return f"list_filter(range(1, length(seq) - 20 + 2), lambda p: hamming(substr(seq, CAST(p AS INT), 20), '{anchor}') <= 3)"


_LOCATED = f", u AS (SELECT seq, {_hits_sql(LEFT)} AS l, {_hits_sql(RIGHT)} AS r FROM (SELECT DISTINCT upper(read_seq) AS seq FROM reads)), pr AS (SELECT seq, count(*) AS np, min(a) AS x, min(b) AS y FROM (SELECT seq, a, unnest(r) AS b FROM (SELECT seq, unnest(l) AS a, r FROM u)) WHERE a + 20 <= b GROUP BY seq), located AS (SELECT u.seq, CASE WHEN len(l) = 0 THEN 'missing_left_anchor' WHEN len(r) = 0 THEN 'missing_right_anchor' WHEN np IS NULL THEN 'no_ordered_anchor_pair' WHEN np > 1 THEN 'ambiguous_anchor_pair' ELSE 'anchored' END AS outcome, x - 1 AS x, y - 1 AS y FROM u LEFT JOIN pr USING (seq))"


@query(with_reads(f"{_LOCATED} SELECT outcome, count(*) AS n_reads, count(DISTINCT seq) AS n_sequences FROM reads r JOIN located l ON upper(r.read_seq) = l.seq GROUP BY 1"))
def anchor_locate(spark, sf_dir):
    rows = reads(spark, sf_dir).select(F.upper("read_seq").alias("seq"))
    counts = rows.groupBy("seq").agg(F.count("*").alias("n"))
    return observed.locate_anchors(counts, SETTINGS).groupBy("outcome").agg(F.sum("n").alias("n_reads"), F.count("*").alias("n_sequences"))


_ALLELE_LOW, _ALLELE_HIGH = _interval_sql("allele")
_AUDIT = _LOCATED + f""", win AS (SELECT r.read_id, r.strand, l.seq, '{LEFT}' || substr(l.seq, CAST(x AS INT) + 21, CAST(y - x AS INT) - 20) || '{RIGHT}' AS win,
    hamming(substr(l.seq, CAST(x AS INT) + 1, 20), '{LEFT}') AS lm, hamming(substr(l.seq, CAST(y AS INT) + 1, 20), '{RIGHT}') AS rm,
    list_sum(list_transform(range(1, length(read_qual) + 1), lambda i: ascii(substr(read_qual, CAST(i AS INT), 1)) - 33)) / length(read_qual) AS q
    FROM reads r JOIN located l ON upper(r.read_seq) = l.seq WHERE outcome = 'anchored'),
  agg AS (SELECT win, length(win) - {STOP - START} AS net_size, count(*) AS exact_reads, count(*) FILTER (WHERE strand = '+') AS plus, median(q) AS median_q, count(*) FILTER (WHERE lm + rm = 0) AS exact_flank_reads,
    count(*) FILTER (WHERE lm + rm > 0) AS normalized_flank_reads, sum(lm) AS left_subs, sum(rm) AS right_subs FROM win WHERE length(win) - {STOP - START} BETWEEN 1 AND 300 GROUP BY win),
  al AS (SELECT agg.*, exact_reads - plus AS minus, substr(w, 1, {START}) || win || substr(w, {STOP + 1}) AS allele, w FROM agg, wt),
  iv AS (SELECT *, greatest({_ALLELE_LOW}, {START + 20}) AS lo, least({_ALLELE_HIGH}, {STOP - 20}) AS hi FROM al),
  audit AS (SELECT *, substr(sha256(allele), 1, 12) AS allele_id, CASE WHEN net_size < 12 THEN 'below_min_size' WHEN NOT regexp_full_match(win, '[ACGT]*') THEN 'unresolved_bases' WHEN exact_reads < 20 THEN 'insufficient_recurrence'
    WHEN least(plus, minus) < 2 THEN 'insufficient_strand_support' WHEN median_q < 20 THEN 'low_quality' WHEN lo > hi THEN 'not_single_complete_insertion' ELSE 'eligible' END AS status FROM iv)"""


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed.discover(reads(spark, sf_dir), SETTINGS)


@query(with_reads(f"{_AUDIT} SELECT allele_id, net_size, exact_reads, plus, minus, round(median_q, 6) AS median_q, exact_flank_reads, normalized_flank_reads, CAST(left_subs AS BIGINT) AS left_subs, CAST(right_subs AS BIGINT) AS right_subs, status FROM audit"))
def observed_discovery(spark, sf_dir):
    a = _audit(spark, sf_dir)
    return a.select("allele_id", long("net_size"), "exact_reads", "plus", "minus", F.round("median_q", 6).alias("median_q"), "exact_flank_reads", "normalized_flank_reads", F.col("left_anchor_substitutions").cast("long").alias("left_subs"), F.col("right_anchor_substitutions").cast("long").alias("right_subs"), "status")


_IDENTITY = "greatest(CASE WHEN p >= net_size THEN 1 - hamming(substr(allele, CAST(p AS INT) + 1, CAST(net_size AS INT)), substr(w, CAST(p - net_size AS INT) + 1, CAST(net_size AS INT))) / net_size END, CASE WHEN p + net_size <= length(w) THEN 1 - hamming(substr(allele, CAST(p AS INT) + 1, CAST(net_size AS INT)), substr(w, CAST(p AS INT) + 1, CAST(net_size AS INT))) / net_size END)"
_ELIGIBLE = _AUDIT + f", pl AS (SELECT *, unnest(range(lo, hi + 1)) AS p FROM audit WHERE status = 'eligible'), di AS (SELECT *, coalesce({_IDENTITY}, 0) AS ident FROM pl), cand AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY allele_id ORDER BY ident DESC, p) AS k FROM di) WHERE k = 1)"


@query(with_reads(f"{_ELIGIBLE} SELECT allele_id, p AS insertion_pos, substr(allele, CAST(p AS INT) + 1, CAST(net_size AS INT)) AS insertion_seq, round(ident, 6) AS duplication_identity FROM cand"))
def observed_duplication_identity(spark, sf_dir):
    return _audit(spark, sf_dir).where("status = 'eligible'").select("allele_id", long("insertion_pos"), "insertion_seq", F.round("duplication_identity", 6).alias("duplication_identity"))


@query(with_reads(f"{_AUDIT}, top AS (SELECT allele_id, allele FROM audit WHERE exact_reads >= 3) SELECT a.allele_id, coalesce(string_agg(b.allele_id, ',' ORDER BY b.allele_id), '') AS alternatives FROM top a LEFT JOIN top b ON length(a.allele) = length(b.allele) AND a.allele_id <> b.allele_id AND hamming(a.allele, b.allele) <= 1 GROUP BY 1"))
def sequence_alternatives(spark, sf_dir):
    return observed.sequence_alternatives(_audit(spark, sf_dir).where("exact_reads >= 3"))


_CONS = f"cons AS (SELECT 'ITD_2' AS peak_alias, 180 AS pos, substr(w, 136, 45) AS ins FROM wt UNION ALL SELECT 'ITD_X', 100, substr(w, 41, 60) FROM wt UNION ALL SELECT 'ITD_Y', 200, substr(w, 181, 20) FROM wt UNION ALL SELECT 'ITD_Z', 220, substr(w, 191, 30) FROM wt)"


def _known(spark: SparkSession) -> DataFrame:
    rows = [("ITD_2", 180, WT[135:180], 500), ("ITD_X", 100, WT[40:100], 40), ("ITD_Y", 200, WT[180:200], 30), ("ITD_Z", 220, WT[190:220], 20)]
    return spark.createDataFrame(rows, "peak_alias string, consensus_ins_pos_ref int, consensus_seq string, n_total_reads long")


@query(with_reads(f"{_AUDIT}, {_CONS}, k AS (SELECT substr(w, 1, pos) || ins || substr(w, pos + 1) AS allele, peak_alias FROM cons, wt), e AS (SELECT a.allele_id, a.exact_reads, a.win, k.peak_alias AS known FROM audit a LEFT JOIN k USING (allele) WHERE status = 'eligible'), f AS (SELECT *, row_number() OVER (PARTITION BY known IS NULL ORDER BY exact_reads DESC, win) AS rn FROM e) SELECT allele_id, CASE WHEN known IS NOT NULL THEN 'existing_candidate' WHEN rn <= 6 - 4 THEN 'added_for_competition' ELSE 'candidate_cap' END AS status, CASE WHEN known IS NOT NULL THEN known WHEN rn <= 2 THEN 'ITD_OBS_' || allele_id END AS peak_alias FROM f"))
def candidate_cap_union(spark, sf_dir):
    audit = _audit(spark, sf_dir)
    _, logged = observed.add_observed(_known(spark), audit, SETTINGS)
    return logged.where("status in ('existing_candidate', 'added_for_competition', 'candidate_cap')").select("allele_id", "status", "peak_alias")


# --- insertions and consensus ----------------------------------------------------------------------------------------

_EXACT = f", ins AS (SELECT r.read_id, r.strand, r.read_seq, {_LOW} AS ins_pos, length(read_seq) - {len(WT)} AS ins_len FROM reads r, wt WHERE length(read_seq) > {len(WT) + 5} AND {_LOW} <= {_HIGH})"


def _exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reads(spark, sf_dir)
    found = insertions.exact_insertion(r.select(F.col("read_seq").alias("seq")).distinct()).where("ins_len > 5")
    return r.join(found, F.col("read_seq") == F.col("seq")).drop("seq")


@query()
def insertion_extract(spark, sf_dir):
    """By affine alignment; rows only."""
    found = insertions.extract_insertions(reads(spark, sf_dir)).where("ins_len >= 12")
    return found.groupBy("ins_len", "ins_pos_ref").agg(F.count("*").alias("n"))


@query()
def insertion_table_function(spark, sf_dir):
    """The rows of insertion_extract by SQL alone: LATERAL over distinct sequences; a test holds them against each other."""
    from tandemlake.functions import tables

    tables.register(spark)
    sql = "SELECT ins_len, ins_pos_ref, sum(n) AS n FROM (SELECT read_seq, count(*) AS n FROM {reads} GROUP BY read_seq) d, LATERAL insertions_of(d.read_seq) WHERE ins_len >= 12 GROUP BY ins_len, ins_pos_ref"
    return spark.sql(sql, reads=reads(spark, sf_dir))


_LENGTHS = ", len AS (SELECT CASE WHEN strand = '+' THEN 'P' ELSE 'M' END AS peak_alias, CAST(30 + u2 AS INT) AS ins_len FROM (SELECT strand, CASE WHEN read_id % 10 < 5 THEN 21 WHEN read_id % 10 = 5 THEN 20 WHEN read_id % 10 = 6 THEN 22 WHEN read_id % 10 = 7 AND strand = '+' THEN 27 WHEN read_id % 10 = 8 THEN 27 WHEN read_id % 40 = 9 THEN 24 ELSE 35 END AS u2 FROM reads))"


def _lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("read_id") % 10
    u = F.when(d < 5, 21).when(d == 5, 20).when(d == 6, 22).when((d == 7) & (F.col("strand") == "+"), 27).when(d == 8, 27).when(F.col("read_id") % 40 == 9, 24).otherwise(35)
    return reads(spark, sf_dir).select("read_id", F.when(F.col("strand") == "+", "P").otherwise("M").alias("peak_alias"), (u + 30).cast("int").alias("ins_len"))


# candidates kept greedily: the recursion takes them in order and carries the list of kept lengths
_MODES = _LENGTHS + """, cnt AS (SELECT peak_alias, ins_len, count(*) AS n FROM len GROUP BY 1, 2), tot AS (SELECT peak_alias, sum(n) AS t FROM cnt GROUP BY 1),
  tops AS (SELECT c.*, row_number() OVER (PARTITION BY c.peak_alias ORDER BY c.n DESC, c.ins_len) AS k FROM cnt c JOIN tot USING (peak_alias) LEFT JOIN cnt a ON a.peak_alias = c.peak_alias AND a.ins_len = c.ins_len - 1 LEFT JOIN cnt b ON b.peak_alias = c.peak_alias AND b.ins_len = c.ins_len + 1
    WHERE c.n >= 20 AND c.n / t >= 0.05 AND c.n >= coalesce(a.n, 0) AND c.n > coalesce(b.n, 0)),
  pairs AS (SELECT x.peak_alias, x.ins_len AS l, y.ins_len AS m, abs(x.ins_len - y.ins_len) >= 3 AND (SELECT min(coalesce(c.n, 0)) FROM (SELECT unnest(range(least(x.ins_len, y.ins_len) + 1, greatest(x.ins_len, y.ins_len))) AS z) zz LEFT JOIN cnt c ON c.peak_alias = x.peak_alias AND c.ins_len = z) <= 0.5 * least(x.n, y.n) AS ok FROM tops x JOIN tops y ON x.peak_alias = y.peak_alias AND x.k > y.k),
  walk AS (SELECT peak_alias, 1::BIGINT AS k, [ins_len] AS kept FROM tops WHERE k = 1 UNION ALL SELECT t.peak_alias, t.k, CASE WHEN (SELECT coalesce(bool_and(ok), true) FROM pairs p WHERE p.peak_alias = t.peak_alias AND p.l = t.ins_len AND list_contains(w.kept, p.m)) THEN list_append(w.kept, t.ins_len) ELSE w.kept END FROM walk w JOIN tops t ON t.peak_alias = w.peak_alias AND t.k = w.k + 1),
  modes AS (SELECT peak_alias, unnest(kept) AS mode FROM (SELECT peak_alias, arg_max(kept, k) AS kept FROM walk GROUP BY 1))"""


@query(with_reads(_MODES + " SELECT m.peak_alias, CAST(mode AS BIGINT) AS mode, n FROM modes m JOIN cnt c ON c.peak_alias = m.peak_alias AND c.ins_len = m.mode").replace("WITH wt", "WITH RECURSIVE wt", 1))
def insertion_length_modes(spark, sf_dir):
    return insertions.length_modes(_lengths(spark, sf_dir), "peak_alias", 20, 0.05).select("peak_alias", long("mode"), "n")


@query(with_reads(_LENGTHS + ", mo AS (SELECT * FROM (VALUES ('P', 51, 500), ('P', 57, 200), ('M', 51, 500), ('M', 57, 100), ('M', 65, 90)) v(peak_alias, mode, n)), d AS (SELECT DISTINCT peak_alias, ins_len FROM len) SELECT peak_alias, CAST(ins_len AS BIGINT) AS ins_len, CAST(mode AS BIGINT) AS mode FROM (SELECT *, row_number() OVER (PARTITION BY peak_alias, ins_len ORDER BY abs(mode - ins_len), n DESC, mode) AS k FROM d JOIN mo USING (peak_alias)) WHERE k = 1"))
def nearest_mode_assign(spark, sf_dir):
    modes = spark.createDataFrame([("P", 51, 500), ("P", 57, 200), ("M", 51, 500), ("M", 57, 100), ("M", 65, 90)], "peak_alias string, mode int, n long")
    return insertions.nearest_mode(_lengths(spark, sf_dir), modes, "peak_alias").select("peak_alias", long("ins_len"), long("mode"))


_CLUSTERS = ", cl AS (SELECT CASE WHEN strand = '+' THEN 'WT' ELSE 'ITD_2' END AS parent, CASE WHEN read_id % 20 < 9 THEN 'a' WHEN read_id % 20 < 15 THEN 'b' WHEN read_id % 20 < 18 AND strand = '+' THEN 'c' WHEN read_id % 20 = 18 THEN 'd' END AS label FROM reads)"


_GUARDRAILS = """g AS (SELECT *, label IS NOT NULL AND n >= 20 AND n / sum(CASE WHEN label IS NOT NULL THEN n END) OVER (PARTITION BY parent) >= 0.15 AS kept FROM c),
  b AS (SELECT *, count(*) FILTER (WHERE kept) OVER (PARTITION BY parent) AS nk, first_value(label) OVER (PARTITION BY parent ORDER BY kept DESC, n DESC, label) AS big FROM g), t AS (SELECT *, CASE WHEN nk >= 2 THEN CASE WHEN kept THEN label ELSE big END END AS target FROM b),
  s AS (SELECT parent, target, sum(n) AS child_reads FROM t WHERE target IS NOT NULL GROUP BY 1, 2), k AS (SELECT *, CASE WHEN parent = 'WT' THEN 'ITD_WT' ELSE parent END || '_H' || row_number() OVER (PARTITION BY parent ORDER BY child_reads DESC, target) AS child FROM s)
  SELECT t.parent, t.label, t.n, t.kept, t.target, k.child, CAST(k.child_reads AS BIGINT) AS child_reads FROM t LEFT JOIN k ON t.parent = k.parent AND t.target = k.target"""


@query(with_reads(_CLUSTERS + ", c AS (SELECT parent, label, count(*) AS n FROM cl GROUP BY 1, 2), " + _GUARDRAILS))
def cluster_guardrails(spark, sf_dir):
    d = F.col("read_id") % 20
    label = F.when(d < 9, "a").when(d < 15, "b").when((d < 18) & (F.col("strand") == "+"), "c").when(d == 18, "d")
    return insertions.cluster_guardrails(reads(spark, sf_dir).select("read_id", F.when(F.col("strand") == "+", "WT").otherwise("ITD_2").alias("parent"), label.alias("label")), 20, 0.15)


@query(with_reads("SELECT upper(read_seq) AS seq, count(*) AS n, min(read_id) AS first FROM reads WHERE length(read_seq) > 0 GROUP BY 1"))
def dedup_with_counts(spark, sf_dir):
    return R.sequence_counts(reads(spark, sf_dir))


_COUNTS = f"{_ASSIGNED}, u AS (SELECT gmm_peak_alias, upper(read_seq) AS seq, count(*) AS n, min(read_id) AS first FROM assigned GROUP BY 1, 2)"


def _peak_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_peak(spark, sf_dir).groupBy("gmm_peak_alias", F.upper("read_seq").alias("seq")).agg(F.count("*").alias("n"), F.min("read_id").alias("first"))


@query(with_reads(f"{_COUNTS}, p AS (SELECT *, row_number() OVER w AS panel_rank, coalesce(sum(n) OVER (PARTITION BY gmm_peak_alias ORDER BY n DESC, first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b, sum(n) OVER (PARTITION BY gmm_peak_alias) AS t FROM u WINDOW w AS (PARTITION BY gmm_peak_alias ORDER BY n DESC, first)) SELECT gmm_peak_alias, seq, n, first, panel_rank FROM p WHERE panel_rank <= 150 AND (panel_rank = 1 OR b / t < 0.98)"))
def panel_coverage(spark, sf_dir):
    return consensus.panel(_peak_counts(spark, sf_dir), ["gmm_peak_alias"], 150, 0.98).select("gmm_peak_alias", "seq", "n", "first", long("panel_rank"))


_ALIGNED_ALLELES = ", aa AS (SELECT CASE WHEN length(read_seq) = 336 THEN 'WT' ELSE 'ITD_2' END AS peak_alias, regexp_replace(read_seq, 'TTTT', 'TT--', 'g') AS aligned, count(*) AS n, min(read_id) AS first FROM reads WHERE length(read_seq) IN (336, 381) GROUP BY 1, 2)"


@query(with_reads(_ALIGNED_ALLELES + """, cell AS (SELECT peak_alias, n, first, unnest(range(1, length(aligned) + 1)) AS col, aligned FROM aa), v AS (SELECT peak_alias, col, substr(aligned, CAST(col AS INT), 1) AS base, sum(n) AS w, min((-n, first)) AS seen FROM cell GROUP BY 1, 2, 3),
  t AS (SELECT peak_alias, sum(n) AS total FROM aa GROUP BY 1), b AS (SELECT v.*, row_number() OVER (PARTITION BY v.peak_alias, col ORDER BY w DESC, seen, base) AS k, sum(w) OVER (PARTITION BY v.peak_alias, col) AS cover FROM v WHERE base <> '-'),
  c AS (SELECT b.peak_alias, col, w / cover AS share, CASE WHEN w / cover >= 0.7 THEN base ELSE 'N' END AS called FROM b JOIN t USING (peak_alias) WHERE k = 1 AND cover / total >= 0.7)
  SELECT peak_alias, string_agg(called, '' ORDER BY col) AS consensus, round(1 - min(share), 6) AS max_minor FROM c GROUP BY 1"""))
def weighted_consensus(spark, sf_dir):
    rows = reads(spark, sf_dir).where(F.length("read_seq").isin(336, 381)).select(F.when(F.length("read_seq") == 336, "WT").otherwise("ITD_2").alias("peak_alias"), F.regexp_replace("read_seq", "TTTT", "TT--").alias("aligned"), "read_id")
    alleles = rows.groupBy("peak_alias", "aligned").agg(F.count("*").alias("n"), F.min("read_id").alias("first"))
    return consensus.column_consensus(alleles, ["peak_alias"], 0.7, 0.7).withColumn("max_minor", F.round("max_minor", 6))


@query(with_reads("SELECT haplotype, CAST(sum(length(s) - length(replace(s, 'N', ''))) AS BIGINT) AS total_n, round(max((length(s) - length(replace(s, 'N', ''))) / length(s)), 6) AS worst_n, max((length(s) - length(replace(s, 'N', ''))) / length(s)) > 0.05 AS mixed FROM (SELECT haplotype, CASE WHEN read_id % 11 = 0 THEN replace(read_seq, 'GA', 'NN') ELSE read_seq END AS s FROM reads) GROUP BY 1"))
def consensus_ambiguity(spark, sf_dir):
    s = F.when(F.col("read_id") % 11 == 0, F.replace("read_seq", F.lit("GA"), F.lit("NN"))).otherwise(F.col("read_seq"))
    rows = reads(spark, sf_dir).select("haplotype", s.alias("s"))
    n = F.length("s") - F.length(F.replace("s", F.lit("N"), F.lit("")))
    return rows.groupBy("haplotype").agg(F.sum(n).alias("total_n"), F.round(F.max(n / F.length("s")), 6).alias("worst_n"), (F.max(n / F.length("s")) > 0.05).alias("mixed"))


@query(with_reads(f"{_EXACT} SELECT CAST(ins_len AS BIGINT) AS ins_len, CAST(trunc(median(ins_pos)) AS BIGINT) AS median_pos, count(*) AS n FROM ins GROUP BY 1"))
def median_ins_pos(spark, sf_dir):
    return _exact(spark, sf_dir).groupBy(long("ins_len")).agg(F.median("ins_pos").cast("long").alias("median_pos"), F.count("*").alias("n"))


@query(with_reads(f"{_EXACT} SELECT strand AS peak_alias, count(*) AS n_insertions, round(avg(ins_len), 6) AS mean_len, round(stddev_samp(ins_len), 6) AS sd_len, median(ins_pos) AS median_pos FROM ins GROUP BY 1"))
def insertion_statistics(spark, sf_dir):
    rows = _exact(spark, sf_dir).select(F.col("strand").alias("peak_alias"), "ins_len", F.col("ins_pos").alias("ins_pos_ref"))
    return insertions.insertion_statistics(rows).withColumns({"mean_len": F.round("mean_len", 6), "sd_len": F.round("sd_len", 6)})


_DUPS = "dup AS (SELECT haplotype || strand AS peak_alias, pos, src, size, count(*) AS n_total_reads, count(*) / (SELECT count(*) FROM reads)::DOUBLE AS fraction, count(*) AS cnt, avg(read_len) AS mean_bp, stddev_pop(read_len) AS sd_bp FROM reads JOIN (VALUES ('ITD_A', 180, 135, 45), ('ITD_B', 120, 75, 45), ('ITD_C', 180, 150, 30)) v(h, pos, src, size) ON h = haplotype GROUP BY ALL)"


@query(with_reads(f", {_DUPS}, a AS (SELECT dup.*, substr(w, 1, pos) || substr(w, src + 1, size) || substr(w, pos + 1) AS allele FROM dup, wt), o AS (SELECT *, first_value(peak_alias) OVER (PARTITION BY allele ORDER BY n_total_reads DESC, peak_alias) AS owner FROM a), g AS (SELECT owner AS peak_alias, sum(fraction) AS fraction, CAST(sum(cnt) AS BIGINT) AS effective_read_count, sum(cnt * mean_bp) / sum(cnt) AS mean_bp, sum(cnt * (sd_bp * sd_bp + mean_bp * mean_bp)) / sum(cnt) AS sq FROM o GROUP BY 1) SELECT peak_alias, round(fraction, 6) AS fraction, effective_read_count, round(mean_bp, 6) AS mean_bp, round(sqrt(greatest(sq - mean_bp * mean_bp, 0)), 6) AS sd_bp FROM g"))
def merge_duplicate_alleles(spark, sf_dir):
    r = reads(spark, sf_dir)
    known = spark.createDataFrame([("ITD_A", 180, 135, 45), ("ITD_B", 120, 75, 45), ("ITD_C", 180, 150, 30)], "haplotype string, consensus_ins_pos_ref int, src int, size int")
    # each allele's reads of either strand are a peak of their own
    each = r.join(F.broadcast(known), "haplotype").groupBy(F.concat("haplotype", "strand").alias("peak_alias"), *known.columns[1:]).agg(F.count("*").alias("n_total_reads"), F.avg("read_len").alias("mean_bp"), F.stddev_pop("read_len").alias("sd_bp"))
    d = each.crossJoin(F.broadcast(r.agg(F.count("*").alias("total")))).withColumns({"fraction": F.col("n_total_reads") / F.col("total"), "effective_read_count": F.col("n_total_reads"), "consensus_seq": S.mid(F.lit(WT), F.col("src"), F.col("size"))})
    owners = consensus.merge_duplicates(d.select("peak_alias", "consensus_ins_pos_ref", "consensus_seq", "n_total_reads"))
    m = consensus.merged_peaks(d.select("peak_alias", "fraction", "effective_read_count", "mean_bp", "sd_bp"), owners)
    return m.select("peak_alias", F.round("fraction", 6).alias("fraction"), "effective_read_count", F.round("mean_bp", 6).alias("mean_bp"), F.round("sd_bp", 6).alias("sd_bp"))


@query()
def peak_consensus(spark, sf_dir):
    """By alignment, panel, window, star alignment and column votes; rows only."""
    by_peak = _by_peak(spark, sf_dir)
    found = insertions.extract_insertions(by_peak.where("gmm_peak_alias <> 'WT'")).where("ins_len >= 12")
    return consensus.peak_consensus(found, SETTINGS)


# with at most one edit in a read, its centre is the allele of the fewest edits; centres are numbered by their exact copies
_BY_EDITS = f"{_ASSIGNED}, al AS (SELECT CASE haplotype WHEN 'ITD_C' THEN 'ITD_1' ELSE 'ITD_2' END AS parent, allele, CASE haplotype WHEN 'ITD_B' THEN 'c0001' WHEN 'ITD_D' THEN 'c0002' ELSE 'c0000' END AS label FROM haps WHERE haplotype <> 'WT'), lb AS (SELECT parent, read_seq, label FROM (SELECT DISTINCT gmm_peak_alias, read_seq FROM assigned) JOIN al ON parent = gmm_peak_alias QUALIFY row_number() OVER (PARTITION BY parent, read_seq ORDER BY levenshtein(read_seq, allele), label) = 1), lr AS (SELECT a.*, lb.label FROM assigned a LEFT JOIN lb ON lb.parent = a.gmm_peak_alias AND lb.read_seq = a.read_seq)"


@query(with_reads(_BY_EDITS + ", c AS (SELECT gmm_peak_alias AS parent, label, count(*) AS n FROM lr GROUP BY 1, 2), " + _GUARDRAILS.replace("CAST(k.child_reads AS BIGINT)", "coalesce(CAST(k.child_reads AS BIGINT), 0)")))
def denoise_split(spark, sf_dir):
    """Clusters of each peak by the denoiser, under the size guardrails."""
    from tandemlake.operators.split import denoise_labels

    labels = denoise_labels(_by_peak(spark, sf_dir), SETTINGS)
    rows = insertions.cluster_guardrails(labels.select(F.col("gmm_peak_alias").alias("parent"), "read_id", "label"), SETTINGS.min_haplotype_reads, SETTINGS.min_subpeak_fraction)
    return rows.withColumn("child_reads", F.coalesce("child_reads", F.lit(0)))


@query(with_reads(_BY_EDITS + ", f AS (SELECT *, CASE WHEN label IN ('c0000', 'c0002') AND gmm_peak_alias = 'ITD_2' THEN 'ITD_2_H1' WHEN label = 'c0001' THEN 'ITD_2_H2' ELSE gmm_peak_alias END AS alias FROM lr), m AS (SELECT alias, gmm_peak_alias, count(*) AS n, alias LIKE '%_H_' AS child, avg(read_len) AS mean, stddev_pop(read_len) AS sd FROM f GROUP BY 1, 2) SELECT alias AS peak_alias, gmm_peak_alias AS parent_peak_alias, n AS effective_read_count, round(n / (SELECT sum(n) FROM m), 6) AS fraction, CAST(child AS INTEGER) AS refinement_level, CASE WHEN child THEN 'sequence' ELSE '' END AS split_by, CASE WHEN child THEN round(mean, 6) END AS child_mean, CASE WHEN child THEN round(sd, 6) END AS child_sd FROM m"))
def peak_lineage(spark, sf_dir):
    """The peaks' table after a split by sequence: shares of all reads, moments of children."""
    from tandemlake.operators import aliases
    from tandemlake.operators.lineage import remove, stage
    from tandemlake.operators.split import split_peaks
    from tandemlake.plans.pipeline import _small

    r = stage(reads(spark, sf_dir).select("read_id", "read_seq", "read_qual", "read_len"))  # derived once, then read by column
    by_peak = aliases.begin(_by_peak(spark, sf_dir, r))
    counts = {r.gmm_peak_alias: r.effective_read_count for r in peaks.effective_counts(by_peak).collect()}
    frame = peaks.peaks_frame(spark, [{"alias": a, "mean_bp": m, "sd_bp": s, "fraction": f, "effective_read_count": counts.get(a, 0), "putative_itd_size": m - 336.0, "is_wt": a == "WT"} for _, m, s, f, a in PEAKS])
    split = aliases.refined("_before", split_peaks(by_peak.withColumn("_before", F.col("gmm_peak_alias")), SETTINGS), "sequence")
    t = _small(aliases.peak_table(frame, split, SETTINGS))
    remove(r)
    child = F.col("refinement_level") > 0
    return t.select("peak_alias", "parent_peak_alias", "effective_read_count", F.round("fraction", 6).alias("fraction"), "refinement_level", "split_by", F.when(child, F.round("mean_bp", 6)).alias("child_mean"), F.when(child, F.round("sd_bp", 6)).alias("child_sd"))


# --- competition -----------------------------------------------------------------------------------------------------

_SCORES = ", rs AS (SELECT read_id, strand, haplotype AS ref_truth, ref_alias, greatest(0.0, 1.0 - abs(length(read_seq) - length(ref_seq)) / 336.0 - CASE WHEN ref_alias = 'ITD_B' AND haplotype = 'ITD_A' THEN 0.0002 WHEN ref_alias = 'ITD_A' AND haplotype = 'ITD_B' THEN 0.0001 ELSE 0 END) AS score_used FROM reads, (SELECT haplotype AS ref_alias, allele AS ref_seq FROM haps WHERE haplotype <> 'ITD_D'))"


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = spark.createDataFrame([("WT", 336), ("ITD_A", 381), ("ITD_B", 381), ("ITD_C", 366)], "ref_alias string, ref_len int")
    r = reads(spark, sf_dir).select("read_id", "strand", F.col("haplotype").alias("ref_truth"), "read_len")
    malus = F.when((F.col("ref_alias") == "ITD_B") & (F.col("ref_truth") == "ITD_A"), 0.0002).when((F.col("ref_alias") == "ITD_A") & (F.col("ref_truth") == "ITD_B"), 0.0001).otherwise(0.0)
    j = r.crossJoin(F.broadcast(refs))
    return j.select("read_id", "strand", "ref_truth", "ref_alias", F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(F.col("read_len") - F.col("ref_len")) / 336.0 - malus).alias("score_used"))


@query(with_reads(_SCORES + " SELECT read_id, ref_alias, round(score_used, 6) AS score_used FROM rs"))
def refs_cross_score(spark, sf_dir):
    return _scores(spark, sf_dir).select("read_id", "ref_alias", F.round("score_used", 6).alias("score_used"))


_SOFT = _SCORES + ", mx AS (SELECT *, exp(500 * (score_used - max(score_used) OVER (PARTITION BY read_id))) AS e FROM rs), pb AS (SELECT *, e / (sum(e) OVER (PARTITION BY read_id) + 1e-8) AS prob_score FROM mx), sc AS (SELECT *, (prob_score - avg(prob_score) OVER (PARTITION BY read_id)) / (stddev_pop(prob_score) OVER (PARTITION BY read_id) + 1e-8) AS z_score FROM pb)"


@query(with_reads(_SOFT + " SELECT read_id, ref_alias, round(prob_score, 6) AS prob_score, round(z_score, 5) AS z_score FROM sc"))
def softmax_zscore(spark, sf_dir):
    return validation.support_scores(_scores(spark, sf_dir)).select("read_id", "ref_alias", F.round("prob_score", 6).alias("prob_score"), F.round("z_score", 5).alias("z_score"))


_BEST = _SOFT + ", rk AS (SELECT *, row_number() OVER w AS k, lead(ref_alias) OVER w AS second_best_ref, prob_score - lead(prob_score) OVER w AS prob_delta FROM sc WINDOW w AS (PARTITION BY read_id ORDER BY round(z_score, 9) DESC, CASE WHEN ref_alias = 'WT' THEN 0 ELSE 1 END, ref_alias)), best AS (SELECT *, CASE WHEN z_score >= 1 AND prob_delta >= 0.05 THEN CASE WHEN ref_alias LIKE '%ITD%' THEN 'ITD-supporting' ELSE 'WT-supporting' END ELSE 'Ambiguous' END AS support_call FROM rk WHERE k = 1)"


def _best(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = validation.support_scores(_scores(spark, sf_dir)).withColumn("z_score", F.round("z_score", 9))
    return validation.rank_references(scored, "z_score").withColumn("support_call", validation.classify_support(False))


@query(with_reads(_BEST + " SELECT read_id, ref_alias, second_best_ref, round(prob_delta, 6) AS prob_delta FROM best"))
def rank_runner_up(spark, sf_dir):
    return _best(spark, sf_dir).select("read_id", "ref_alias", "second_best_ref", F.round("prob_delta", 6).alias("prob_delta"))


@query(with_reads(_BEST + " SELECT read_id, ref_alias, support_call FROM best"))
def classify_support(spark, sf_dir):
    return _best(spark, sf_dir).select("read_id", "ref_alias", "support_call")


_BLOCKS = ", bl AS (SELECT read_id, CASE CAST(read_id % 4 AS INT) WHEN 0 THEN 'WT' WHEN 3 THEN 'OTHER' ELSE 'ITD_1' END AS ref_alias, CASE WHEN read_id % 4 = 1 AND read_id % 8 <> 5 THEN 180 WHEN read_id % 4 = 2 THEN 120 END AS ins_pos, 45 AS itd_len, CASE WHEN read_id % 13 = 0 THEN 0.85::DOUBLE ELSE 0.99::DOUBLE END AS pid, CAST(read_id % 250 AS INT) AS t, CAST(read_id % 9 AS INT) AS dt, CAST(read_id % 14 AS INT) AS dq FROM reads)"


@query(with_reads(_BLOCKS + """ SELECT read_id, ref_alias, CASE WHEN ref_alias = 'WT' THEN CASE WHEN pid < 0.9 THEN 'low_pid(0.85)' WHEN dq > dt AND dq - dt > 10 THEN 'wt_with_gaps(' || (dq - dt) || ' bp)' ELSE 'pass' END
    WHEN ref_alias = 'ITD_1' THEN CASE WHEN ins_pos IS NULL THEN 'missing_insertion_position' WHEN pid < 0.9 THEN 'low_pid(0.85)' WHEN t + 1 <= ins_pos + itd_len + 15 AND t + 1 + dt >= ins_pos - 15 AND dt + dq > 5 THEN 'too_many_gaps(' || (dt + dq) || ')' ELSE 'pass' END ELSE 'unknown_alias:OTHER' END AS filter_reason FROM bl"""))
def breakpoint_validate(spark, sf_dir):
    i = F.col("read_id")
    t, dt, dq = (i % 250).cast("int"), (i % 9).cast("int"), (i % 14).cast("int")
    block = lambda a, b, c, d: F.struct(a.cast("int").alias("t0"), b.cast("int").alias("t1"), c.cast("int").alias("q0"), d.cast("int").alias("q1"))
    blocks = F.array(block(F.lit(0), t + 1, F.lit(0), t + 1), block(t + 1 + dt, F.lit(381), t + 1 + dq, F.lit(381) + dq - dt))
    rows = reads(spark, sf_dir).select(
        "read_id", F.when(i % 4 == 0, "WT").when(i % 4 == 3, "OTHER").otherwise("ITD_1").alias("ref_alias"), F.when((i % 4 == 1) & (i % 8 != 5), 180).when(i % 4 == 2, 120).alias("ins_pos"), F.lit(45).alias("itd_len"),
        F.when(i % 13 == 0, 0.85).otherwise(0.99).alias("pct_identity"), blocks.alias("blocks"),
    )
    return rows.select("read_id", "ref_alias", validation.breakpoint_reason().alias("filter_reason"))


def _nearest_sql(alleles: str) -> str:
    """Each distinct sequence's allele of the fewest edits, by DuckDB's own edit distance; alleles: columns ref_alias, ref_seq."""
    return f", refs AS ({alleles}), d AS (SELECT DISTINCT read_seq FROM reads), near AS (SELECT read_seq, ref_alias FROM (SELECT read_seq, ref_alias, row_number() OVER (PARTITION BY read_seq ORDER BY levenshtein(read_seq, ref_seq), ref_alias <> 'WT', ref_alias) AS k FROM d CROSS JOIN refs) WHERE k = 1)"


# with at most a few edits in a read, the best alignment is to the allele of the fewest edits, and passes
@query(with_reads(_nearest_sql("SELECT haplotype AS ref_alias, allele AS ref_seq FROM haps WHERE haplotype <> 'ITD_D'") + " SELECT ref_alias, CASE WHEN ref_alias = 'WT' THEN 'WT-supporting' ELSE 'ITD-supporting' END AS support_call, 'pass' AS filter_reason, count(*) AS n FROM reads JOIN near USING (read_seq) GROUP BY 1"))
def competitive_validation(spark, sf_dir):
    """By alignment to four alleles."""
    known = spark.createDataFrame([("ITD_A", 180, WT[135:180]), ("ITD_B", 120, WT[75:120]), ("ITD_C", 180, WT[150:180])], "peak_alias string, consensus_ins_pos_ref int, consensus_seq string")
    v = validation.competitive_validation(reads(spark, sf_dir), consensus.reference_alleles(known))
    return v.groupBy("ref_alias", "support_call", "filter_reason").agg(F.count("*").alias("n"))


@query(with_reads(f", {fixtures.NOISY}" + _nearest_sql("SELECT haplotype AS ref_alias, allele AS ref_seq FROM haps WHERE haplotype <> 'ITD_D'").replace("FROM reads)", "FROM noisy)") + " SELECT ref_alias, CASE WHEN ref_alias = 'WT' THEN 'WT-supporting' ELSE 'ITD-supporting' END AS support_call, 'pass' AS filter_reason, count(*) AS n FROM noisy JOIN near USING (read_seq) GROUP BY 1"))
def noisy_competition(spark, sf_dir):
    """Competition of reads that are nearly all unique, as long reads are: each one is aligned."""
    known = spark.createDataFrame([("ITD_A", 180, WT[135:180]), ("ITD_B", 120, WT[75:120]), ("ITD_C", 180, WT[150:180])], "peak_alias string, consensus_ins_pos_ref int, consensus_seq string")
    v = validation.competitive_validation(fixtures.noisy_reads(spark, sf_dir), consensus.reference_alleles(known))
    return v.groupBy("ref_alias", "support_call", "filter_reason").agg(F.count("*").alias("n"))


# --- quantification and reporting ------------------------------------------------------------------------------------

_VALID = ", val AS (SELECT read_id, strand, CAST(read_len AS BIGINT) AS read_len, haplotype AS ref_alias, CASE WHEN haplotype = 'WT' THEN 'WT-supporting' WHEN read_id % 19 = 0 THEN 'Ambiguous' ELSE 'ITD-supporting' END AS support_call, CASE WHEN read_id % 7 = 0 THEN 'too_many_gaps(9)' ELSE 'pass' END AS filter_reason, read_id % 7 <> 0 AS valid_support FROM reads), sup AS (SELECT * FROM val WHERE valid_support AND filter_reason = 'pass' AND support_call IN ('ITD-supporting', 'WT-supporting'))"


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("read_id")
    return reads(spark, sf_dir).select(
        "read_id", "strand", long("read_len"), F.col("haplotype").alias("ref_alias"), F.when(F.col("haplotype") == "WT", "WT-supporting").when(i % 19 == 0, "Ambiguous").otherwise("ITD-supporting").alias("support_call"),
        F.when(i % 7 == 0, "too_many_gaps(9)").otherwise("pass").alias("filter_reason"), (i % 7 != 0).alias("valid_support"),
    )


_AF = _VALID + ", cn AS (SELECT ref_alias, count(DISTINCT read_id) AS n, count(*) FILTER (WHERE strand = '+') AS plus_reads, count(*) FILTER (WHERE strand = '-') AS minus_reads FROM sup GROUP BY 1), af AS (SELECT ref_alias, n AS n_itd_reads, (SELECT count(*) FROM sup) AS n_total_reads, n / (SELECT count(*) FROM sup) AS allele_frequency, plus_reads, minus_reads, (SELECT plus_reads FROM cn WHERE ref_alias = 'WT') AS wp, (SELECT minus_reads FROM cn WHERE ref_alias = 'WT') AS wm FROM cn WHERE ref_alias <> 'WT')"
_LP = "lgamma(r1 + 1) - lgamma(x + 1) - lgamma(r1 - x + 1) + lgamma(r2 + 1) - lgamma(c1 - x + 1) - lgamma(r2 - c1 + x + 1) - (lgamma(r1 + r2 + 1) - lgamma(c1 + 1) - lgamma(r1 + r2 - c1 + 1))"
_FISHER = _AF + f", fx AS (SELECT ref_alias, plus_reads AS a, unnest(range(greatest(0, plus_reads + wp - (wp + wm)), least(plus_reads + minus_reads, plus_reads + wp) + 1)) AS x, plus_reads + minus_reads AS r1, wp + wm AS r2, plus_reads + wp AS c1 FROM af), lp AS (SELECT ref_alias, a, x, {_LP} AS l FROM fx), fp AS (SELECT ref_alias, least(1.0, sum(exp(l)) FILTER (WHERE l <= l0 + ln(1 + 1e-7))) AS fisher_p FROM (SELECT lp.*, max(CASE WHEN x = a THEN l END) OVER (PARTITION BY ref_alias) AS l0 FROM lp) GROUP BY 1)"


@query(with_reads(_FISHER + " SELECT ref_alias, n_itd_reads, n_total_reads, round(allele_frequency, 6) AS allele_frequency, plus_reads, minus_reads, round(plus_reads / (plus_reads + minus_reads), 6) AS strand_ratio, round(plus_reads * wm / (minus_reads * wp), 6) AS odds_ratio, round(fisher_p, 5) AS fisher_p FROM af JOIN fp USING (ref_alias)"))
def allele_frequency(spark, sf_dir):
    t = quantify.allele_frequencies(_validated(spark, sf_dir), 0.0)
    return t.withColumns({c: F.round(c, 6) for c in ("allele_frequency", "strand_ratio", "odds_ratio")} | {"fisher_p": F.round("fisher_p", 5)})


@query(with_reads(_VALID + " SELECT ref_alias, count(DISTINCT read_id) AS n_reads, count(*) FILTER (WHERE strand = '+') AS plus_reads, count(*) FILTER (WHERE strand = '-') AS minus_reads FROM sup GROUP BY 1"))
def strand_pivot(spark, sf_dir):
    return quantify.strand_counts(quantify.final_support(_validated(spark, sf_dir)))


@query(with_reads(_FISHER + " SELECT ref_alias, round(plus_reads * wm / (minus_reads * wp), 6) AS odds_ratio, round(fisher_p, 5) AS fisher_p FROM af JOIN fp USING (ref_alias)"))
def strand_pivot_fisher(spark, sf_dir):
    t = quantify.allele_frequencies(_validated(spark, sf_dir), 0.0)
    return t.select("ref_alias", F.round("odds_ratio", 6).alias("odds_ratio"), F.round("fisher_p", 5).alias("fisher_p"))


@query("SELECT k, plus_reads, minus_reads, odds_ratio, fisher_p, coalesce(plus_reads / (plus_reads + minus_reads) <= 0.05 OR plus_reads / (plus_reads + minus_reads) >= 0.95 OR (fisher_p <= 0.05 AND (odds_ratio >= 3 OR odds_ratio <= 1 / 3)), false) AS biased FROM (SELECT o_orderkey AS k, o_orderkey % 41 AS plus_reads, o_custkey % 37 + 1 AS minus_reads, CAST(o_orderkey % 50 AS DOUBLE) / 10 AS odds_ratio, CAST(o_custkey % 20 AS DOUBLE) / 100 AS fisher_p FROM orders)")
def strand_bias_flag(spark, sf_dir):
    o = fixtures.orders(spark, sf_dir)
    rows = o.select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 41).alias("plus_reads"), (F.col("o_custkey") % 37 + 1).alias("minus_reads"), ((F.col("o_orderkey") % 50).cast("double") / 10).alias("odds_ratio"), ((F.col("o_custkey") % 20).cast("double") / 100).alias("fisher_p"))
    return rows.withColumn("biased", quantify.strand_bias_flag())


@query(with_reads(_AF + " SELECT ref_alias, n_itd_reads, round(allele_frequency, 6) AS allele_frequency FROM af WHERE allele_frequency >= 0.06 ORDER BY 3 DESC"))
def af_filter_report(spark, sf_dir):
    return quantify.allele_frequencies(_validated(spark, sf_dir), 0.06).select("ref_alias", "n_itd_reads", F.round("allele_frequency", 6).alias("allele_frequency"))


@query(with_reads(_AF + ", au AS (SELECT * FROM (VALUES ('1', 'ITD_A'), ('2', 'ITD_C'), ('3', 'ITD_Q'), ('4', NULL)) v(allele_id, peak_alias)), vr AS (SELECT ref_alias, count(DISTINCT read_id) AS n FROM sup WHERE support_call = 'ITD-supporting' GROUP BY 1) SELECT allele_id, peak_alias, CASE WHEN peak_alias IS NOT NULL THEN coalesce(vr.n, 0) ELSE -1 END AS validated_reads, CASE WHEN peak_alias IS NOT NULL THEN peak_alias IN (SELECT ref_alias FROM af WHERE allele_frequency >= 0.1) END AS reported, CASE WHEN peak_alias IS NULL THEN NULL WHEN peak_alias IN (SELECT ref_alias FROM af WHERE allele_frequency >= 0.1) THEN 'reported' WHEN vr.n > 0 THEN 'below_reporting_af' ELSE 'no_validated_support' END AS final_status FROM au LEFT JOIN vr ON vr.ref_alias = au.peak_alias"))
def audit_status(spark, sf_dir):
    v = _validated(spark, sf_dir)
    audit = spark.createDataFrame([("1", "ITD_A"), ("2", "ITD_C"), ("3", "ITD_Q"), ("4", None)], "allele_id string, peak_alias string")
    return quantify.audit_status(audit, v, quantify.allele_frequencies(v, 0.1)).select("allele_id", "peak_alias", F.coalesce("validated_reads", F.lit(-1)).alias("validated_reads"), "reported", "final_status")


@query(with_reads(_AF + " SELECT ref_alias, read_len, count(DISTINCT read_id) AS n FROM sup WHERE ref_alias IN (SELECT ref_alias FROM af WHERE allele_frequency >= 0.05) GROUP BY 1, 2"))
def final_support_profiles(spark, sf_dir):
    v = _validated(spark, sf_dir)
    return quantify.final_profiles(v, quantify.allele_frequencies(v, 0.05))


@query(with_reads(", c AS (SELECT haplotype AS ref_alias, CAST(round(avg(read_len)) AS BIGINT) - 336 AS itd_len FROM reads WHERE haplotype <> 'WT' GROUP BY 1) SELECT ref_alias, itd_len, itd_len || ' bp' || CASE WHEN count(*) OVER (PARTITION BY itd_len) > 1 THEN ' ' || chr(64 + CAST(row_number() OVER (PARTITION BY itd_len ORDER BY ref_alias) AS INT)) ELSE '' END AS label FROM c"))
def display_labels(spark, sf_dir):
    c = reads(spark, sf_dir).where("haplotype <> 'WT'").groupBy(F.col("haplotype").alias("ref_alias")).agg((F.round(F.avg("read_len")).cast("long") - 336).alias("itd_len"))
    return quantify.display_labels(c)


_CALLS = "calls AS (SELECT * FROM (VALUES ('ITD_A', 180, 135, 45), ('ITD_B', 120, 75, 45), ('ITD_C', 180, 150, 30)) v(ref_alias, pos, src, size))"


@query(with_reads(_AF + f", {_CALLS} SELECT ref_alias, concat_ws(chr(9), 'chr13', CAST({AMPLICON['hg38'][0]} + pos - 1 AS VARCHAR), '.', substr(w, pos, 1), substr(w, pos, 1) || substr(w, src + 1, size), '.', 'PASS') AS site, n_itd_reads, n_total_reads - n_itd_reads AS ad_ref FROM af JOIN calls USING (ref_alias), wt WHERE allele_frequency >= 0.05"))
def genomic_coords_vcf(spark, sf_dir):
    from tandemlake.sources.sinks import vcf_site

    calls = spark.createDataFrame([("ITD_A", 180, WT[135:180]), ("ITD_B", 120, WT[75:120]), ("ITD_C", 180, WT[150:180])], "peak_alias string, consensus_ins_pos_ref int, consensus_seq string")
    refs = consensus.reference_alleles(calls)
    t = quantify.allele_frequencies(_validated(spark, sf_dir), 0.05).join(F.broadcast(refs), "ref_alias")
    return t.select("ref_alias", vcf_site().alias("site"), "n_itd_reads", F.greatest(F.col("n_total_reads") - F.col("n_itd_reads"), F.lit(0)).alias("ad_ref"))


@query(with_reads(f", {_CALLS} SELECT '>' || ref_alias || ' len=' || (336 + size) || ' itd=' || size || ' pos=chr13:' || ({AMPLICON['hg38'][0]} + pos - 1) || chr(10) || substr(w, 1, pos) || substr(w, src + 1, size) || substr(w, pos + 1) AS record FROM calls, wt WHERE substr(w, 1, pos) || substr(w, src + 1, size) || substr(w, pos + 1) IN (SELECT read_seq FROM reads) UNION ALL SELECT '>WT len=336 itd=0 pos=.' || chr(10) || w FROM wt WHERE w IN (SELECT read_seq FROM reads)"))
def fasta_export(spark, sf_dir):
    from tandemlake.sources.sinks import fasta_record

    calls = spark.createDataFrame([("ITD_A", 180, WT[135:180]), ("ITD_B", 120, WT[75:120]), ("ITD_C", 180, WT[150:180])], "peak_alias string, consensus_ins_pos_ref int, consensus_seq string")
    # alleles that some read shows
    shown = reads(spark, sf_dir).select(F.col("read_seq").alias("ref_seq")).distinct()
    return consensus.reference_alleles(calls).join(shown, "ref_seq", "left_semi").select(fasta_record().alias("record"))


@query(with_reads(", t AS (SELECT DISTINCT substr(read_seq, 130, 45) AS s FROM reads), q AS (SELECT substr(w, 136, 45) AS c FROM wt) SELECT s, contains(c || c, s) AND length(s) = length(c) AS rotated, contains(c || c, substr(s, 21) || substr(s, 1, 20)) AND length(s) = length(c) AS turned FROM t, q"))
def rotation_match(spark, sf_dir):
    t = reads(spark, sf_dir).select(F.substring("read_seq", 130, 45).alias("s")).distinct()
    turned = F.concat(S.tail(F.col("s"), 20), S.head(F.col("s"), 20))
    return t.select("s", S.is_rotation(F.lit(WT[135:180]), F.col("s")).alias("rotated"), S.is_rotation(F.lit(WT[135:180]), turned).alias("turned"))


# all rotations, base by base
@query(with_reads(", t AS (SELECT DISTINCT substr(read_seq, 120, 20 + CAST(read_id % 30 AS INT)) AS s FROM reads), q AS (SELECT substr(w, 136, 45) AS c FROM wt), k AS (SELECT s, c, unnest(range(45)) AS k FROM t, q), r AS (SELECT s, k, substr(c || c, CAST(k + 1 AS INT), CAST(least(length(s), 45) AS INT)) AS turn FROM k), m AS (SELECT s, k, list_sum(list_transform(range(1, length(turn) + 1), lambda i: CASE WHEN turn[i] = s[i] THEN 1 ELSE 0 END)) AS same FROM r) SELECT s, round(max(same) / greatest(length(s), 45)::DOUBLE, 6) AS identity FROM m GROUP BY s"))
def rotational_identity(spark, sf_dir):
    """The best identity of any rotation of a known insertion with a piece of each read."""
    from tandemlake.kernels.rotation import rotational_identity as best

    @F.pandas_udf("double")
    def identity(s: pd.Series) -> pd.Series:
        return s.map(lambda x: best(WT[135:180], x))

    size = (20 + F.col("read_id") % 30).cast("int")
    t = reads(spark, sf_dir).select(F.substring("read_seq", F.lit(120), size).alias("s")).distinct()
    return t.select("s", F.round(identity("s"), 6).alias("identity"))


@query("SELECT x, regexp_replace(x, '(_H[0-9]+(_[0-9]+)?)+$', '') AS root, length(x) % 3 = 0 AS in_frame FROM (SELECT DISTINCT concat('ITD_', o_custkey % 7, '_H', o_orderkey % 3, CASE WHEN o_orderkey % 2 = 0 THEN '_2' ELSE '' END) AS x FROM orders)")
def root_alias(spark, sf_dir):
    o = fixtures.orders(spark, sf_dir)
    x = F.concat(F.lit("ITD_"), (F.col("o_custkey") % 7).cast("string"), F.lit("_H"), (F.col("o_orderkey") % 3).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "_2").otherwise(""))
    return o.select(x.alias("x")).distinct().select("x", S.root_alias(F.col("x")).alias("root"), (F.length("x") % 3 == 0).alias("in_frame"))


@query(with_reads(f"{_ASSIGNED}, pr AS (SELECT haplotype AS truth, gmm_peak_alias AS label, count(*)::DOUBLE AS c FROM assigned GROUP BY 1, 2), a AS (SELECT truth, sum(c) AS s FROM pr GROUP BY 1), b AS (SELECT label, sum(c) AS s FROM pr GROUP BY 1), m AS (SELECT sum(c) AS n, sum(c * (c - 1) / 2) AS pc, sum(c * ln(c)) AS hc, (SELECT sum(s * (s - 1) / 2) FROM a) AS pt, (SELECT sum(s * ln(s)) FROM a) AS ht, (SELECT sum(s * (s - 1) / 2) FROM b) AS pl, (SELECT sum(s * ln(s)) FROM b) AS hl FROM pr) SELECT CAST(n AS BIGINT) AS n, round((pc - pt * pl / (n * (n - 1) / 2)) / ((pt + pl) / 2 - pt * pl / (n * (n - 1) / 2)), 6) AS ari, round(1 - ((ln(n) - hc / n) - (ln(n) - hl / n)) / (ln(n) - ht / n), 6) AS homogeneity, round(1 - ((ln(n) - hc / n) - (ln(n) - ht / n)) / (ln(n) - hl / n), 6) AS completeness FROM m"))
def cluster_agreement(spark, sf_dir):
    t = quantify.cluster_agreement(_by_peak(spark, sf_dir).select(F.col("haplotype").alias("truth"), F.col("gmm_peak_alias").alias("label")))
    return t.select("n", *[F.round(c, 6).alias(c) for c in ("ari", "homogeneity", "completeness")])


@query(with_reads(", t AS (SELECT haplotype, strand, count(*) AS n FROM reads GROUP BY 1, 2) SELECT haplotype, coalesce(max(n) FILTER (WHERE strand = '+'), 0) AS plus_n, coalesce(max(n) FILTER (WHERE strand = '-'), 0) AS minus_n FROM t GROUP BY 1"))
def validation_crosstab(spark, sf_dir):
    p = reads(spark, sf_dir).groupBy("haplotype").pivot("strand", ["+", "-"]).count()
    return p.select("haplotype", F.coalesce("+", F.lit(0)).alias("plus_n"), F.coalesce("-", F.lit(0)).alias("minus_n"))


@query(with_reads(f"{_ASSIGNED}, h AS (SELECT read_len, count(*) AS n_all FROM reads GROUP BY 1), k AS (SELECT read_len, count(*) AS n_assigned FROM assigned GROUP BY 1), t AS (SELECT count(*) AS t FROM reads) SELECT CAST(read_len AS BIGINT) AS read_len, n_all, coalesce(n_assigned, 0) AS n_assigned, round((SELECT sum(t * fraction * exp(-power((h.read_len - mean_bp) / sd_bp, 2) / 2) / (sd_bp * sqrt(2 * pi()))) FROM peaks, t), 4) AS fitted FROM h LEFT JOIN k USING (read_len)"))
def length_profile_data(spark, sf_dir):
    f = figures.length_profile(reads(spark, sf_dir), _by_peak(spark, sf_dir), fixed_peaks(spark))
    return f.select(long("read_len"), "n_all", "n_assigned", F.round("fitted", 4).alias("fitted"))


@query(with_reads("SELECT quantile_cont(read_len, 0.995) AS p FROM reads"))
def axis_limit(spark, sf_dir):
    return figures.axis_limit(reads(spark, sf_dir))


@query(with_reads(f"{_EXACT}, c AS (SELECT strand AS peak_alias, ins_len, count(*) AS n FROM ins GROUP BY 1, 2), m AS (SELECT strand AS peak_alias, avg(ins_len) AS mean_len, stddev_samp(ins_len) AS sd_len FROM ins GROUP BY 1) SELECT peak_alias, CAST(ins_len AS BIGINT) AS ins_len, n, round(mean_len, 6) AS mean_len, round(sd_len, 6) AS sd_len FROM c JOIN m USING (peak_alias)"))
def insertion_size_distribution(spark, sf_dir):
    f = figures.size_distribution(_exact(spark, sf_dir).select(F.col("strand").alias("peak_alias"), "ins_len"))
    return f.select("peak_alias", long("ins_len"), "n", F.round("mean_len", 6).alias("mean_len"), F.round("sd_len", 6).alias("sd_len"))


@query(with_reads(f"{_EXACT}, c AS (SELECT strand AS peak_alias, ins_len AS l, count(*)::DOUBLE AS w FROM ins GROUP BY 1, 2), m AS (SELECT strand AS peak_alias, count(*)::DOUBLE AS n, stddev_samp(ins_len) * power(count(*), -0.2) AS h, min(ins_len) AS low, max(ins_len) AS high FROM ins GROUP BY 1), g AS (SELECT *, unnest(range(0, CAST((high - low) * 2 + 1 AS INT))) / 2.0 + low AS x FROM m) SELECT g.peak_alias, CAST(x AS DOUBLE) AS x, round(sum(w * exp(-power((x - l) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density FROM g JOIN c USING (peak_alias) GROUP BY ALL"))
def density_curve(spark, sf_dir):
    f = figures.density_curve(_exact(spark, sf_dir).select(F.col("strand").alias("peak_alias"), "ins_len"))
    return f.select("peak_alias", "x", F.round("density", 9).alias("density"))


@query(with_reads(f"{_EXACT} SELECT coalesce(min(n) > 1, true) AS allowed FROM (SELECT strand, count(DISTINCT ins_len) AS n FROM ins GROUP BY 1)"))
def density_allowed(spark, sf_dir):
    return figures.density_allowed(_exact(spark, sf_dir).select(F.col("strand").alias("peak_alias"), "ins_len"))


_EXONS = "exons AS (SELECT * FROM (VALUES " + ", ".join(f"('{e}', {a}, {b})" for e, a, b in exons("hg19")) + ") v(label, exon_start, exon_end))"


# the stretch that the longest read covers from the amplicon's start on
@query(with_reads(f", {_EXONS}, e AS (SELECT {AMPLICON['hg19'][0]} AS s, {AMPLICON['hg19'][0]} + (SELECT max(read_len) FROM reads) - 1 AS e) SELECT label, CAST(greatest(exon_start, s) AS BIGINT) AS \"from\", CAST(least(exon_end, e) AS BIGINT) AS \"to\" FROM exons, e WHERE exon_start <= e AND exon_end >= s"))
def exon_overlaps(spark, sf_dir):
    longest = reads(spark, sf_dir).agg(F.max("read_len")).first()[0] or 1
    start = AMPLICON["hg19"][0]
    return figures.exon_overlaps(figures.exons_frame(spark, "hg19"), start, start + longest - 1).select("label", long("from"), long("to"))


@query(with_reads(f"{_EXACT}, e AS (SELECT * FROM (VALUES " + ", ".join(f"('{e}', {a}, {b})" for e, a, b in exons("hg38")) + f") v(label, a, b)), p AS (SELECT read_id, {AMPLICON['hg38'][0]} + ins_pos - 1 AS pos, ins_len FROM ins) SELECT read_id, CAST(pos AS BIGINT) AS genomic_pos, label AS exon FROM p LEFT JOIN e ON pos BETWEEN a AND b"))
def genome_view(spark, sf_dir):
    found = _exact(spark, sf_dir).select(F.col("read_id").cast("string").alias("ref_alias"), S.genomic_position(F.col("ins_pos"), AMPLICON["hg38"][0], len(WT)).alias("genomic_pos"), F.col("ins_len").alias("itd_len"))
    return figures.genome_view(found).select(F.col("ref_alias").cast("long").alias("read_id"), long("genomic_pos"), "exon")


@query(with_reads(f"{_EXACT}, r AS (SELECT strand AS peak_alias, read_id, ins_pos, ins_len, row_number() OVER (PARTITION BY strand ORDER BY ins_pos, ins_len, read_id) - 1 AS i, count(*) OVER (PARTITION BY strand) AS n FROM ins) SELECT peak_alias, read_id, CAST(ins_pos AS BIGINT) AS ins_pos, CAST(ins_len AS BIGINT) AS ins_len FROM r WHERE n <= 30 OR i IN (SELECT k * n // 30 FROM range(30) t(k))"))
def pileup_sample(spark, sf_dir):
    rows = _exact(spark, sf_dir).select(F.col("strand").alias("peak_alias"), "read_id", F.col("ins_pos").alias("ins_pos_ref"), "ins_len")
    return figures.pileup_rows(rows).select("peak_alias", "read_id", F.col("ins_pos_ref").cast("long").alias("ins_pos"), long("ins_len"))


@query(with_reads(_ALIGNED_ALLELES + ", cell AS (SELECT peak_alias, n, unnest(range(1, length(aligned) + 1)) AS col, aligned FROM aa), v AS (SELECT peak_alias, col, substr(aligned, CAST(col AS INT), 1) AS base, sum(n) AS w FROM cell GROUP BY 1, 2, 3) SELECT peak_alias, col - 1 AS col, round(max(w) / sum(w), 6) AS agreement FROM v WHERE base <> '-' GROUP BY 1, 2"))
def column_agreement(spark, sf_dir):
    rows = reads(spark, sf_dir).where(F.length("read_seq").isin(336, 381)).select(F.when(F.length("read_seq") == 336, "WT").otherwise("ITD_2").alias("peak_alias"), F.regexp_replace("read_seq", "TTTT", "TT--").alias("aligned"))
    return figures.column_agreement(rows.groupBy("peak_alias", "aligned").agg(F.count("*").alias("n")), ["peak_alias"]).select("peak_alias", long("col"), F.round("agreement", 6).alias("agreement"))


@query(with_reads(_AF + """ SELECT ref_alias, '{"ref_alias":"' || ref_alias || '","read_id":' || read_id || '}' AS line FROM sup WHERE ref_alias IN (SELECT ref_alias FROM af WHERE allele_frequency >= 0.1)"""))
def membership_lines(spark, sf_dir):
    v = _validated(spark, sf_dir)
    return figures.membership_json(v, quantify.allele_frequencies(v, 0.1))


@query(with_reads(_AF + f", {_CALLS} SELECT ref_alias, size AS itd_len, n_itd_reads, round(allele_frequency, 6) AS allele_frequency FROM af JOIN calls USING (ref_alias) WHERE allele_frequency >= 0.05"))
def reported_calls(spark, sf_dir):
    calls = spark.createDataFrame([("ITD_A", 180, WT[135:180]), ("ITD_B", 120, WT[75:120]), ("ITD_C", 180, WT[150:180])], "peak_alias string, consensus_ins_pos_ref int, consensus_seq string")
    f = figures.reported_calls(consensus.reference_alleles(calls), quantify.allele_frequencies(_validated(spark, sf_dir), 0.05))
    return f.select("ref_alias", "itd_len", "n_itd_reads", F.round("allele_frequency", 6).alias("allele_frequency"))


@query()
def final_support_msa(spark, sf_dir):
    """The panel of each call's supporting sequences, aligned; rows only."""
    calls = spark.createDataFrame([("ITD_A", 180, WT[135:180]), ("ITD_B", 120, WT[75:120]), ("ITD_C", 180, WT[150:180])], "peak_alias string, consensus_ins_pos_ref int, consensus_seq string")
    support = reads(spark, sf_dir).where("haplotype in ('ITD_A', 'ITD_B', 'ITD_C')").select(F.col("haplotype").alias("ref_alias"), "read_id", "read_seq")
    return figures.final_support_msa(support, consensus.reference_alleles(calls))


@query(with_reads(f"{_AUDIT}, seeds2 AS (SELECT allele_id, allele, substr(w, 1, {START}) AS pre, win, substr(w, {STOP + 1}) AS post FROM audit WHERE status = 'eligible'), sup2 AS (SELECT read_id, strand, CASE WHEN read_seq = w THEN 'WT' ELSE s.allele_id END AS ref_alias FROM reads CROSS JOIN wt LEFT JOIN seeds2 s ON reads.read_seq = s.allele WHERE read_seq = w OR s.allele_id IS NOT NULL), c2 AS (SELECT ref_alias, count(*) AS n, count(*) FILTER (WHERE strand = '+') AS p FROM sup2 GROUP BY 1) SELECT ref_alias, n AS n_itd_reads, (SELECT count(*) FROM sup2) AS n_total_reads, round(n / (SELECT count(*) FROM sup2), 6) AS allele_frequency, p AS plus_reads, n - p AS minus_reads FROM c2 WHERE ref_alias <> 'WT' AND n / (SELECT count(*) FROM sup2) >= 0.01"))
def exact_itd_calls(spark, sf_dir):
    """The flagship: discovery by exact recurrence, exact allele support, frequency and strand counts."""
    from tandemlake.plans.pipeline import exact_calls

    t = exact_calls(reads(spark, sf_dir), SETTINGS, 0.01)
    return t.select("ref_alias", "n_itd_reads", "n_total_reads", F.round("allele_frequency", 6).alias("allele_frequency"), "plus_reads", "minus_reads")


# the pipeline's names of the planted alleles: two split from the peak of their size, one alone in its, one found by recurrence
@query(with_reads(_nearest_sql("SELECT CASE haplotype WHEN 'ITD_A' THEN 'ITD_2_H1' WHEN 'ITD_B' THEN 'ITD_2_H2' WHEN 'ITD_C' THEN 'ITD_1' WHEN 'ITD_D' THEN 'ITD_OBS_' || substr(sha256(allele), 1, 12) ELSE haplotype END AS ref_alias, allele AS ref_seq FROM haps") + " SELECT ref_alias, count(*) AS n_itd_reads, (SELECT count(*) FROM reads) AS n_total_reads, round(count(*) / (SELECT count(*) FROM reads), 6) AS allele_frequency, count(*) FILTER (WHERE strand = '+') AS plus_reads, count(*) FILTER (WHERE strand = '-') AS minus_reads FROM reads JOIN near USING (read_seq) WHERE ref_alias <> 'WT' GROUP BY 1" + f" HAVING count(*) / (SELECT count(*) FROM reads) >= {SETTINGS.min_allele_frequency}"))
def itd_pipeline(spark, sf_dir):
    """The whole pipeline from reads to calls."""
    from tandemlake.operators.lineage import remove, stage
    from tandemlake.plans.pipeline import _small, run

    # derived once: a plan with common table expressions that a join has twice isn't found among the cached ones
    r = stage(reads(spark, sf_dir).select("read_id", "read_seq", "read_qual", "strand", "read_len"))
    t = _small(run(r, SETTINGS).summary)
    remove(r)
    return t.select("ref_alias", "n_itd_reads", "n_total_reads", F.round("allele_frequency", 6).alias("allele_frequency"), "plus_reads", "minus_reads")
