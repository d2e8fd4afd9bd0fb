"""Sinks: VCF, FASTA, TSV, HTML report and audit lines. Calls are at most a handful of rows."""

from __future__ import annotations

import html
import json
import math
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandemlake.assay import AMPLICON, WT, exons
from tandemlake.functions.sequence import mid

# Lengths of chromosome 13.
CHR13 = {"hg38": 114364328, "hg19": 115169878}


def _anchor() -> Column:
    """The reference base before the insertion; N where there is none."""
    return F.when(F.col("local_pos") > 0, mid(F.lit(WT), F.col("local_pos") - 1, 1)).otherwise("N")


def vcf_site() -> Column:
    """The first seven fields of a VCF line, from reference_alleles columns."""
    return F.concat_ws("\t", "chrom", F.col("genomic_pos").cast("string"), F.lit("."), _anchor(), F.concat(_anchor(), "itd_seq"), F.lit("."), F.lit("PASS"))


_NOTES = {"sequence_alternatives": "string", "duplication_identity": "double", "normalized_flank_reads": "long"}


def vcf_lines(summary: DataFrame, references: DataFrame, peaks: DataFrame | None = None, audit: DataFrame | None = None) -> DataFrame:
    """line of each call, by descending frequency: alleles, INFO and one sample's FORMAT fields. audit: adds what is noted of
    the observed allele that a call is (one-base alternatives, duplication identity, reads with corrected flanks)."""
    j = summary.join(F.broadcast(references), "ref_alias")
    if audit is not None:
        noted = audit.where("peak_alias is not null").groupBy(F.col("peak_alias").alias("ref_alias")).agg(*[F.max(F.col(c).cast(kind)).alias(c) for c, kind in _NOTES.items()])
        j = j.join(F.broadcast(noted), "ref_alias", "left")
    else:
        j = j.withColumns({c: F.lit(None).cast(kind) for c, kind in _NOTES.items()})
    fitted = peaks.select(F.col("peak_alias").alias("ref_alias"), F.col("effective_allele_freq").alias("af_gmm"), F.col("fraction").alias("af_fitted")) if peaks is not None else None
    j = j.join(F.broadcast(fitted), "ref_alias", "left") if fitted is not None else j.withColumns({"af_gmm": F.lit(None).cast("double"), "af_fitted": F.lit(None).cast("double")})
    number = lambda c: F.coalesce(F.format_string("%.5f", F.col(c)), F.lit("."))
    short = lambda c: F.when(F.col(c).isNull() | F.isnan(c), ".").when(F.col(c) == float("inf"), "Inf").otherwise(F.format_string("%.3g", F.col(c)))
    info = F.concat(
        F.lit("TYPE=ITD;AF="), number("allele_frequency"), F.lit(";DP="), F.col("n_total_reads").cast("string"), F.lit(";AF_GMM="), number("af_gmm"), F.lit(";AF_FITTED="), number("af_fitted"), F.lit(";FISHER_P="), short("fisher_p"),
        F.lit(";STRAND_OR="), short("odds_ratio"), F.lit(";ITD_LEN="), F.col("itd_len").cast("string"), F.lit(";INS_POS="), F.col("local_pos").cast("string"),
        F.when(F.col("sequence_alternatives") != "", ";SEQUENCE_UNCERTAINTY").otherwise(""), F.when(F.col("duplication_identity").isNotNull(), F.concat(F.lit(";DUP_IDENTITY="), F.format_string("%.4f", F.col("duplication_identity")))).otherwise(""),
        F.coalesce(F.concat(F.lit(";FLANK_NORMALIZED_READS="), F.col("normalized_flank_reads").cast("string")), F.lit("")),
    )
    rest = F.greatest(F.col("n_total_reads") - F.col("n_itd_reads"), F.lit(0))
    sample = F.concat_ws(":", F.lit("0/1"), F.col("n_total_reads").cast("string"), number("allele_frequency"), F.concat_ws(",", rest.cast("string"), F.col("n_itd_reads").cast("string")), F.concat_ws(",", F.col("plus_reads").cast("string"), F.col("minus_reads").cast("string")))
    return j.select("allele_frequency", "ref_alias", F.concat_ws("\t", vcf_site(), info, F.lit("GT:DP:AF:AD:SB"), sample).alias("line"))


def vcf_header(sample: str, genome: str = "hg38") -> str:
    meta = [("TYPE", "1", "String", "Variant type"), ("AF", "1", "Float", "Allele frequency"), ("DP", "1", "Integer", "Supporting reads of all alleles"), ("AF_GMM", "1", "Float", "Share of reads in the length peak"), ("AF_FITTED", "1", "Float", "Weight of the length peak"), ("FISHER_P", "1", "Float", "Strand test p"), ("STRAND_OR", "1", "Float", "Strand odds ratio"), ("ITD_LEN", "1", "Integer", "Inserted bases"), ("INS_POS", "1", "Integer", "Insertion boundary in the amplicon"), ("SEQUENCE_UNCERTAINTY", "0", "Flag", "One-base alternatives were seen"), ("DUP_IDENTITY", "1", "Float", "Identity with the adjacent copy"), ("FLANK_NORMALIZED_READS", "1", "Integer", "Reads whose anchors were corrected to the reference")]
    formats = [("GT", "1", "String", "Genotype"), ("DP", "1", "Integer", "Depth"), ("AF", "1", "Float", "Allele frequency"), ("AD", "R", "Integer", "Reads by allele"), ("SB", "2", "Integer", "Reads by strand")]
    lines = ["##fileformat=VCFv4.2", f"##contig=<ID=chr13,length={CHR13['hg38' if genome == 'hg38' else 'hg19']}>"]
    lines += [f'##{kind}=<ID={i},Number={n},Type={t},Description="{d}">' for kind, rows in (("INFO", meta), ("FORMAT", formats)) for i, n, t, d in rows]
    return "\n".join([*lines, "#" + "\t".join(["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", sample])]) + "\n"


def write_vcf(path: str, sample: str, lines: DataFrame | None, genome: str = "hg38") -> int:
    """Writes header and calls; without lines, a header alone. Returns the number of calls."""
    rows = [r.line for r in lines.orderBy(F.desc("allele_frequency"), "ref_alias").collect()] if lines is not None else []
    Path(path).write_text(vcf_header(sample, genome) + "".join(f"{r}\n" for r in rows))
    return len(rows)


def read_vcf(spark, path: str) -> DataFrame:
    """chrom, pos, ref, alt, info (a map; flags without a value are left out) and inserted (alt without the anchor base)."""
    raw = spark.read.csv(path, sep="\t", comment="#").toDF("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", *[f"_f{i}" for i in range(2)])
    pairs = F.filter(F.split("info", ";"), lambda x: x.contains("="))
    info = F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.substring_index(x, "=", 1), F.substring(x, F.instr(x, "=") + 1, F.length(x)))))
    return raw.select("chrom", F.col("pos").cast("long").alias("pos"), "ref", "alt", info.alias("info"), F.substring("alt", F.lit(2), F.length("alt")).alias("inserted"))


def fasta_record() -> Column:
    """A FASTA record of a reference allele."""
    where = F.coalesce(F.concat("chrom", F.lit(":"), F.col("genomic_pos").cast("string")), F.lit("."))
    return F.concat(F.lit(">"), "ref_alias", F.lit(" len="), F.length("ref_seq").cast("string"), F.lit(" itd="), F.col("itd_len").cast("string"), F.lit(" pos="), where, F.lit("\n"), "ref_seq")


def write_tsv(df: DataFrame, path: str, one: bool = True) -> None:
    """TSV with a header in a folder: one file for tables of a few rows, else one of each task. Nested columns as JSON."""
    flat = [F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(c) for c in df.columns]
    out = df.select(*flat)
    (out.coalesce(1) if one else out).write.mode("overwrite").csv(path, sep="\t", header=True)


def read_tsv(spark, path: str, schema: str | None = None) -> DataFrame:
    """A table that write_tsv wrote."""
    reader = spark.read.option("sep", "\t").option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def wrap(seq: str, width: int = 60) -> str:
    return "\n".join(seq[i : i + width] for i in range(0, len(seq), width))


def marked(text: str) -> str:
    """HTML of a wrapped sequence with its unresolved bases marked."""
    return html.escape(text).replace("N", "<mark>N</mark>")


def flags(call: Row) -> list[str]:
    """What a reader of the report should know about a call."""
    out = []
    if "N" in call.itd_seq:
        out.append("unresolved bases")
    if call.n_itd_reads < 50:
        out.append("fewer than 50 reads")
    total = call.plus_reads + call.minus_reads
    share = call.plus_reads / total if total else 0.5
    odds, p = call.odds_ratio, call.fisher_p
    if share <= 0.05 or share >= 0.95 or (p is not None and p <= 0.05 and odds is not None and not math.isnan(odds) and (odds >= 3 or odds <= 1 / 3)):
        out.append("strand bias")
    if call.itd_len % 3:
        out.append("frameshift")
    return out


def histogram_svg(rows: list[tuple[int, int]], width: int = 640, height: int = 160) -> str:
    """Counts by length as bars."""
    if not rows:
        return ""
    low, high, top = min(x for x, _ in rows), max(x for x, _ in rows), max(n for _, n in rows)
    step = width / (high - low + 1)
    bars = "".join(f'<rect x="{(x - low) * step:.1f}" y="{height - height * n / top:.1f}" width="{max(step - 0.5, 0.5):.1f}" height="{height * n / top:.1f}"><title>{x} bp: {n}</title></rect>' for x, n in rows)
    return f'<svg viewBox="0 0 {width} {height}" width="{width}" height="{height}" fill="#4a6fa5">{bars}</svg>'


def genome_svg(calls: list[Row], genome: str = "hg38", width: int = 640) -> str:
    """The amplicon with its exons, and a mark where each call inserts."""
    start, end = AMPLICON["hg38" if genome == "hg38" else "hg19"]
    x = lambda pos: (pos - start) * width / (end - start)
    boxes = "".join(
        f'<rect x="{x(max(a, start)):.1f}" y="30" width="{x(min(b, end)) - x(max(a, start)):.1f}" height="14" fill="#9db4d3"><title>{label}</title></rect><text x="{x(max(a, start)):.1f}" y="60" font-size="11">{label}</text>'
        for label, a, b in exons(genome) if a <= end and b >= start
    )
    marks = "".join(f'<line x1="{x(c.genomic_pos):.1f}" x2="{x(c.genomic_pos):.1f}" y1="8" y2="44" stroke="#b03a2e"><title>{html.escape(c.ref_alias)}: {c.itd_len} bp</title></line>' for c in calls)
    return f'<svg viewBox="0 0 {width} 64" width="{width}" height="64"><line x1="0" x2="{width}" y1="37" y2="37" stroke="#666"/>{boxes}{marks}</svg>'


def _letters(calls: list[Row]) -> dict[str, str]:
    """Each call's size, with a letter where several calls have it, as quantify.display_labels gives."""
    by_size: dict[int, list[str]] = {}
    for c in sorted(calls, key=lambda c: c.ref_alias):
        by_size.setdefault(c.itd_len, []).append(c.ref_alias)
    return {alias: f"{size} bp" + (f" {chr(65 + i)}" if len(names) > 1 else "") for size, names in by_size.items() for i, alias in enumerate(names)}


def html_report(sample: str, calls: list[Row], lengths: list[tuple[int, int]] = (), reason: str = "", mixed: list[str] = (), genome: str = "hg38") -> str:
    """A self-contained report: verdict, length profile, table, a card for each call, and a warning for each consensus that
    may be a mixture."""
    e = html.escape
    verdict = f"{len(calls)} internal tandem duplication{'s' * (len(calls) != 1)} reported" if calls else f"No internal tandem duplication reported. {e(reason)}"
    label = _letters(calls)
    number = lambda v, f: "." if v is None or math.isnan(v) else format(v, f)
    rows = "".join(
        f"<tr><td>{e(c.ref_alias)}</td><td>{e(label[c.ref_alias])}</td><td>{c.allele_frequency:.4f}</td><td>{c.n_itd_reads} of {c.n_total_reads}</td><td>{c.plus_reads}/{c.minus_reads}</td><td>{number(c.odds_ratio, '.3g')}</td><td>{number(c.fisher_p, '.3g')}</td></tr>"
        for c in calls
    )
    cards = "".join(f"<section><h2>{e(c.ref_alias)}: {e(label[c.ref_alias])} at chr13:{c.genomic_pos}</h2><p>{e('; '.join(flags(c)) or 'no flags')}</p><pre>{marked(wrap(c.itd_seq))}</pre></section>" for c in calls)
    table = f"<table><tr><th>Call</th><th>Size</th><th>Frequency</th><th>Reads</th><th>+/-</th><th>Strand odds</th><th>p</th></tr>{rows}</table>{genome_svg(calls, genome)}" if calls else ""
    warnings = "".join(f"<p class='warning'>The consensus of {e(m)} may stand for several alleles.</p>" for m in mixed)
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{e(sample)}</title></head><body><h1>{e(sample)}</h1><p>{verdict}</p>{histogram_svg(list(lengths))}{table}{cards}{warnings}</body></html>"


def record_stage(path: str, stage: str, **facts) -> None:
    """Appends a line of JSON to the audit log."""
    with open(path, "a", encoding="utf-8") as log:
        log.write(json.dumps({"timestamp": datetime.now(timezone.utc).isoformat(), "stage": stage, **facts}, sort_keys=True) + "\n")
