"""python -m tandemlake --bam FILE --output-folder DIR --sample-name NAME [options]: from a BAM file to calls."""

from __future__ import annotations

import argparse
import shutil
from dataclasses import fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemlake.assay import EXTRACTION, Settings, resolve_contig
from tandemlake.operators import figures, observed, quantify
from tandemlake.operators.reads import keep_last, region_scan, restore_orientation, trim_primers
from tandemlake.plans import pipeline
from tandemlake.sources import bam, files, sinks


def read_sample(spark: SparkSession, path: str, settings: Settings) -> DataFrame:
    """Trimmed reads of a BAM file: the extraction window, sequencing orientation, primers, length band."""
    bam.register(spark)
    rows = spark.read.format("bam").load(path)
    names = bam.read_header(files.listed(path, ".bam")[0][0]).contigs
    start, end = EXTRACTION["hg38" if settings.genome == "hg38" else "hg19"]
    inside = region_scan(rows.where(F.col("chrom") == resolve_contig(names)), start, end, settings.min_mapping_quality)
    oriented = restore_orientation(inside).select(F.col("read_name").alias("read_id"), F.col("seq").alias("read_seq"), F.col("qual").alias("read_qual"), "place")
    # of equal names the record that stands last in the file
    return trim_primers(keep_last(oriented, ["read_id"], [F.col("place")]).drop("place", "n_rows"), settings)


def write_figures(result: pipeline.Result, reads: DataFrame, folder: Path, settings: Settings) -> list[str]:
    """Writes the data of the report's figures and what is told of each call; returns the names of the tables.

    Read lengths by peak, insertion sizes with their density, a pileup, calls with letters and exons, lengths and ids of the
    reads behind each call, these reads aligned, agreement by column, where the heaviest alleles differ, and each allele's
    alignment to the wild type as text."""
    made: dict[str, DataFrame] = {}
    if result.peaks is not None:
        made["peaks"] = result.peaks
    if result.assigned is not None and result.peaks is not None:
        made["length_profile"] = figures.length_profile(reads, result.assigned, result.peaks)
    if result.insertions is not None:
        made["insertion_sizes"] = figures.size_distribution(result.insertions)
        made["insertion_density"] = figures.density_curve(result.insertions)
        made["pileup"] = figures.pileup_rows(result.insertions)
    if result.validation is not None:
        support = quantify.final_support(result.validation).join(F.broadcast(result.summary.select("ref_alias")), "ref_alias", "left_semi").join(reads.select("read_id", "read_seq"), "read_id")
        aligned = figures.final_support_msa(support.select("ref_alias", "read_id", "read_seq"), result.references).cache()
        lengths = quantify.final_support_lengths(result.validation, reads, result.summary)
        made |= {
            "reported_calls": quantify.display_labels(figures.reported_calls(result.references, result.summary)), "genome_view": figures.genome_view(result.references, settings.genome),
            "support_lengths": lengths.groupBy("ref_alias", "read_len").agg(F.count("*").alias("n")), "support_alignment": aligned, "column_agreement": figures.column_agreement(aligned, ["ref_alias"]), "allele_differences": figures.top_differences(aligned),
        }
        figures.membership_json(result.validation, result.summary).select("line").write.mode("overwrite").text(str(folder / "membership"))
        for r in figures.alignment_texts(result.references).join(F.broadcast(result.summary.select("ref_alias")), "ref_alias", "left_semi").collect():  # a handful of calls
            (folder / f"alignment_{r.ref_alias}.txt").write_text(r.text)
    for name, rows in made.items():
        sinks.write_tsv(rows, str(folder / name), one=name != "pileup")
    return [*made, *(["membership"] if result.validation is not None else [])]


#: Tables that are written on the way to the calls.
TABLES = ["insertions", "unresolved_consensus", "consensus", "read_support", "observed_audit", "references"]


def run_sample(spark: SparkSession, path: str, out: str, sample: str, settings: Settings, report: bool = True, keep_tables: bool = True) -> int:
    """Writes calls (VCF), tables (TSV) and, if asked for, a report; returns the number of calls. Without calls, the same files
    with headers alone. Without keep_tables, only calls, summary, report and log stay."""
    folder = Path(out)
    folder.mkdir(parents=True, exist_ok=True)
    log = str(folder / "stages.jsonl")
    reads = read_sample(spark, path, settings).cache()
    n = reads.count()
    sinks.record_stage(log, "reads", bam=path, rows=n)
    if not n:
        sinks.write_vcf(str(folder / f"{sample}.vcf"), sample, None, settings.genome)
        if report:
            (folder / f"{sample}.html").write_text(sinks.html_report(sample, [], reason="no reads"))
        return 0
    result = pipeline.run(reads, settings)
    if result.audit is not None:
        sinks.write_tsv(result.audit, str(folder / "observed_audit"))
    if result.insertions is not None:
        sinks.write_tsv(result.insertions, str(folder / "insertions"), one=False)
    if result.unresolved is not None:
        sinks.write_tsv(result.unresolved, str(folder / "unresolved_consensus"))
    warnings = []
    if result.consensus is not None:
        sinks.write_tsv(result.consensus, str(folder / "consensus"))
        warnings = [r.peak_alias for r in pipeline.mixed_consensus(result.consensus).orderBy("peak_alias").collect()]
        sinks.record_stage(log, "consensus", mixed=warnings)
    calls = []
    if result.validation is not None:
        sinks.write_tsv(result.summary, str(folder / "summary"))
        sinks.write_tsv(result.validation, str(folder / "read_support"), one=False)
        support = result.validation.groupBy("ref_alias", "valid_support").agg(F.count("*").alias("n")).orderBy("ref_alias", "valid_support").collect()
        sinks.record_stage(log, "validation", support=[r.asDict() for r in support])
        calls = result.summary.join(result.references, "ref_alias").orderBy(F.desc("allele_frequency"), "ref_alias").collect()
        result.references.select(sinks.fasta_record().alias("value")).coalesce(1).write.mode("overwrite").text(str(folder / "references"))
    outcomes = observed.locate_anchors(reads.groupBy(F.upper("read_seq").alias("seq")).agg(F.count("*").alias("n")), settings).groupBy("outcome").agg(F.sum("n").alias("n")).orderBy("outcome").collect()
    sinks.record_stage(log, "anchors", **{r.outcome: r.n for r in outcomes})
    tables = [*TABLES, *write_figures(result, reads, folder, settings)]
    sinks.write_vcf(str(folder / f"{sample}.vcf"), sample, sinks.vcf_lines(result.summary, result.references, result.peaks, result.audit) if calls else None, settings.genome)
    if report:
        lengths = [(r.read_len, r.n) for r in reads.groupBy("read_len").agg(F.count("*").alias("n")).orderBy("read_len").collect()]
        (folder / f"{sample}.html").write_text(sinks.html_report(sample, calls, lengths, result.reason, warnings, settings.genome))
    sinks.record_stage(log, "calls", rows=len(calls), reason=result.reason)
    if not keep_tables:
        for name in tables:
            shutil.rmtree(folder / name, ignore_errors=True)
    return len(calls)


#: Other names of flags.
ALIASES = {"omega_a": ["--dada2-omega-a"], "band_size": ["--dada2-band-size"], "homopolymer_gap_penalty": ["--dada2-homopolymer-gap-penalty"]}


def main() -> None:
    p = argparse.ArgumentParser(prog="tandemlake", description=__doc__)
    p.add_argument("-b", "--bam", required=True)
    p.add_argument("-o", "--output-folder", required=True)
    p.add_argument("-s", "--sample-name", required=True)
    p.add_argument("--html-report", action="store_true")
    p.add_argument("--keep-tables", action=argparse.BooleanOptionalAction, default=True)
    for f in fields(Settings):
        flag = ["--" + f.name.replace("_", "-"), *ALIASES.get(f.name, ())]
        if isinstance(f.default, bool):
            p.add_argument(*flag, action=argparse.BooleanOptionalAction, default=f.default)
        else:
            p.add_argument(*flag, dest=f.name, type=int if f.default is None else type(f.default), default=f.default)
    a = vars(p.parse_args())
    settings = Settings(**{f.name: a[f.name] for f in fields(Settings)})
    spark = SparkSession.builder.appName("tandemlake").getOrCreate()
    print(f"{run_sample(spark, a['bam'], a['output_folder'], a['sample_name'], settings, a['html_report'], a['keep_tables'])} calls")


if __name__ == "__main__":
    main()
