"""FASTQ as a Python data source, split by bytes: four lines a record."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from tandemlake.sources import files, parts


class FastqReader(DataSourceReader):
    def __init__(self, path: str, size: int) -> None:
        self.path, self.size = path, size

    def partitions(self) -> list[files.Split]:
        return files.splits(self.path, ".fastq", self.size)

    def read(self, partition: files.Split) -> Iterator[tuple]:
        """Records that begin in the split. Lines from a split's middle on are a record's if the first begins with @, the
        third with + and the second and fourth are of one length."""
        with files.opened(partition.path) as f:
            lines = _lines(f, max(0, partition.start - 1))
            if partition.start:
                next(lines, None)  # the rest of the line that stands at the split's edge
            four: list[tuple[int, str]] = []
            known = partition.start == 0
            for at, line in lines:
                four.append((at, line))
                if len(four) < 4:
                    continue
                if not known and not (four[0][1][:1] == "@" and four[2][1][:1] == "+" and len(four[1][1]) == len(four[3][1])):
                    four.pop(0)
                    continue
                known = True
                if four[0][0] >= partition.end:
                    return
                yield four[0][1][1:], four[1][1], four[3][1], four[0][0]
                four = []


def _lines(f, at: int) -> Iterator[tuple[int, str]]:
    """Offset and text of each line from byte ``at`` on."""
    f.seek(at)
    rest = b""
    while chunk := f.read(1 << 20):
        parts = (rest + chunk).split(b"\n")
        for line in parts[:-1]:
            yield at, line.rstrip(b"\r").decode()
            at += len(line) + 1
        rest = parts[-1]
    if rest:
        yield at, rest.rstrip(b"\r").decode()


class FastqWriter(parts.PartWriter):
    """Rows of header, seq and qual as records; rows without a sequence are left out."""

    suffix = ".fastq"

    def encode(self, rows: Iterator) -> Iterator[bytes]:
        for row in rows:
            if row.seq:
                yield f"@{row.header}\n{row.seq}\n+\n{row.qual}\n".encode()


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return "header string, seq string, qual string, place long"

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options["path"], int(self.options.get("splitsize", files.SPLIT)))

    def writer(self, schema, overwrite: bool) -> FastqWriter:
        return FastqWriter(self.options["path"], overwrite)


def read_fastq(spark: SparkSession, path: str, split_size: int = files.SPLIT) -> DataFrame:
    """read_id, read_seq, read_qual, strand (- if the header ends in `` rc``) and place, the byte where the record begins;
    the last of equal ids wins in dedup_reads."""
    spark.dataSource.register(FastqSource)
    rows = spark.read.format("fastq").option("splitsize", str(split_size)).load(path)
    head = F.col("header")
    return rows.select(F.substring_index(head, " ", 1).alias("read_id"), F.upper("seq").alias("read_seq"), F.col("qual").alias("read_qual"), F.when(head.endswith(" rc"), "-").otherwise("+").alias("strand"), "place")


def write_fastq(reads: DataFrame, path: str, overwrite: bool = False) -> None:
    """Reads (read_id, read_seq, read_qual) as a folder of FASTQ parts, one for each task, with qualities repaired."""
    from tandemlake.functions.sequence import repaired_quality

    reads.sparkSession.dataSource.register(FastqSource)
    rows = reads.select(F.col("read_id").cast("string").alias("header"), F.col("read_seq").alias("seq"), repaired_quality(F.col("read_seq"), F.col("read_qual")).alias("qual"))
    rows.write.format("fastq").mode("overwrite" if overwrite else "append").save(path)


def dedup_reads(reads: DataFrame) -> DataFrame:
    """The last record of each id, with its number of records in n_rows."""
    from tandemlake.operators.reads import keep_last

    return keep_last(reads, ["read_id"], [F.col("place")])


def fastq_records(reads: DataFrame) -> DataFrame:
    """A text column ``value`` with a FASTQ record for each non-empty read."""
    from tandemlake.functions.sequence import repaired_quality

    qual = repaired_quality(F.col("read_seq"), F.col("read_qual"))
    return reads.where(F.length("read_seq") > 0).select(F.concat(F.lit("@"), F.col("read_id").cast("string"), F.lit("\n"), "read_seq", F.lit("\n+\n"), qual).alias("value"))
