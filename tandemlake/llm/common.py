"""What the training-data operators share: shared-folder tables, batching, ordered prefix sums."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns of ``documents`` in their declared types; other columns, whatever their names, go."""
    kinds = {f.name: f.dataType for f in DOCUMENT_SCHEMA}
    there = set(docs.columns)
    return docs.select(*[(F.col(f"`{n}`") if n in there else F.lit(None)).cast(kinds[n]).alias(n) for n in names])


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors and the driver share. In a local session that sets none, one
    of our own; on a cluster that is an error, since no other folder is known to be shared."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = spark.sparkContext._jsc.sc().getCheckpointDir()
        at = at.get() if at.isDefined() else None
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="tandemlake-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


#: Staged tables that are still there, by their paths.
_staged: dict[str, SparkSession] = {}


def _remove(path: str) -> None:
    spark = _staged.pop(path, None)
    if spark is None or spark.sparkContext._jsc is None:  # a session that has ended leaves its folder to the cluster
        return
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _remove_all() -> None:
    for path in list(_staged):
        _remove(path)


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, removed when the process ends."""
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    _staged[path] = spark
    return path


def staged(df: DataFrame, by: str | None = None) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: lineage ends here and a lost executor loses nothing.
    by: a column of few values, each in a folder of its own, so that a filter on it reads no others."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # lets the cleaner remove the shuffle files that led to this table
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Removes staged tables that nothing still to be computed reads."""
    for df in tables:
        _remove(getattr(df, "staged_at", ""))


def in_chunks(fn: Callable[[pd.DataFrame], pd.DataFrame], column: str = "text", size: int = 1 << 20) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A mapInPandas function that hands fn slices of about ``size`` characters (one longer text stays whole)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total, first = 0, 0
            for i, value in enumerate(batch[column]):
                total += len(value) if value is not None else 0
                if total >= size:
                    yield fn(batch.iloc[first : i + 1].reset_index(drop=True))
                    total, first = 0, i + 1
            if first < len(batch):
                yield fn(batch.iloc[first:].reset_index(drop=True))

    return run


#: Input bytes to a task, and the most tasks.
TASK_BYTES, MOST_TASKS = 1 << 27, 1 << 17


def partitions(df: DataFrame) -> int:
    """Tasks of a shuffle: by the bytes that df's plan reads, and at least spark.sql.shuffle.partitions."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(n for n in sizes if n < 1 << 60)  # a table without statistics claims more than there can be
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(known // TASK_BYTES + 1, MOST_TASKS))


def ordered(df: DataFrame, *order: str, tasks: int | None = None) -> DataFrame:
    """df range-partitioned and sorted by ``order``, staged, with its partition's number in ``pid``."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    return staged(df.repartitionByRange(tasks or partitions(df), *keys).sortWithinPartitions(*keys).withColumn("pid", F.spark_partition_id()))


def running_sum(df: DataFrame, value: str, order: list[str], out: str, group: str | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all rows before a row in the total order ``order`` (of its ``group``).

    df comes from ordered(): its ``pid`` numbers ranges of that order. Each range is summed where it lies, one row per
    range and group is accumulated, and within a range a window finishes the sum. So no key, however hot, needs a task
    that holds more than a range.
    """
    keys = ["pid"] + ([group] if group else [])
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_part"))
    before = Window.partitionBy(*([group] if group else [])).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*keys, F.coalesce(F.sum("_part").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.alias("d").join(base.alias("b"), [F.col(f"d.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]).select("d.*", "b._base")
    return joined.withColumn(out, F.coalesce(F.sum(value).over(inner), F.lit(0)) + F.col("_base")).drop("_base")
