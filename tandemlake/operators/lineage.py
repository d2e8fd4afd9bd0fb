"""Cutting lineage in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Staged tables that are still there, by their paths.
_staged: dict[str, SparkSession] = {}
_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. A local session that names none gets one of its own, which ends with the process;
    on a cluster that is an error."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        known = context._jsc.sc().getCheckpointDir()
        at = known.get() if known.isDefined() else None
    if not at:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="tandemlake-")
        _own.append(at)
        context.setCheckpointDir(at)
    return at.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder, so that later plans begin there and a lost executor loses nothing."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stage(df: DataFrame) -> DataFrame:
    """The same as Parquet, for tables that remove() is to take away again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    _staged[path] = spark
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def remove(*tables: DataFrame) -> None:
    """Removes staged tables that nothing still to be computed reads."""
    for df in tables:
        path = getattr(df, "staged_at", None)
        spark = _staged.pop(path, None)
        if spark is not None and spark.sparkContext._jsc is not None:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _remove_own() -> None:
    for folder in _own:
        shutil.rmtree(folder, ignore_errors=True)
