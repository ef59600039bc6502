"""Cutting lineage through tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in local mode with none set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="muster-")
    context.setCheckpointDir(folder)
    return folder


def session_folder(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables."""
    return f"{shared_folder(spark)}/muster-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, label: str = "stage", split_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The table outlives lost executors, is computed in one pass, and its real size is known to the
    optimizer for the joins that follow.  Readers of single values of ``split_by``, a column of few
    values that comes last, open only the files of these.
    """
    spark = df.sparkSession
    path = f"{session_folder(spark)}/{label}-{uuid.uuid4().hex}"
    # Nothing reads the shuffles of this job once its table is written.
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (df.write if split_by is None else df.write.partitionBy(split_by)).parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._muster_path = path
    return table


def materialize_counted(
    df: DataFrame, label: str, counts: Mapping[str, Column]
) -> tuple[DataFrame, dict[str, int]]:
    """As ``materialize``, with aggregates of the rows, taken while they are written.

    They are observed in the tasks that write, each of which counts once even if it is run again, and
    cost no job of their own.
    """
    seen = Observation()
    table = materialize(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), label)
    return table, seen.get


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(table: DataFrame) -> None:
    """Delete a table written by ``materialize`` that no later step reads."""
    path = getattr(table, "_muster_path", None)
    if path is not None:
        _delete(table.sparkSession, path)


def discard_all(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application, once its results are written."""
    _delete(spark, session_folder(spark))
