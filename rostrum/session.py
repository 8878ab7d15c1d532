"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time; force it even where a split costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Large expressions are built faster without a stack trace per call.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Shuffle files of a written table go with its write.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app: str = "rostrum", **conf: str) -> SparkSession:
    """Session with the engine's defaults; master and sizes come from the submit command or ``conf``."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Without it, a directory given by ``SparkContext.setCheckpointDir`` is used. A temporary folder is made for a local master only; on a
    cluster each machine would have its own, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if re.match(r"local(\[|$)", spark.sparkContext.master) is None:
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="rostrum-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """New, unused path below the shared folder."""
    return f"{shared_root(spark)}/rostrum/{label}-{uuid.uuid4().hex}"


class Saved(NamedTuple):
    rows: DataFrame
    path: str


def save_table(df: DataFrame, label: str, *by: str) -> Saved:
    """Write a table; the shuffle files of the write go with its end and not with the driver's next collection of garbage."""
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return Saved(spark.read.schema(df.schema).parquet(path), path)


def remove_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and stops recomputation upstream."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint()
