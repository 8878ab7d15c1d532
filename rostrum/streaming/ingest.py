"""Keep the speech table current as new files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rostrum.operators.joins import anti_join_indexed, rank_one

BATCH = "batch_id"


def stream_ingest(spark: SparkSession, src: str, target: str, checkpoint: str, schema: str, id_col: str = "id",
                  seq: str = "seq", files_per_trigger: int = 1000) -> StreamingQuery:
    """Read new JSON files once and append their latest version per id to the versioned table.

    Each micro-batch writes a folder of its own and a repeated batch overwrites it, so a restart after a lost executor
    or driver neither loses nor doubles records. Nothing already written is rewritten.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        latest = rank_one(batch, id_col, F.col(seq).desc())
        latest.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")

    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(src)
            .writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def current(spark: SparkSession, target: str, id_col: str = "id", seq: str = "seq") -> DataFrame:
    """The latest version of each record over all batches; a later batch wins among equal versions."""
    rows = spark.read.parquet(target)
    return rank_one(rows, id_col, F.col(seq).desc(), F.col(BATCH).desc()).drop(BATCH)


def new_sittings(spark: SparkSession, crawl: DataFrame, target: str, term: int | str) -> DataFrame:
    """Sittings of a crawl list that the table does not hold yet."""
    return anti_join_indexed(crawl, current(spark, target).select("term", "sitting_nr"), term)


def compact(spark: SparkSession, target: str, compacted: str, id_col: str = "id", seq: str = "seq") -> None:
    """Write the current versions as the first batch of a new table."""
    current(spark, target, id_col, seq).write.parquet(f"{compacted}/{BATCH}=-1")
