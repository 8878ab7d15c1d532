"""From raw documents to packed sequences: toxic and poor documents go, one document of every group of near copies stays, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read back as the next stage's input. All but
the last return the columns of their input. Of rows that repeat an id the first text stays in the third stage, of rows without one those that no other row is linked with.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rostrum.llm import importance, jaccard, packing, toxicity
from rostrum.llm.fixed import saved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the model takes for toxic go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, "doc_id", "text", F.struct(*docs.columns).alias("row"))
    return scored.filter("predicted = 0").select("row.*")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents outside the sample weighted by quality go."""
    return importance.importance_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), whole_rows=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1 with five words and 80 %: of each group of linked documents the one with the smallest id stays.

    A row without an id gets a number from its text above all ids, so that it stays only where no row with an id is linked with it.
    """
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61)))
    rows = docs.select(number.alias("number"), "text", F.struct(*docs.columns).alias("row"))
    linked = jaccard.jaccard_components(rows.select("number", "text"), "number", size=5, percent=80)
    kept = saved(linked.filter("doc_id = component_id").select(F.col("doc_id").alias("number")).distinct(), "kept")
    first = Window.partitionBy("number").orderBy(F.col("text").asc_nulls_last())
    return rows.join(kept, "number", "left_semi").withColumn("nth", F.row_number().over(first)).filter("nth = 1").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the pieces of all documents that are left."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("quality classifier", drop_poor), ("n-gram Jaccard join", drop_near_copies), ("packing", pack)]

ORACLE_SQL = None  # the models and the tokenizer are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
