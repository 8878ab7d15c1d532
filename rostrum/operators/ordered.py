"""Order-dependent operators on the speeches of a sitting.

A sitting may hold a large share of all rows, so no window sees a whole one. Rows are windowed in blocks of
consecutive positions, and only one summary row per block takes part in the window over the sitting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 65_536


def _blocked(df: DataFrame, idx: str, block: int) -> DataFrame:
    return df.withColumn("_blk", F.expr(f"`{idx}` div {block}"))


def speech_index(df: DataFrame, sitting: str = "sitting_uid", order: str = "turn", out: str = "idx", block: int = BLOCK) -> DataFrame:
    """1-based position of a speech in its sitting."""
    rows = _blocked(df, order, block)
    sizes = rows.groupBy(sitting, "_blk").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(sitting).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(sitting, "_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy(sitting, "_blk").orderBy(order))
    return rows.join(offsets, [sitting, "_blk"]).withColumn(out, inside + F.col("_off")).drop("_blk", "_off")


def carry_header(df: DataFrame, sitting: str = "sitting_uid", order: str = "idx", header: str = "header") -> DataFrame:
    """The first header found in a sitting is given to all its speeches."""
    found = df.groupBy(sitting).agg(F.min_by(header, F.when(F.col(header).isNotNull(), F.col(order))).alias("_h"))
    found = found.filter("_h is not null")
    return df.join(found, sitting, "left").withColumn(header, F.col("_h")).drop("_h")


def carry_topic_forward(df: DataFrame, sitting: str = "sitting_uid", order: str = "idx", topic: str = "topic",
                        url: str | None = None, out: str = "topic", out_url: str = "bill_url", block: int = BLOCK) -> DataFrame:
    """A topic announced at one speech holds for the following ones, until the next announcement.

    Title and address travel together: an announcement without address resets it to the empty string. Before the
    first announcement both are empty.
    """
    address = F.coalesce(F.col(url), F.lit("")) if url else F.lit("")
    rows = _blocked(df, order, block).withColumn(
        "_t", F.when(F.col(topic).isNotNull(), F.struct(F.col(topic).alias("topic"), address.alias("url"))))
    blocks = rows.groupBy(sitting, "_blk").agg(F.max_by("_t", F.when(F.col("_t").isNotNull(), F.col(order))).alias("_last"))
    earlier = Window.partitionBy(sitting).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(sitting, "_blk", F.last("_last", True).over(earlier).alias("_c"))
    inside = Window.partitionBy(sitting, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(carried, [sitting, "_blk"]).withColumn("_v", F.coalesce(F.last("_t", True).over(inside), "_c"))
    joined = joined.withColumn(out, F.coalesce(F.col("_v.topic"), F.lit("")))
    if url:
        joined = joined.withColumn(out_url, F.coalesce(F.col("_v.url"), F.lit("")))
    return joined.drop("_blk", "_t", "_c", "_v")


def prev_next_speech(df: DataFrame, sitting: str = "sitting_uid", order: str = "idx", value: str = "url",
                     prev: str = "prev_speech_url", next_: str = "next_speech_url", block: int = BLOCK) -> DataFrame:
    """Neighbouring speeches of each speech."""
    rows = _blocked(df, order, block)
    ends = rows.groupBy(sitting, "_blk").agg(F.min_by(F.struct(value), order).alias("_first"), F.max_by(F.struct(value), order).alias("_last"))
    over = Window.partitionBy(sitting).orderBy("_blk")
    ends = ends.select(sitting, "_blk", F.lag("_last").over(over).alias("_p"), F.lead("_first").over(over).alias("_n"))
    w = Window.partitionBy(sitting, "_blk").orderBy(order)
    held = F.struct(value)
    return (rows.join(ends, [sitting, "_blk"])
            .withColumn(prev, F.coalesce(F.lag(held).over(w), "_p")[value])
            .withColumn(next_, F.coalesce(F.lead(held).over(w), "_n")[value])
            .drop("_blk", "_p", "_n"))


def top_topics_per_doc(d: DataFrame, n: int = 3, doc: str = "doc_id", topic: str = "topic", prob: str = "prob") -> DataFrame:
    """The ``n`` likeliest topics of each document, with their rank."""
    rn = F.row_number().over(Window.partitionBy(doc).orderBy(F.col(prob).desc(), topic))
    return d.withColumn("rank", rn).filter(F.col("rank") <= n)


def dominant_topic(d: DataFrame, threshold: float = 0.81, doc: str = "doc_id", topic: str = "topic", prob: str = "prob") -> DataFrame:
    """The likeliest topic of each document, if it is likely enough."""
    best = d.groupBy(doc).agg(F.max_by(topic, F.struct(F.col(prob), -F.col(topic))).alias(topic), F.max(prob).alias(prob))
    return best.filter(F.col(prob) > threshold)


def page_results(df: DataFrame, size: int = 20, from_: int = 0, score: str = "score", key: str = "id") -> DataFrame:
    """One page of a ranked result."""
    return df.orderBy(F.col(score).desc(), key).offset(from_).limit(size)


def sort_by_freq(df: DataFrame, freq: str = "freq", key: str = "uri") -> DataFrame:
    return df.orderBy(F.col(freq).desc(), key)


def limit_records(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` records, in a stated order if one is given."""
    return (df.orderBy(*order) if order else df).limit(n)
