"""Row expansion and evaluation order.

``explode`` makes the optimizer test the array for emptiness below the expansion, which evaluates a tokenizer twice;
the outer form does not. Expressions wrapped by ``compute_once`` are likewise not copied into later filters.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


def unnest(df: DataFrame, *keep: str | Column, **arrays: str | Column) -> DataFrame:
    """One row per non-null element of one array: ``unnest(df, "doc_id", tok="toks")``."""
    ((name, c),) = arrays.items()
    return df.select(*keep, F.explode_outer(c).alias(name)).filter(F.col(name).isNotNull())


def compute_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns whose expressions are evaluated once per row, whatever is filtered or derived from them later."""
    wrapped = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    if not columns:
        return df
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.explode_outer(wrapped).alias("_once")).select(*kept, "_once.*")


def group_in_row(df: DataFrame, items: Column, key: Callable[[Column], Column], entry: Callable[[Column, Column], Column],
                 out: str) -> DataFrame:
    """Group the items of an array inside its row, without a shuffle.

    The items are sorted and cut where the key changes; ``entry(first item, items of the run)`` gives one element of the
    array ``out`` per run.
    """
    df = compute_once(df, {"_s": F.sort_array(items)})
    borders = F.transform("_s", lambda x, i: F.when(~key(x).eqNullSafe(key(F.get("_s", i - 1))), i))
    df = compute_once(df, {"_b": F.filter(borders, lambda i: i.isNotNull())})
    runs = F.transform("_b", lambda b, j: entry(
        F.get("_s", b), F.slice("_s", b + 1, F.coalesce(F.get("_b", j + 1), F.size("_s")) - b)))
    return df.withColumn(out, runs).drop("_s", "_b")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread rows over all cores when the input has fewer splits than cores (few or small files); else no shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
