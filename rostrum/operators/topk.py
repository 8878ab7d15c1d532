"""First pages without reading everything: postings in blocks with their largest weights, and a table of completions.

Documents are dealt to blocks of similar text length, as short texts weigh more. For every (term, field, block) the index stores the number of
postings and the largest term weight without idf. A query first reads these few rows: they give the exact document counts of its terms and, per
block, a score that no document there can pass. The blocks with the highest bounds are scored; only blocks whose bound reaches
the last score of the page so far are scored as well. Scores and page are those of the whole index.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rostrum.operators import search as S
from rostrum.operators.filters import search_filter
from rostrum.operators.joins import skip_duplicate_suggestions
from rostrum.operators.ordered import page_results
from rostrum.operators.rows import compute_once
from rostrum.session import cut_lineage, remove_scratch, save_table

CUTS = 1000  # borders of lengths that are kept on the driver
LISTED = 1000  # up to so many blocks are named in the scan's filter, more are joined
SLACK = 1 + 1e-9  # bounds and scores are rounded differently


def with_blocks(index: DataFrame, size: int = 4096, id_col: str = "id") -> DataFrame:
    """Add ``block``: documents of similar text length, about ``size`` in each."""
    length = F.size(F.array_compact(F.coalesce("t_text", F.array().cast("array<string>"))))
    blocks = max(1, -(-index.count() // size))
    cuts, parts = min(blocks, CUTS), -(-blocks // min(blocks, CUTS))
    borders = index.agg(F.percentile_approx(length, [i / cuts for i in range(1, cuts)], 10_000)).first()[0] if cuts > 1 else []
    own = F.lit(0)
    if borders:  # a binary search for the number of borders below the length, which is counted once per row
        index, steps = compute_once(index, {"_length": (length - 1).cast("double")}), sorted(set(borders))
        index = Bucketizer(splits=[-math.inf, *steps, math.inf], inputCol="_length", outputCol="_step").transform(index)
        own = F.get(F.array(F.lit(0), *[F.lit(sum(b <= s for b in borders)) for s in steps]), F.col("_step").cast("int"))
    return index.withColumn("block", own.cast("int") * parts + F.pmod(F.xxhash64(id_col), F.lit(parts)).cast("int")).drop("_length", "_step")


def write_blocks(index: DataFrame, path: str, size: int = 4096, id_col: str = "id") -> None:
    """Store an analysed index (see ``index_documents``) as ``postings``, ``blocks``, ``stats`` and ``records`` below a new folder."""
    spark, fields = index.sparkSession, S.fields_of(index)
    index.write.parquet(f"{path}/analysed")
    index = with_blocks(spark.read.parquet(f"{path}/analysed"), size, id_col)
    S.field_stats(index).write.parquet(f"{path}/stats")
    index.drop(*[f"t_{n}" for n in fields]).write.parquet(f"{path}/records")
    postings = S.build_postings(index.withColumn("_doc", F.struct("block", id_col)), "_doc").select("_doc.*", "field", "term", "tf", "positions", "dl")
    staged = save_table(postings, "postings")  # the range partitioner reads its input twice
    by_term = staged.rows.repartitionByRange("term", "block").sortWithinPartitions("term", "block", "field")
    by_term.write.parquet(f"{path}/postings")
    remove_scratch(spark, staged.path)
    average = spark.read.parquet(f"{path}/stats").select("field", (F.col("len") / F.col("n")).alias("avgdl"))  # one row per field
    weight = S._saturation(F.col("tf"), F.col("dl"), F.col("avgdl"))
    blocks = spark.read.parquet(f"{path}/postings").join(F.broadcast(average), "field").groupBy("term", "field", "block").agg(
        F.count("*").alias("n"), F.max(weight).alias("most"))
    blocks.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{path}/blocks")


def _wanted(terms: S.Terms, fields: Sequence[str]) -> Column:
    """The query's terms in the fields that they are searched in."""
    own = S._any([(F.col("field") == n) & F.col("term").isin(terms.marked(n)) for n in fields if terms.of(n)])
    return F.col("term").isin(sorted({w for n in fields for w in terms.marked(n)})) & own


def _frequencies(blocks: DataFrame, terms: S.Terms, fields: Sequence[str]) -> dict[str, list[int]]:
    """Per field the number of documents of each query term."""
    counts = {(r["field"], r["term"]): r["n"] for r in blocks.filter(_wanted(terms, fields)).groupBy("field", "term").agg(F.sum("n").alias("n")).collect()}
    return {n: [counts.get((n, t), 0) for t, _ in terms.of(n)] for n in fields}


def _idf(n: int, df: int) -> float:
    return math.log1p((n - df + 0.5) / (df + 0.5))


def block_bounds(blocks: DataFrame, stats: dict[str, tuple[int, int]], frequency: dict[str, list[int]], terms: S.Terms, fields: Sequence[str]) -> DataFrame:
    """(block, bound, n) of blocks that may hold a hit, those with every term in one field: a score that no document passes, and the postings.

    A phrase occurs no more often than its rarest term, so its weight is at most that of the term with the lowest one.
    """
    used = [n for n in fields if terms.of(n) and n in stats]

    def most(n: str, i: int) -> Column:
        return F.coalesce(F.max(F.when((F.col("field") == n) & (F.col("term") == terms.of(n)[i][0]), F.col("most"))), F.lit(0.0))

    found = blocks.filter(_wanted(terms, fields)).groupBy("block").agg(
        F.sum("n").alias("n"), *[most(n, i).alias(f"{n}_{i}") for n in used for i in range(len(terms.of(n)))])
    rows, phrases, crosses, every = [], [], [], []
    for n in used:
        own = [F.col(f"{n}_{i}") for i in range(len(terms.of(n)))]
        weights = [_idf(stats[n][0], df) for df in frequency[n]]
        there, boost = reduce(and_, [w > 0 for w in own]), S.FIELDS[n].boost
        every.append(there)
        rows.append(F.when(there, boost * S._sum([w * F.lit(x) for w, x in zip(own, weights)])).otherwise(0.0))
        phrases.append(F.when(there, boost * sum(weights) * (own[0] if len(own) == 1 else F.least(*own))).otherwise(0.0))
    for analyzer in ("folded", "standard", "keyword"):
        group = [n for n in used if S.FIELDS[n].analyzer == analyzer]
        if group:
            size = max(stats[n][0] for n in group)
            best = [S._max([S.FIELDS[n].boost * _idf(size, max(frequency[m][i] for m in group)) * F.col(f"{n}_{i}") for n in group])
                    for i in range(len(terms.of(group[0])))]
            crosses.append(S._sum(best))
    bound = S._sum(rows) + S.PHRASE_BOOST * S._max(phrases) + S.CROSS_BOOST * S._max(crosses)
    return found.filter(S._any(every)).select("block", (bound * SLACK).alias("bound"), "n")


def search_top(spark: SparkSession, path: str, q: str, size: int = 20, stop: Sequence[str] = (), id_col: str = "id", first: int = 4,
               **filters) -> tuple[DataFrame, dict[str, int]]:
    """(the first page of hits, what was read): the page of ``search_hits`` from as few blocks as the bounds allow.

    ``first`` blocks are scored at once, then those whose bound reaches the page's last score. The second value gives the blocks
    that may hold a hit, those scored, and the postings of the query's terms in both.
    """
    blocks, postings, records = (spark.read.parquet(f"{path}/{t}") for t in ("blocks", "postings", "records"))
    stats = {r["field"]: (r["n"], r["len"]) for r in spark.read.parquet(f"{path}/stats").collect()}  # one row per field
    terms = S.analyze_query(spark, q, stop)
    fields = [n for n in S.FIELDS if n in records.columns]
    frequency = _frequencies(blocks, terms, fields)
    totals = _totals(stats, frequency, fields)
    bounds = cut_lineage(block_bounds(blocks, stats, frequency, terms, fields))

    def hits(chosen: DataFrame, number: int) -> DataFrame:
        def within(rows: DataFrame) -> DataFrame:
            if number > LISTED:
                return rows.join(chosen.select("block"), "block", "left_semi")
            return rows.filter(F.col("block").isin([r["block"] for r in chosen.select("block").collect()]))  # reaches the scan

        scored = S.score_matches(S.match_postings(within(postings).filter(_wanted(terms, fields)), terms, fields, id_col), terms, totals)
        return within(records).filter(search_filter(**filters)).drop("block").join(scored, id_col)

    def size_of(rows: DataFrame) -> tuple[int, int]:
        r = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        return r[0], r[1]

    start = cut_lineage(bounds.orderBy(F.desc("bound"), "block").limit(first))
    page = cut_lineage(page_results(hits(start, first), size, 0, key=id_col))
    found, least = page.agg(F.count("*"), F.min("score")).first()
    more = bounds.join(start.select("block"), "block", "left_anti")
    if found == size:
        more = more.filter(F.col("bound") >= F.lit(least))
    more = cut_lineage(more)
    (all_blocks, all_rows), (own, rows), (others, further) = size_of(bounds), size_of(start), size_of(more)
    if others:
        page = page_results(page.union(hits(more, others).select(*page.columns)), size, 0, key=id_col)
    return page, {"blocks": all_blocks, "blocks_read": own + others, "postings": all_rows, "postings_read": rows + further}


def _totals(stats: dict[str, tuple[int, int]], frequency: dict[str, list[int]], fields: Sequence[str]) -> Column:
    """The statistics of ``term_stats`` as literals."""
    parts = []
    for n in fields:
        docs, length = stats.get(n, (0, 0))
        counts = [F.lit(v).cast("long") for v in frequency.get(n, [])]
        parts += [F.lit(docs).cast("long").alias(f"n_{n}"), F.lit(length).cast("long").alias(f"len_{n}"),
                  (F.array(*counts) if counts else F.array().cast("array<bigint>")).alias(f"df_{n}")]
    return F.struct(*parts)


# ---- completions

def write_completions(suggestions: DataFrame, path: str, n: int = 10, depth: int = 3, text: str = "input", weight: str = "weight") -> None:
    """Store ``prefixes``, the best ``n`` suggestions of each prefix of up to ``depth`` letters, and ``entries``, all of them sorted by key.

    The best of a prefix come from the best of its extensions, so each entry is ranked once, at its longest prefix, and only ``n`` rows
    per prefix go on to the next shorter one.
    """
    spark = suggestions.sparkSession
    entries = skip_duplicate_suggestions(suggestions, text, weight).select(F.col(text).alias("input"), F.col(weight).alias("weight"))
    entries = entries.withColumn("key", S.normal_prefix(F.col("input")))
    entries.repartitionByRange("key", "input").sortWithinPartitions("key").write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")
    level = None
    for length in range(depth, 0, -1):
        own = entries.filter(F.length("key") >= length if level is None else F.length("key") == length).withColumn("prefix", F.substring("key", 1, length))
        if level is not None:
            own = own.union(level.withColumn("prefix", F.substring("prefix", 1, length)))
        best = F.row_number().over(Window.partitionBy("prefix").orderBy(F.col("weight").desc(), "input"))
        ranked = own.withColumn("rank", best).filter(F.col("rank") <= n)
        ranked.repartitionByRange("prefix").sortWithinPartitions("prefix", "rank").write.parquet(f"{path}/prefixes/length={length}")
        level = spark.read.parquet(f"{path}/prefixes/length={length}").drop("rank")
    spark.createDataFrame([(n, depth)], "n int, depth int").write.parquet(f"{path}/limits")


def complete(spark: SparkSession, path: str, q: str, n: int = 5) -> DataFrame:
    """The answers of ``suggest_prefix``: a stored prefix reads its few rows, a longer one (or more answers) its range of the sorted entries."""
    prefix = spark.range(1).select(S.normal_prefix(F.lit(q))).first()[0]
    limits = spark.read.parquet(f"{path}/limits").first()
    if 0 < len(prefix) <= limits["depth"] and n <= limits["n"]:
        rows = spark.read.parquet(f"{path}/prefixes").filter((F.col("length") == len(prefix)) & (F.col("prefix") == prefix))
    else:
        rows = spark.read.parquet(f"{path}/entries").filter(F.col("key").startswith(prefix))
    return rows.select("input", "weight").orderBy(F.col("weight").desc(), "input").limit(n)
