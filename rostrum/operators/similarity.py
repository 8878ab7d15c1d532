"""TF-IDF weights and explicit semantic analysis (documents against concept pages)."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from rostrum.session import cut_lineage

# Concept weights that are broadcast at once: about 60 MB per million rows in memory.
BROADCAST_ROWS = 2_000_000


def alpha_tokens(text: Column, stop: Sequence[str] = ()) -> Column:
    """Lower-case words of letters only, without stop words; a word with a digit is left out as a whole."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"(?<![\p{L}\p{N}])\p{L}+(?![\p{L}\p{N}])"), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(list(stop))) if stop else found


def tfidf(bag: DataFrame, docs: DataFrame, doc: str = "doc_id", term: str = "term", tf: str = "tf", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """tf·log2(N/df), each document scaled to length one → (doc, term, tf, idf, w). Terms of every document drop out.

    ``docs`` has one row per document, also per empty one. The term weights are written once and counted: up to
    ``max_rows`` they are broadcast, so that a bag partitioned by document is not shuffled again; more are joined by term.
    """
    n = docs.agg(F.count("*").alias("n")).scalar()
    df = bag.groupBy(term).agg(F.count("*").alias("_df"))
    idf = cut_lineage(df.select(term, F.log2(n / F.col("_df")).alias("idf")).filter("idf > 0"))
    small = idf.count() <= max_rows
    raw = bag.join(F.broadcast(idf) if small else idf, term).withColumn("_w", F.col(tf) * F.col("idf"))
    return raw.withColumn("w", _unit("_w", doc)).drop("_w")


def _unit(weight: str, doc: str) -> Column:
    """Weight over the length of its document; a window holds the distinct words of one document."""
    return F.col(weight) / F.sqrt(F.sum(F.col(weight) * F.col(weight)).over(Window.partitionBy(doc)))


def esa_top_concepts(docs: DataFrame, concepts: DataFrame, k: int = 10, doc: str = "doc_id", concept: str = "item_id",
                     term: str = "term", max_rows: int = 1_000_000) -> DataFrame:
    """The ``k`` most similar concepts of each document by cosine → (doc, concept, score, rank).

    ``docs`` holds (doc, term, tf) and ``concepts`` the output of ``tfidf``. Ids are not null. Both are written once and counted. Documents are hashed into groups
    and concepts into blocks of about ``max_rows`` weights each; every group meets every block in one tile, which adds up the products in
    memory and returns ``k`` rows per document only. The best of all tiles are the exact result. The products themselves are never shuffled.
    """
    model = cut_lineage(concepts.select(concept, term, "idf", F.col("w").alias("_cw")))
    idf = model.select(term, "idf").distinct()
    vectors = docs.join(idf, term).withColumn("_w", F.col("tf") * F.col("idf")).withColumn("_dw", _unit("_w", doc))
    vectors = cut_lineage(vectors.select(doc, term, "_dw"))
    groups, blocks = (max(1, math.ceil(side.count() / max_rows)) for side in (vectors, model))

    def part(key: str, n: int) -> Column:
        return F.pmod(F.hash(key), F.lit(n))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = vectors.withColumn("_g", part(doc, groups)).withColumn("_b", every(blocks))
    right = model.select(concept, term, "_cw").withColumn("_b", part(concept, blocks)).withColumn("_g", every(groups))

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        return _tile(x, y, k, doc, concept, term)

    types = dict(docs.dtypes) | dict(concepts.dtypes)
    schema = f"`{doc}` {types[doc]}, `{concept}` {types[concept]}, score double"
    return _top(left.groupBy("_g", "_b").cogroup(right.groupBy("_g", "_b")).applyInPandas(run, schema), k, doc, concept)


def _tile(x: pd.DataFrame, y: pd.DataFrame, k: int, doc: str, concept: str, term: str, pairs: int = 500_000) -> pd.DataFrame:
    """The ``k`` best concepts of each document of a tile; about ``pairs`` products are held at once."""
    terms = pd.Index(y[term].unique())
    y = y.assign(_t=terms.get_indexer(y[term])).sort_values("_t")
    x = x.assign(_t=terms.get_indexer(x[term])).query("_t >= 0").sort_values(doc)
    if x.empty or y.empty:
        return pd.DataFrame({doc: x[doc][:0], concept: y[concept][:0], "score": np.zeros(0)})
    d, docs = pd.factorize(x[doc])
    c, concepts = pd.factorize(y[concept], sort=True)
    per_term = np.bincount(y["_t"], minlength=len(terms))
    first = np.cumsum(per_term) - per_term
    t, dw, cw = x["_t"].to_numpy(), x["_dw"].to_numpy(), y["_cw"].to_numpy()
    n = per_term[t]
    begins = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])  # a document stays in one piece; its products are at most the rows of ``y``
    piece = (np.cumsum(n) - n)[begins] // pairs
    cuts = begins[np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])]
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(d)]):
        row = np.repeat(np.arange(a, b), n[a:b])
        before = np.cumsum(n[a:b]) - n[a:b]
        place = np.arange(len(row)) - before[row - a] + first[t[row]]
        pair, at = np.unique(d[row] * len(concepts) + c[place], return_inverse=True)
        score = np.bincount(at, dw[row] * cw[place])
        of, with_ = np.divmod(pair, len(concepts))
        order = np.lexsort((with_, -np.round(score, 9), of))
        of, with_, score = of[order], with_[order], score[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        keep = rank < k
        out.append(pd.DataFrame({doc: docs[of[keep]], concept: concepts[with_[keep]], "score": score[keep]}))
    return pd.concat(out)


def _top(sums: DataFrame, k: int, doc: str, concept: str) -> DataFrame:
    # Sums in a different order differ in the last digits; they must not decide a tie.
    rn = F.row_number().over(Window.partitionBy(doc).orderBy(F.round("score", 9).desc(), concept))
    return sums.withColumn("rank", rn).filter(F.col("rank") <= k)
