"""Faceted full-text search with ranking.

Two ways give the same scores. ``search`` reads analysed documents: the positions of the few query terms are found
inside each row, so ranking needs no join and no shuffle, only one global aggregate for the term statistics.
``build_postings`` writes an inverted index sorted by term; ``match_postings`` then reads only the query's terms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add, or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rostrum.functions.text import ascii_fold, fix_accents, lc_norm, words
from rostrum.operators import aggregates as A
from rostrum.operators.filters import search_filter
from rostrum.operators.joins import skip_duplicate_suggestions
from rostrum.operators.ordered import page_results
from rostrum.operators.rows import compute_once, unnest
from rostrum.session import cut_lineage, remove_scratch, save_table


@dataclass(frozen=True)
class Field:
    boost: float
    analyzer: str  # "folded": stop words, accents folded; "standard": lower case only; "keyword": the whole value


# Searched fields with their weights.
FIELDS = {
    "text": Field(10.0, "folded"), "speaker": Field(20.0, "standard"), "speaker_party": Field(15.0, "keyword"),
    "topic": Field(5.0, "folded"), "bill_title": Field(5.0, "folded"), "committee": Field(5.0, "folded"),
}
FACETS = {"speakers": "speaker_filter", "parties": "speaker_party_filter", "bills": "bill_title_filter",
          "topics": "topic_filter", "types": "type_filter"}
PHRASE_BOOST, CROSS_BOOST = 2.0, 0.1
BROADCAST_HITS = 2_000_000
K1, B = 1.2, 0.75  # published BM25 defaults
BITS = 63  # of a number that holds a sort key


# ---- analysis

def analyze_text(df: DataFrame, columns: Mapping[str, Column], stop: Sequence[str] = ()) -> DataFrame:
    """Add word arrays in lower case with accents folded; stop words become NULL so that positions stay true.

    Folding maps letters to letters, hence the folded text has the same word borders and both can be zipped; a text
    without accents is split only once. Each step is computed once per row.
    """
    df = compute_once(df, {f"_p_{n}": F.lower(fix_accents(c)) for n, c in columns.items()})
    df = compute_once(df, {f"_f_{n}": ascii_fold(f"_p_{n}") for n in columns})

    def toks(n: str) -> Column:
        if not stop:
            return words(f"_f_{n}")
        same = F.transform(words(f"_p_{n}"), lambda t: F.when(~t.isin(list(stop)), t))
        both = F.zip_with(words(f"_p_{n}"), words(f"_f_{n}"), lambda t, f: F.when(~t.isin(list(stop)), f))
        return F.when(F.col(f"_p_{n}") == F.col(f"_f_{n}"), same).otherwise(both)

    return compute_once(df, {n: toks(n) for n in columns}).drop(*[f"_{s}_{n}" for n in columns for s in "pf"])


def _analyze(df: DataFrame, columns: Mapping[str, tuple[Column, str]], stop: Sequence[str]) -> DataFrame:
    """Word arrays by analyzer: name → (text, analyzer)."""
    df = df.withColumns({n: words(F.lower(c)) if a == "standard" else F.when(c.isNotNull(), F.array(lc_norm(c)))
                         for n, (c, a) in columns.items() if a != "folded"})
    return analyze_text(df, {n: c for n, (c, a) in columns.items() if a == "folded"}, stop)


def hungarian_stop_words(spark: SparkSession) -> list[str]:
    """The public Hungarian stop list that comes with Spark."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("hungarian")


def analyze_tokens(tokens: DataFrame, stop: DataFrame, lemmas: DataFrame, protected: DataFrame, token: str = "tok") -> DataFrame:
    """The analysis as joins, for dictionaries of any size: stop → protect → lemma → lower case → fold."""
    from rostrum.operators.annotate import lemmatize_lookup
    from rostrum.operators.joins import anti_join_stopwords

    kept = anti_join_stopwords(tokens.withColumn(token, fix_accents(token)), stop, token)
    out = lemmatize_lookup(kept, lemmas, protected, token)
    return out.withColumn("term", ascii_fold(F.lower("lemma"))).drop("lemma")


def index_documents(docs: DataFrame, stop: Sequence[str] = ()) -> DataFrame:
    """Add the analysed words of each search field as ``t_<field>``; store the result to analyse only once.

    The items of a list field follow each other.
    """
    def column(name: str) -> Column:
        return F.array_join(name, " ") if dict(docs.dtypes)[name] == "array<string>" else F.col(name)

    return _analyze(docs, {f"t_{n}": (column(n), f.analyzer) for n, f in FIELDS.items() if n in docs.columns}, stop)


# ---- query terms and matches

@dataclass(frozen=True)
class Terms:
    """Analysed query: per analyzer the terms with their positions; ``forms`` has the written forms of stemmed terms."""
    folded: tuple[tuple[str, int], ...]
    standard: tuple[tuple[str, int], ...]
    keyword: tuple[tuple[str, int], ...]
    forms: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def of(self, name: str) -> tuple[tuple[str, int], ...]:
        return getattr(self, FIELDS[name].analyzer)

    def spellings(self, name: str) -> list[tuple[str, ...]]:
        """The words of a field that count as each term."""
        stemmed = FIELDS[name].analyzer == "folded"
        return [self.forms.get(t, (t,)) if stemmed else (t,) for t, _ in self.of(name)]

    def marked(self, name: str) -> list[str]:
        return sorted({w for words in self.spellings(name) for w in words})


def stem_table(lemmas: DataFrame, protected: DataFrame | None = None, surface: str = "surface", lemma: str = "lemma", word: str = "word") -> DataFrame:
    """Dictionary for searches → (form, stem), folded; of several lemmas the longest counts, protected words have none.

    Forms that differ in accents only share an entry. Store it for repeated searches.
    """
    def folded(c: str) -> Column:
        return ascii_fold(lc_norm(c))

    best = lemmas.groupBy(folded(surface).alias("form")).agg(F.max_by(folded(lemma), F.struct(F.length(lemma), lemma)).alias("stem"))
    return best if protected is None else best.join(protected.select(folded(word).alias("form")).distinct(), "form", "left_anti")


def _forms(stems: DataFrame, words: Sequence[str]) -> tuple[dict[str, str], dict[str, tuple[str, ...]]]:
    """(word → stem, stem → all its forms) for the few words of a query."""
    own = dict(stems.filter(F.col("form").isin(list(words))).select("form", "stem").collect())
    wanted = sorted({own.get(w, w) for w in words})
    rows = stems.filter(F.col("stem").isin(wanted) | F.col("form").isin(wanted)).select("form", "stem").collect()
    entry = dict(rows)
    return own, {t: tuple(sorted({f for f, stem in rows if stem == t} | ({t} if entry.get(t, t) == t else set()))) for t in wanted}


def analyze_query(spark: SparkSession, q: str, stop: Sequence[str] = (), stems: DataFrame | None = None) -> Terms:
    """The query goes through the same expressions as the documents (one literal row, no job on data).

    With ``stems`` (see ``stem_table``) each folded term becomes its stem and matches every form of it. This gives the scores of an index
    of stems, but the index keeps the written words: a changed dictionary needs no new analysis.
    """
    kinds = ("folded", "standard", "keyword")
    row = _analyze(spark.range(1), {a: (F.lit(q), a) for a in kinds}, stop).first()
    folded, standard, keyword = [tuple((t, i) for i, t in enumerate(row[a]) if t is not None) for a in kinds]
    if stems is None or not folded:
        return Terms(folded, standard, keyword)
    own, forms = _forms(stems, [t for t, _ in folded])
    return Terms(tuple((own.get(t, t), i) for t, i in folded), standard, keyword, forms)


def _positions(toks: Column, spellings: Sequence[Sequence[str]]) -> Column:
    """Positions of each term, in any of its spellings, in a word array."""
    none = F.array().cast("array<int>")

    def places(same: Callable[[Column], Column]) -> Column:
        return F.filter(F.transform(toks, lambda t, i: F.when(same(t), i)), lambda i: i.isNotNull())

    if not spellings:
        return F.array().cast("array<array<int>>")
    if all(len(words) == 1 for words in spellings):
        return F.transform(_literals([w for w, in spellings]),
                           lambda term: F.when(F.array_contains(toks, term), places(lambda t: t == term)).otherwise(none))
    return F.array(*[F.when(F.arrays_overlap(toks, _literals(words)), places(lambda t, words=words: t.isin(list(words)))).otherwise(none)
                     for words in spellings])


def _literals(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def fields_of(df: DataFrame) -> list[str]:
    return [n for n in FIELDS if f"t_{n}" in df.columns or f"p_{n}" in df.columns]


def match_documents(index: DataFrame, terms: Terms) -> DataFrame:
    """Replace ``t_<field>`` by ``p_<field>`` (positions of each query term) and ``n_<field>`` (field length)."""
    new = {}
    for n in fields_of(index):
        toks = F.coalesce(F.col(f"t_{n}"), F.array().cast("array<string>"))
        new[f"p_{n}"] = _positions(toks, terms.spellings(n))
        new[f"n_{n}"] = F.size(F.array_compact(toks))
    return compute_once(index, new).drop(*[f"t_{n}" for n in fields_of(index)])


def build_postings(index: DataFrame, id_col: str = "id") -> DataFrame:
    """Inverted index (id, field, dl, term, tf, positions). Words are grouped many documents at a time, unshuffled, and come sorted, which a later sort uses."""
    fields, kind = fields_of(index), index.schema[id_col].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for b in batches for p in A.pieces(b, *fields)):
            for n in fields:
                found = _posted(piece.column("id"), piece.column(n))
                yield pa.RecordBatch.from_arrays([found[0], pa.array([n] * len(found[0]), pa.string()), *found[1:]], names=[id_col, "field", "dl", "term", "tf", "positions"])

    rows = index.select(F.col(id_col).alias("id"), *[F.col(f"t_{n}").alias(n) for n in fields])
    return rows.mapInArrow(build, f"`{id_col}` {kind}, field string, dl int, term string, tf int, positions array<int>")


def _posted(ids: pa.Array, lists: pa.ListArray) -> list[pa.Array]:
    """(id, dl, term, tf, positions) of the words of each row, sorted by term and id; null words have a position only."""
    row, code, words = A.coded(lists)
    sizes, some, rows, spare = A.list_sizes(lists), np.flatnonzero(code >= 0), max(1, len(lists)), int(len(row)).bit_length()
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    dl, ranked = np.bincount(row[some], minlength=len(lists)), pc.sort_indices(words).to_numpy()
    by_id = pc.sort_indices(ids).to_numpy() if pa.types.is_integer(ids.type) or pa.types.is_string(ids.type) else np.arange(len(ids))
    place, nth = np.empty(len(words), np.int64), np.empty(len(ids), np.int64)
    place[ranked], nth[by_id] = np.arange(len(words)), np.arange(len(ids))
    key = place[code[some]] * rows + nth[row[some]]
    if len(words) * rows << spare < 1 << BITS:  # the key and the place of a word in one number
        both = np.sort(key << spare | some)
        key, some = both >> spare, both & ((1 << spare) - 1)
    else:
        order = np.argsort(key, kind="stable")
        key, some = key[order], some[order]
    firsts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
    own, ends = by_id[key[firsts] % rows], np.append(firsts, len(key))
    positions = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at[some], pa.int32()))
    term = words.take(pa.array(ranked[key[firsts] // rows]))
    return [ids.take(pa.array(own)), pa.array(dl[own], pa.int32()), term, pa.array(np.diff(ends), pa.int32()), positions]


def write_postings(postings: DataFrame, path: str, id_col: str = "id", partitions: int | None = None, mode: str = "error") -> None:
    """Store clustered by term, so that a term is found by row-group statistics; frequent terms span several files."""
    by, staged = ["term", id_col], save_table(postings, "postings")  # the range partitioner reads its input twice
    ranged = staged.rows.repartitionByRange(partitions, *by) if partitions else staged.rows.repartitionByRange(*by)
    ranged.sortWithinPartitions("term", "field", id_col).write.mode(mode).parquet(path)
    remove_scratch(postings.sparkSession, staged.path)


def refresh_postings(postings: DataFrame, changed: DataFrame, id_col: str = "id") -> DataFrame:
    """Postings after some documents changed: only those documents are analysed again (``changed`` is their index)."""
    return postings.join(changed.select(id_col), id_col, "left_anti").unionByName(build_postings(changed, id_col))


def field_stats(index: DataFrame) -> DataFrame:
    """Documents with words and total length per field, for scoring from postings."""
    lists = F.array(*[F.struct(F.lit(n).alias("field"), F.size(F.array_compact(f"t_{n}")).alias("dl")) for n in fields_of(index)])
    rows = unnest(index, f=lists).filter("f.dl > 0")
    return rows.groupBy("f.field").agg(F.count("*").alias("n"), F.sum("f.dl").alias("len"))


def match_postings(postings: DataFrame, terms: Terms, fields: Sequence[str], id_col: str = "id") -> DataFrame:
    """The same columns as ``match_documents``, from the postings of the query's terms only."""
    wanted = _any([(F.col("field") == n) & F.col("term").isin(terms.marked(n)) for n in fields if terms.of(n)])
    hits = postings.filter(F.col("term").isin(sorted({w for n in fields for w in terms.marked(n)})) & wanted)
    aggs = []
    for n in fields:
        here = [F.flatten(F.collect_list(F.when((F.col("field") == n) & F.col("term").isin(list(words)), F.col("positions"))))
                for words in terms.spellings(n)]
        aggs.append((F.array(*here) if here else F.array().cast("array<array<int>>")).alias(f"p_{n}"))
        aggs.append(F.coalesce(F.max(F.when(F.col("field") == n, F.col("dl"))), F.lit(0)).alias(f"n_{n}"))
    return hits.groupBy(id_col).agg(*aggs)


# ---- statistics and scores

def term_stats(matches: DataFrame, terms: Terms) -> Column:
    """Scalar subquery struct(n_<field>, len_<field>, df_<field>[term]) over all documents."""
    parts = []
    for n in fields_of(matches):
        parts += [F.sum((F.col(f"n_{n}") > 0).cast("long")).alias(f"n_{n}"), F.sum(f"n_{n}").alias(f"len_{n}"),
                  _df(n, terms).alias(f"df_{n}")]
    return matches.agg(F.struct(*parts).alias("s")).scalar()


def _df(n: str, terms: Terms) -> Column:
    counts = [F.sum((F.size(F.col(f"p_{n}")[i]) > 0).cast("long")) for i in range(len(terms.of(n)))]
    return F.array(*counts) if counts else F.array().cast("array<bigint>")


def postings_stats(matches: DataFrame, terms: Terms, stats: DataFrame) -> Column:
    """The same struct from postings matches and stored ``field_stats``."""
    fields = fields_of(matches)
    sizes = stats.agg(*[F.max(F.when(F.col("field") == n, F.col(c))).alias(f"{c}_{n}") for n in fields for c in ("n", "len")])
    whole = sizes.select(F.struct("*").alias("s")).scalar()
    dfs = matches.agg(F.struct(*[_df(n, terms).alias(f"df_{n}") for n in fields]).alias("s")).scalar()
    return F.struct(*[whole[f"{c}_{n}"].alias(f"{c}_{n}") for n in fields for c in ("n", "len")],
                    *[dfs[f"df_{n}"].alias(f"df_{n}") for n in fields])


def idf(n: Column, df: Column) -> Column:
    return F.log1p((n - df + 0.5) / (df + 0.5))


def _saturation(tf: Column, dl: Column, avgdl: Column) -> Column:
    return (K1 + 1) * tf / (tf + K1 * (1 - B + B * dl / avgdl))


def bm25(tf: Column, dl: Column, avgdl: Column, n: Column, df: Column) -> Column:
    """Term weight; zero where the term is absent."""
    return F.when(tf > 0, idf(n, df) * _saturation(tf, dl, avgdl)).otherwise(0.0)


def _sum(parts: list[Column]) -> Column:
    return reduce(add, parts, F.lit(0.0))


def _any(conds: list[Column]) -> Column:
    return reduce(or_, conds, F.lit(False))


def _max(parts: list[Column]) -> Column:
    return parts[0] if len(parts) == 1 else F.greatest(*parts) if parts else F.lit(0.0)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _norm(n: str, st: str) -> tuple[Column, Column, Column]:
    """(field length, average field length, documents with the field)."""
    docs = F.col(st)[f"n_{n}"]
    return F.col(f"n_{n}"), F.col(st)[f"len_{n}"] / docs, docs


def _weights(n: str, st: str) -> Column:
    """Weight of each query term in a field."""
    return F.zip_with(f"p_{n}", F.col(st)[f"df_{n}"], lambda p, df: bm25(F.size(p), *_norm(n, st), df))


def match_all_terms(matches: DataFrame, terms: Terms, st: str = "_st") -> tuple[Column, Column]:
    """(condition, score): every term in one field; the scores of all such fields add up."""
    used = [n for n in fields_of(matches) if terms.of(n)]
    conds = [F.forall(f"p_{n}", lambda p: F.size(p) > 0) for n in used]
    return _any(conds), _sum([F.when(c, FIELDS[n].boost * _total(_weights(n, st))).otherwise(0.0) for n, c in zip(used, conds)])


def phrase_count(n: str, terms: Terms) -> Column:
    """How often the terms stand at their query distances in a field."""
    (_, first), *rest = terms.of(n)
    starts = F.col(f"p_{n}")[0]  # positions in a field are distinct
    for i, (_, offset) in enumerate(rest, 1):
        gap = F.lit(offset - first)
        starts = F.array_intersect(starts, F.transform(F.col(f"p_{n}")[i], lambda p: p - gap))
    return F.size(starts)


def match_phrase(matches: DataFrame, terms: Terms, st: str = "_st") -> tuple[Column, Column]:
    """(condition, score): the terms in a row; the best field counts."""
    conds, scores = [], []
    for n in [n for n in fields_of(matches) if terms.of(n)]:
        pf = phrase_count(n, terms)
        dl, avgdl, docs = _norm(n, st)
        weight = _total(F.transform(F.col(st)[f"df_{n}"], lambda df: idf(docs, df)))
        conds.append(pf > 0)
        scores.append(F.when(pf > 0, FIELDS[n].boost * weight * _saturation(pf, dl, avgdl)).otherwise(0.0))
    return _any(conds), _max(scores)


def match_cross_fields(matches: DataFrame, terms: Terms, st: str = "_st") -> tuple[Column, Column]:
    """(condition, score): every term in some field of the same analysis; the best group counts.

    Within a group a term weighs as in its best field, with the highest document counts of the group.
    """
    conds, scores = [], []
    for analyzer in ("folded", "standard", "keyword"):
        group = [n for n in fields_of(matches) if FIELDS[n].analyzer == analyzer and terms.of(n)]
        if not group:
            continue
        docs = _max([F.coalesce(F.col(st)[f"n_{n}"], F.lit(0)) for n in group])

        def best(i: Column) -> Column:
            df = _max([F.col(st)[f"df_{n}"][i] for n in group])
            return _max([FIELDS[n].boost * bm25(F.size(F.col(f"p_{n}")[i]), *_norm(n, st)[:2], docs, df) for n in group])

        weights = F.transform(F.array(*[F.lit(i) for i in range(len(terms.of(group[0])))]), best)
        every = F.forall(weights, lambda w: w > 0)
        conds.append(every)
        scores.append(F.when(every, _total(weights)).otherwise(0.0))
    return _any(conds), _max(scores)


def score_matches(matches: DataFrame, terms: Terms, stats: Column) -> DataFrame:
    """Matching documents with their relevance: all terms in a field, plus phrase and cross-field bonus."""
    rows = matches.withColumn("_st", stats)
    cond, must = match_all_terms(rows, terms)
    _, phrase = match_phrase(rows, terms)
    _, cross = match_cross_fields(rows, terms)
    fields = fields_of(matches)
    hits = rows.filter(cond).withColumn("score", must + PHRASE_BOOST * phrase + CROSS_BOOST * cross)
    return hits.drop("_st", *[f"p_{n}" for n in fields], *[f"n_{n}" for n in fields])


def bm25_score(index: DataFrame, field: str, q: str, stop: Sequence[str] = ()) -> DataFrame:
    """Relevance of one field for any of the terms."""
    terms = analyze_query(index.sparkSession, q, stop)
    matches = match_documents(index, terms)
    rows = matches.withColumn("_st", term_stats(matches, terms))
    return rows.withColumn("score", _total(_weights(field, "_st"))).filter("score > 0").drop("_st", *[f"{c}_{n}" for n in fields_of(index) for c in ("p", "n")])


# ---- results

SENTENCE_END = r"(?<=[.!?])\s+|\n+"


def highlight(c: Column, terms: Sequence[str], fragments: int = 3, analyzer: str = "folded") -> Column:
    """The first sentences with a query term, whole, terms in ``<em>`` tags; empty without any."""
    if not terms:
        return F.array().cast("array<string>")

    def norm(piece: Column) -> Column:
        return ascii_fold(F.lower(fix_accents(piece))) if analyzer == "folded" else F.lower(piece)

    def mark(sentence: Column) -> Column:
        pieces = F.regexp_extract_all(sentence, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
        return F.array_join(F.transform(pieces, lambda p: F.when(
            norm(p).isin(list(terms)), F.concat(F.lit("<em>"), p, F.lit("</em>"))).otherwise(p)), "")

    def hit(sentence: Column) -> Column:
        return F.arrays_overlap(words(norm(sentence)), _literals(terms))

    sentences = F.filter(F.split(F.coalesce(c, F.lit("")), SENTENCE_END), hit)
    return F.transform(F.slice(sentences, 1, fragments), mark)


def keyword_field_match(q: str, column: str) -> Column:
    """A keyword field matches the whole query, apart from case and old accents."""
    return lc_norm(F.lit(q)) == lc_norm(column)


def search_hits(index: DataFrame, q: str | Terms, stop: Sequence[str] = (), stems: DataFrame | None = None, **filters) -> DataFrame:
    """All matching documents with score and stored fields; statistics cover the whole index, filters only the hits."""
    terms = analyze_query(index.sparkSession, q, stop, stems) if isinstance(q, str) else q
    matches = match_documents(index, terms)
    stats = term_stats(matches, terms)
    return score_matches(matches.filter(search_filter(**filters)), terms, stats)


def search_postings(postings: DataFrame, stats: DataFrame, docs: DataFrame, q: str, stop: Sequence[str] = (),
                    id_col: str = "id", stems: DataFrame | None = None, **filters) -> DataFrame:
    """``search_hits`` on a stored inverted index: only the query's postings and the filtered documents are read.

    Hits are (id, score) rows; they are counted, and up to a limit the documents need no shuffle to meet them.
    """
    terms = analyze_query(docs.sparkSession, q, stop, stems)
    fields = [n for n in FIELDS if n in docs.columns]
    matches = match_postings(postings, terms, fields, id_col)
    scored = cut_lineage(score_matches(matches, terms, postings_stats(matches, terms, stats)))
    found = F.broadcast(scored) if scored.count() <= BROADCAST_HITS else scored
    return docs.filter(search_filter(**filters)).join(found, id_col)


def result_page(hits: DataFrame, terms: Terms, size: int = 20, from_: int = 0, id_col: str = "id") -> DataFrame:
    """One page of hits with highlights ``h_<field>``."""
    return _highlighted(page_results(hits, size, from_, key=id_col), terms)


def _highlighted(page: DataFrame, terms: Terms) -> DataFrame:
    marks = {}
    for n, f in FIELDS.items():
        if n in page.columns:
            c = F.array_join(n, "\n") if dict(page.dtypes)[n] == "array<string>" else F.col(n)
            if f.analyzer == "keyword":
                whole = F.array(F.concat(F.lit("<em>"), c, F.lit("</em>")))
                marks[f"h_{n}"] = F.when(lc_norm(c).isin([t for t, _ in terms.of(n)]), whole).otherwise(F.array().cast("array<string>"))
            else:
                marks[f"h_{n}"] = highlight(c, terms.marked(n), analyzer=f.analyzer)
    return page.withColumns(marks)


def search(index: DataFrame, q: str, size: int = 20, from_: int = 0, stop: Sequence[str] = (), stems: DataFrame | None = None,
           stats: DataFrame | None = None, id_col: str = "id", **filters) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(page with highlights, facet counts, counts by term and date) of the filtered hits.

    The matches are written once, without the texts, and all three results read them; the texts of one page are fetched at the end.
    ``stats`` are the stored ``field_stats`` of the index; without them they are counted here.
    """
    terms = analyze_query(index.sparkSession, q, stop, stems)
    kept = [c for c in index.columns if c not in FIELDS]
    matches = match_documents(index.select(*kept), terms)
    fields = fields_of(matches)
    some = _any([F.size(F.flatten(f"p_{n}")) > 0 for n in fields if terms.of(n)])
    found = cut_lineage(matches.filter(some))
    totals = postings_stats(found, terms, field_stats(index) if stats is None else stats)
    hits = score_matches(found.filter(search_filter(**filters)), terms, totals)
    facets = A.facet_terms(hits, {f: c for f, c in FACETS.items() if c in hits.columns})
    top = page_results(hits.select(id_col, "score"), size, from_, key=id_col)
    stored = index.drop(*[f"t_{n}" for n in fields])
    page = stored.join(F.broadcast(top), id_col).orderBy(F.col("score").desc(), id_col)  # at most ``size`` rows
    return _highlighted(page, terms), facets, A.facet_term_dates(hits, "term_filter", "date")


def normal_prefix(c: Column, max_length: int = 250) -> Column:
    """Completion key: letters only, lower case, at most ``max_length`` characters of the input."""
    return F.trim(F.regexp_replace(F.lower(F.substring(c, 1, max_length)), r"[^\p{L}]+", " "))


def suggest_prefix(suggestions: DataFrame, q: str, n: int = 5, text: str = "input", weight: str = "weight") -> DataFrame:
    """Best suggestions that start with ``q``, each text once."""
    found = suggestions.filter(normal_prefix(F.col(text)).startswith(normal_prefix(F.lit(q))))
    return skip_duplicate_suggestions(found, text, weight).orderBy(F.col(weight).desc(), text).limit(n)
