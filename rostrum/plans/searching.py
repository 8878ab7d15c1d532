"""Registered queries: text search, and the SQL that restates its scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rostrum.operators import search as S, segments, topk
from rostrum.operators.project import copy_to_filters
from rostrum.operators.rows import compute_once, spread, unnest
from rostrum.plans.registry import query, table
from rostrum.plans.relational import SUGGEST_SQL, suggestion_rows
from rostrum.plans.views import V_DOC, docs
from rostrum.session import cut_lineage, scratch_path

STOP = ("the", "of", "de", "and", "a", "la")


def records(spark, sf) -> DataFrame:
    """Documents as search records: the opening words serve as topic, the source also as committee."""
    return docs(spark, sf).select(
        F.col("doc_id").alias("id"), "text", "speaker", F.col("party").alias("speaker_party"),
        F.regexp_extract("text", r"^[^.\n]*", 0).alias("topic"), F.col("speaker").alias("committee"), "type",
        F.col("term").cast("string").alias("term"), "date", "date_filter")


def indexed(spark, sf) -> DataFrame:
    return S.index_documents(spread(copy_to_filters(records(spark, sf)), "id"), STOP)


def fold(c: str) -> str:
    return f"replace(strip_accents({c}), 'ß', 'ss')"


def words(c: str) -> str:
    return rf"regexp_extract_all({c}, '[\p{{L}}\p{{N}}]+')"


# field → (SQL column of v_doc, analyzer, boost)
SQL_FIELDS = {
    "text": ("text", "folded", 10), "speaker": ("speaker", "standard", 20), "speaker_party": ("party", "keyword", 15),
    "topic": (r"regexp_extract(text, '^[^.\n]*')", "folded", 5), "committee": ("speaker", "folded", 5),
}


def token_sql(field: str) -> str:
    column, analyzer, _ = SQL_FIELDS[field]
    if analyzer == "keyword":
        return f"select doc_id as id, '{field}' as field, lower({column}) as raw, lower({column}) as tok, 0 as pos from v_doc where {column} is not null"
    plain = words(f"lower({column})")
    toks = words(fold(f"lower({column})")) if analyzer == "folded" else plain
    rows = f"select doc_id as id, '{field}' as field, unnest({plain}) as raw, unnest({toks}) as tok, generate_subscripts({plain}, 1) - 1 as pos from v_doc"
    return f"select * from ({rows}) t where raw not in {STOP}" if analyzer == "folded" else rows


def postings_sql(fields=tuple(SQL_FIELDS)) -> str:
    return (f"with {V_DOC}, toks as ({' union all '.join(token_sql(f) for f in fields)}), "
            "len as (select id, field, count(*) as dl from toks group by 1, 2)")


def match_sql(q: str, fields=tuple(SQL_FIELDS)) -> str:
    """CTEs up to w: one row per document, field and query term with its weight."""
    terms = []
    for f in fields:
        _, analyzer, boost = SQL_FIELDS[f]
        qs = [q.lower()] if analyzer == "keyword" else q.lower().split()
        kept = [(i, t) for i, t in enumerate(qs) if analyzer != "folded" or t not in STOP]
        terms += [f"('{f}', '{analyzer}', {boost}, {j}, '{t}', {i}, {len(kept)})" for j, (i, t) in enumerate(kept)]
    return f"""{postings_sql(fields)},
  q(field, analyzer, boost, i, term, off, nt) as (values {', '.join(terms)}),
  fs as (select field, count(*) as n, sum(dl) / count(*) as avgdl from len group by 1),
  m as (select t.id, t.field, q.i, count(*) as tf, list(t.pos - q.off) as starts from toks t join q on t.field = q.field and t.tok = q.term group by 1, 2, 3),
  d as (select field, i, count(*) as df from m group by 1, 2),
  s as (select q.*, n, avgdl, coalesce(df, 0) as df, ln(1 + (n - coalesce(df, 0) + 0.5) / (coalesce(df, 0) + 0.5)) as idf,
      max(n) over (partition by analyzer) as gn, max(coalesce(df, 0)) over (partition by analyzer, q.i) as gdf
    from q join fs using (field) left join d on d.field = q.field and d.i = q.i),
  w as (select m.id, m.field, m.i, m.starts, s.analyzer, s.boost, s.nt, s.avgdl, dl,
      2.2 * s.idf * tf / (tf + 1.2 * (0.25 + 0.75 * dl / s.avgdl)) as w,
      2.2 * ln(1 + (gn - gdf + 0.5) / (gdf + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / s.avgdl)) as gw
    from m join s using (field, i) join len on len.id = m.id and len.field = m.field),
  must as (select id, sum(score) as must from (select id, field, any_value(boost) * sum(w) as score from w group by 1, 2 having count(*) = any_value(nt)) t group by 1),
  pf as (select id, field, count(*) as pf from (select id, field, start from (select id, field, i, nt, unnest(starts) as start from w) u
      group by 1, 2, 3 having count(*) = any_value(nt)) v group by 1, 2),
  phrase as (select id, max(boost * 2.2 * sidf * pf / (pf + 1.2 * (0.25 + 0.75 * dl / avgdl))) as phrase from pf
    join (select field, any_value(boost) as boost, any_value(avgdl) as avgdl, sum(idf) as sidf from s group by 1) x using (field)
    join len using (id, field) group by 1),
  crossed as (select id, max(score) as crossed from (select id, analyzer, sum(best) as score from (
      select id, analyzer, i, any_value(nt) as nt, max(boost * gw) as best from w group by 1, 2, 3) b
    group by 1, 2 having count(*) = any_value(nt)) t group by 1)"""


HITS_SQL = """, hits as (select id, must + 2.0 * coalesce(phrase, 0) + 0.1 * coalesce(crossed, 0) as score
    from must left join phrase using (id) left join crossed using (id) join v_doc on doc_id = id where {where})"""


@query("analyze_text", f"""with {V_DOC}, toks as ({token_sql('text')})
  select id as doc_id, string_agg(tok, ' ' order by pos) as terms, count(*) as n from toks group by 1""")
def _(spark, sf):
    d = S.analyze_text(spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id"), {"t": F.col("text")}, STOP)
    d = d.select("doc_id", F.array_join("t", " ").alias("terms"), F.size(F.array_compact("t")).cast("long").alias("n"))
    return d.filter("n > 0")


@query("build_postings", f"""{postings_sql()} select id, field, tok as term, cast(dl as int) as dl, cast(count(*) as int) as tf, string_agg(pos, ' ' order by pos) as positions
  from toks join len using (id, field) group by 1, 2, 3, 4""")
def _(spark, sf):
    p = S.build_postings(indexed(spark, sf))
    return p.withColumn("positions", F.array_join(F.transform("positions", lambda x: x.cast("string")), " "))


def scored(spark, sf, q: str, part) -> DataFrame:
    index = indexed(spark, sf)
    terms = S.analyze_query(spark, q, STOP)
    m = S.match_documents(index, terms)
    rows = m.withColumn("_st", S.term_stats(m, terms))
    cond, score = part(rows, terms)
    return rows.filter(cond).select("id", F.round(score, 6).alias("score"))


Q_ALL, Q_PHRASE, Q_CROSS = "attion to thanedble", "der die", "src1 that"


@query("match_all_terms", f"{match_sql(Q_ALL)} select id, round(must, 6) as score from must")
def _(spark, sf):
    return scored(spark, sf, Q_ALL, S.match_all_terms)


@query("match_phrase", f"{match_sql(Q_PHRASE)} select id, round(phrase, 6) as score from phrase")
def _(spark, sf):
    return scored(spark, sf, Q_PHRASE, S.match_phrase)


@query("match_cross_fields", f"{match_sql(Q_CROSS)} select id, round(crossed, 6) as score from crossed")
def _(spark, sf):
    return scored(spark, sf, Q_CROSS, S.match_cross_fields)


@query("bm25_score", f"""{match_sql("was rewh anea", ("text",))} select id, round(sum(w), 6) as score from w group by 1""")
def _(spark, sf):
    index = S.index_documents(spread(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), "id"), STOP)
    return S.bm25_score(index, "text", "was rewh anea", STOP).select("id", F.round("score", 6).alias("score"))


SENTENCES_SQL = r"list_filter(regexp_split_to_array(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), '\n+'), lambda x: len(x) > 0)"


def em_sql(terms: list[str], column: str = "text") -> str:
    inside = f"lambda p: {fold('lower(p)')} in ({', '.join(repr(t) for t in terms)})"
    marked = (rf"array_to_string(list_transform(regexp_extract_all(s, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'), lambda p: "
              rf"case when {fold('lower(p)')} in ({', '.join(repr(t) for t in terms)}) then concat('<em>', p, '</em>') else p end), '')")
    found = rf"list_filter({SENTENCES_SQL.replace('text', column)}, lambda s: len(list_filter({words('s')}, {inside})) > 0)"
    return f"array_to_string(list_transform({found}[:3], lambda s: {marked}), ' ... ')"


@query("highlight", f"""select doc_id, marked from (select doc_id, {em_sql(["attion", "etait", "anea"])} as marked from documents) t
  where marked <> ''""")
def _(spark, sf):
    marks = F.array_join(S.highlight(F.col("text"), ["attion", "etait", "anea"]), " ... ")
    d = spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return compute_once(d, {"marked": marks}).select("doc_id", "marked").filter("marked <> ''")


@query("suggest_prefix", f"with {V_DOC} select input, max(weight) as weight from ({SUGGEST_SQL}) t where lower(input) like 'src%' group by 1 order by 2 desc, 1 limit 5")
def _(spark, sf):
    return S.suggest_prefix(suggestion_rows(spark, sf), "SRC")


FILTERS = {"date_from": "1999.01.01.", "date_to": "2015.12.31.", "types": ["en", "fr"], "parties": ["P0", "P1", "P2"]}
WHERE = "date_filter between '1999.01.01.' and '2015.12.31.' and type in ('en', 'fr') and party in ('P0', 'P1', 'P2')"


def searched(spark, sf, q: str = Q_ALL, **more):
    """The search on an index that is analysed and stored once."""
    path = scratch_path(spark, "search")
    indexed(spark, sf).write.parquet(path)
    return S.search(spark.read.parquet(path), q, stop=STOP, **FILTERS, **more)


@query("search", f"""{match_sql(Q_ALL)} {HITS_SQL.format(where=WHERE)}
  select id, round(score, 6) as score, speaker, {em_sql(Q_ALL.split())} as h_text from hits join v_doc on doc_id = id
  order by score desc, id limit 20""")
def _(spark, sf):
    page, _, _ = searched(spark, sf)
    return page.select("id", F.round("score", 6).alias("score"), "speaker", F.array_join("h_text", " ... ").alias("h_text"))


@query("search_facets", f"""{match_sql(Q_ALL)} {HITS_SQL.format(where=WHERE)}, e as (
    select unnest(['speakers', 'parties', 'types', 'topics']) as facet, unnest([speaker, party, type, regexp_extract(text, '^[^.\n]*')]) as value
    from hits join v_doc on doc_id = id), c as (select facet, value, count(*) as count from e group by 1, 2)
  select facet, value, count from (select *, row_number() over (partition by facet order by count desc, value) as rn from c) t where rn <= 25""")
def _(spark, sf):
    return searched(spark, sf)[1]


@query("search_dates", f"""{match_sql(Q_ALL)} {HITS_SQL.format(where=WHERE)}, e as (select cast(term as varchar) as term_filter, date from hits join v_doc on doc_id = id),
    t as (select term_filter, count(*) as term_count from e group by 1 order by 1 limit 10)
  select term_filter, term_count, date, count(*) as count from t join e using (term_filter) group by 1, 2, 3""")
def _(spark, sf):
    return searched(spark, sf)[2]


Q_NAME = "src1"


@query("search_highlights", f"""{match_sql(Q_NAME)} {HITS_SQL.format(where=WHERE)}, titled as (select *, regexp_extract(v_doc.text, '^[^.\n]*') as topic from v_doc)
  select id, round(score, 6) as score, {em_sql([Q_NAME])} as h_text, {em_sql([Q_NAME], "speaker")} as h_speaker, {em_sql([Q_NAME], "topic")} as h_topic,
    {em_sql([Q_NAME], "speaker")} as h_committee, case when lower(party) = '{Q_NAME}' then concat('<em>', party, '</em>') else '' end as h_speaker_party
  from hits join titled on doc_id = id order by score desc, id limit 20""")
def _(spark, sf):
    """The marks in all fields of one page."""
    page = searched(spark, sf, Q_NAME)[0]
    marks = [F.array_join(c, " ... ").alias(c) for c in ("h_text", "h_speaker", "h_topic", "h_committee", "h_speaker_party")]
    return page.select("id", F.round("score", 6).alias("score"), *marks)


Q_STEM = "attion thanedble"


@query("search_stems", f"""with v as (select distinct unnest(regexp_extract_all({fold('lower(text)')}, '[\\p{{L}}\\p{{N}}]+')) as form from documents),
    s as (select form, substring(form, 1, 4) as stem from v where length(form) > 5),
    q as (select term, coalesce(stem, term) as stem from (values ('attion'), ('thanedble')) x(term) left join s on form = term),
    f as (select distinct q.term, q.stem, v.form from q join v on v.form = q.stem or v.form in (select form from s where s.stem = q.stem)),
    t as (select doc_id, unnest(regexp_extract_all({fold('lower(text)')}, '[\\p{{L}}\\p{{N}}]+')) as form from documents)
  select doc_id as id, count(*) as n from t where form in (select form from f) group by 1
    having count(distinct case when form in (select form from f where term = 'attion') then 1 end)
      + count(distinct case when form in (select form from f where term = 'thanedble') then 1 end) = 2""")
def _(spark, sf):
    """Documents that hold some form of every query word, with the number of places."""
    d = spread(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), "id")
    index = S.index_documents(d)
    forms = unnest(index, form="t_text").distinct().filter("length(form) > 5").selectExpr("form as surface", "substring(form, 1, 4) as lemma")
    terms = S.analyze_query(spark, Q_STEM, stems=cut_lineage(S.stem_table(forms)))
    found = S.match_documents(index, terms).filter(F.forall("p_text", lambda p: F.size(p) > 0))
    return found.select("id", F.size(F.array_distinct(F.flatten("p_text"))).cast("long").alias("n"))


@query("search_index", f"{match_sql(Q_ALL)} {HITS_SQL.format(where=WHERE)} select id, round(score, 6) as score from hits")
def _(spark, sf):
    """The same search over a stored inverted index."""
    path = scratch_path(spark, "index")
    indexed(spark, sf).write.parquet(f"{path}/analysed")
    index = spark.read.parquet(f"{path}/analysed")  # analysed once
    S.write_postings(S.build_postings(index), f"{path}/postings")
    S.field_stats(index).write.parquet(f"{path}/stats")
    stored = index.drop(*[c for c in index.columns if c.startswith("t_")])
    hits = S.search_postings(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/stats"), stored, Q_ALL, STOP, **FILTERS)
    return hits.select("id", F.round("score", 6).alias("score"))


@query("keyword_field_match", f"with {V_DOC} select doc_id, party from v_doc where lower(party) = 'p2'")
def _(spark, sf):
    return docs(spark, sf).filter(S.keyword_field_match("p2", "party")).select("doc_id", "party")


@query("search_segments", f"{match_sql(Q_ALL)} {HITS_SQL.format(where=WHERE)} select id, round(score, 6) as score from hits")
def _(spark, sf):
    """The same search over an index of segments: drafts of all documents first, then their texts in two batches, the second with old drafts."""
    whole = copy_to_filters(records(spark, sf))
    first, drafts = F.col("type") == "en", whole.withColumn("text", F.concat(F.lit("draft "), F.reverse("text")))
    batches = [drafts.withColumn("seq", F.lit(1)), whole.filter(first).withColumn("seq", F.lit(2)),
               whole.filter(~F.coalesce(first, F.lit(False))).withColumn("seq", F.lit(2)).union(drafts.withColumn("seq", F.lit(0)))]
    root = scratch_path(spark, "segments")
    segments.create_index(spark, root)
    for n, batch in enumerate(batches):
        segments.add_batch(spark, root, spread(batch, "id"), n, STOP)
    return segments.search_segments(spark, root, Q_ALL, STOP, **FILTERS).select("id", F.round("score", 6).alias("score"))


@query("search_top", f"""{match_sql(Q_ALL)} {HITS_SQL.format(where=WHERE)}
  select id, round(score, 6) as score, speaker from hits join v_doc on doc_id = id order by score desc, id limit 20""")
def _(spark, sf):
    """The first page from blocks of postings with their largest weights."""
    index, path = indexed(spark, sf), scratch_path(spark, "blocks")
    topk.write_blocks(index, path)
    page, _ = topk.search_top(spark, path, Q_ALL, 20, STOP, **FILTERS)
    return page.select("id", F.round("score", 6).alias("score"), "speaker")


@query("complete", f"with {V_DOC} select input, max(weight) as weight from ({SUGGEST_SQL}) t where lower(input) like 'src%' group by 1 order by 2 desc, 1 limit 5")
def _(spark, sf):
    """Completion from the stored table of prefixes; a longer prefix reads a range of the sorted suggestions."""
    path = scratch_path(spark, "completions")
    topk.write_completions(suggestion_rows(spark, sf), path)
    return topk.complete(spark, path, "SRC")
