"""Registered queries: joins, set operations, aggregations, ordered operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostrum.functions import text as X
from rostrum.operators import aggregates as A, filters as FL, joins as J, ordered as O
from rostrum.plans.records import PERIODS, PERIOD_SQL, TOPICS, V_PROB, topic_probs
from rostrum.plans.registry import query, table
from rostrum.plans.views import (V_DOC, V_LINK, V_SPEECH, V_TOKEN, docs, links, speeches, token_array)

# ---- joins and set operations


@query("join_text_left", """select r.doc_id, r.kind, d.text from (select doc_id, 'label' as kind from labels
    union all select vec_id, 'vector' from embeddings union all select page_id, 'page' from pages) r left join documents d using (doc_id)""")
def _(spark, sf):
    """Records of three tables, some without a text of their id."""
    parts = [("labels", "doc_id", "label"), ("embeddings", "vec_id", "vector"), ("pages", "page_id", "page")]
    records = J.union_terms(*[table(spark, sf, n).select(F.col(key).alias("doc_id"), F.lit(kind).alias("kind")) for n, key, kind in parts])
    return J.join_text_left(records, table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


@query("join_annotations_left", f"""with {V_DOC} select v_doc.doc_id, speaker, concept from v_doc left join (
  select doc_id, concat('q', quality) as concept from labels union all select doc_id, concat('t', toxic) from labels) c using (doc_id)""")
def _(spark, sf):
    notes = table(spark, sf, "labels").select("doc_id", F.explode(F.array(
        F.concat(F.lit("q"), "quality"), F.concat(F.lit("t"), "toxic"))).alias("concept"))
    return J.join_annotations_left(docs(spark, sf).select("doc_id", "speaker"), notes, "doc_id")


INLINKS = "select href as uri, count(*) as freq from v_link group by 1"


@query("join_pages_inner", f"""with {V_LINK}, f as ({INLINKS}) select page_id, uri, freq
  from (select page_id, concat('/', split_part(split_part(html, '<h1>', 2), ' ', 1)) as uri from pages) p join f using (uri)""")
def _(spark, sf):
    ids = table(spark, sf, "pages").select("page_id", F.expr("concat('/', split_part(split_part(html, '<h1>', 2), ' ', 1))").alias("uri"))
    return J.join_pages_inner(ids, A.inlink_count(links(spark, sf), "href")).select("page_id", "uri", "freq")


@query("semi_join_ids", "select doc_id, source from documents where doc_id in (select doc_id from labels where quality = 1)")
def _(spark, sf):
    return J.semi_join_ids(table(spark, sf, "documents").select("doc_id", "source"),
                           table(spark, sf, "labels").filter("quality = 1"), "doc_id")


@query("anti_join_indexed", f"""with {V_DOC}, s as (select distinct term, cast(doc_id % 300 as string) as sitting_nr from v_doc)
  select * from s where term = 37 and sitting_nr not in (
    select cast(doc_id % 300 as string) from v_doc where term = 37 and type <> 'en')""")
def _(spark, sf):
    s = docs(spark, sf).select("term", (F.col("doc_id") % 300).cast("string").alias("sitting_nr"), "type")
    return J.anti_join_indexed(s.select("term", "sitting_nr").distinct(), s.filter("type <> 'en'"), 37)


@query("join_sitting_speech", f"""with {V_SPEECH}, s as (select sitting_uid, min(text) as note, count(*) as n from v_speech group by 1)
  select id, speaker, note, n from v_speech join s using (sitting_uid)""")
def _(spark, sf):
    sp = speeches(spark, sf)
    sittings = sp.groupBy("sitting_uid").agg(F.min("text").alias("note"), F.count("*").alias("n"))
    return J.join_sitting_speech(sp, sittings).select("id", "speaker", "note", "n")


@query("join_bill_left", f"""with {V_DOC} select doc_id as id, url as bill_url, h as bill_title, html as bill_details
  from (select doc_id, case doc_id % 3 when 0 then null when 1 then '' else u end as url from v_doc
    left join (select page_id, url as u from pages) q on doc_id = page_id) t
  left join (select url as bu, html, split_part(split_part(html, '<h1>', 2), '</h1>', 1) as h from pages) p on t.url = p.bu""")
def _(spark, sf):
    pages = table(spark, sf, "pages")
    bills = pages.selectExpr("url as bill_url", "split_part(split_part(html, '<h1>', 2), '</h1>', 1) as bill_title", "html as bill_details")
    d = docs(spark, sf).select("doc_id").join(pages.select("page_id", "url"), F.expr("doc_id = page_id"), "left")
    sp = d.selectExpr("cast(doc_id as string) as id", "doc_id", "case doc_id % 3 when 0 then null when 1 then '' else url end as bill_url")
    out = J.join_bill_left(sp, bills)
    return out.selectExpr("doc_id as id", "bill_url", "bill_title", "bill_details")


@query("join_topic_strict", """select doc_id as id, 'joined' as state, quality from documents join labels using (doc_id)
  union all select doc_id, 'rejected', null from documents where doc_id not in (select doc_id from labels)""")
def _(spark, sf):
    joined, rejects = J.join_topic_strict(table(spark, sf, "documents").select(F.col("doc_id").alias("id")),
                                          table(spark, sf, "labels").selectExpr("doc_id as id", "quality"))
    return J.union_terms(joined.withColumn("state", F.lit("joined")), rejects.withColumn("state", F.lit("rejected")))


BENCH_WORDS = r"select distinct unnest(regexp_extract_all(text, '[\p{L}\p{N}]+', 0)) as word from benchmark"


def bench_words(spark, sf):
    return table(spark, sf, "benchmark").select(F.explode(X.words("text")).alias("word")).distinct()


@query("anti_join_stopwords", f"""with {V_TOKEN}, s as ({BENCH_WORDS}) select doc_id, tok, count(*) as n from v_token
  where tok not in (select lower(word) from s) group by 1, 2""")
def _(spark, sf):
    bag = A.bag_of_words(token_array(spark, sf), "doc_id", "toks", "tok", "n")
    return J.anti_join_stopwords(bag, bench_words(spark, sf))


@query("semi_join_vocab", f"""with {V_TOKEN} select doc_id, tok, count(*) as n from v_token
  where tok in (select tok from v_token group by 1 having count(*) > 50) group by 1, 2""")
def _(spark, sf):
    t = token_array(spark, sf)
    vocab = FL.filter_vocab(A.word_count(t, "toks"), [])
    return J.semi_join_vocab(A.bag_of_words(t, "doc_id", "toks", "tok", "n"), vocab)


@query("join_doc_names", f"with {V_PROB} select doc_id, topic, prob, concat(source, '.txt') as name from v_prob join documents using (doc_id) where prob > 0.1")
def _(spark, sf):
    names = table(spark, sf, "documents").selectExpr("doc_id", "concat(source, '.txt') as name")
    return J.join_doc_names(FL.filter_confident_topic(topic_probs(spark, sf), 0.1), names)


@query("outer_compare", f"""with {V_DOC}, c as (select {PERIOD_SQL} as period, speaker, count(*) as n from v_doc group by 1, 2)
  select speaker, {', '.join(f"cast(sum(n) filter (period = '{p}') as bigint) as p{p}" for p in PERIODS)}
  from c where period is not null group by 1""")
def _(spark, sf):
    counts = A.period_top_list(docs(spark, sf), PERIODS, "speaker", "date")
    wide = J.outer_compare(counts, "period", "speaker", "count", list(PERIODS))
    return wide.select("speaker", *[F.col(f"`{p}`").alias(f"p{p}") for p in PERIODS])


@query("join_protected_words", f"""with {V_TOKEN}, s as ({BENCH_WORDS} where item_id is not null)
  select tok, count(*) as n, tok in (select lower(word) from s) as protected from v_token group by 1""")
def _(spark, sf):
    counts = A.word_count(token_array(spark, sf), "toks", "tok", "n")
    return J.join_protected_words(counts, bench_words(spark, sf))


@query("union_terms", """select concat('d', doc_id) as id, text, lang as topic, null as speaker from documents
  union all select concat('c', conv_id, '-', turn), text, null, role from conversations
  union all select concat('p', page_id), null, null, url from pages""")
def _(spark, sf):
    return J.union_terms(
        table(spark, sf, "documents").selectExpr("concat('d', doc_id) as id", "text", "lang as topic"),
        table(spark, sf, "conversations").selectExpr("concat('c', conv_id, '-', turn) as id", "role as speaker", "text"),
        table(spark, sf, "pages").selectExpr("concat('p', page_id) as id", "url as speaker"))


@query("distinct_ids", "select distinct l_orderkey from lineitem")
def _(spark, sf):
    return J.distinct_ids(table(spark, sf, "lineitem"), "l_orderkey")


SUGGEST_SQL = """select speaker as input, 10 as weight from v_doc union all select party, 5 from v_doc where party is not null
  union all select type, 7 from v_doc union all select speaker, 5 from v_doc"""


def suggestion_rows(spark, sf):
    from rostrum.operators.project import build_suggestions

    d = docs(spark, sf).withColumnRenamed("party", "speaker_party").withColumn("topic", F.col("speaker"))
    rows = build_suggestions(d.select("speaker", "speaker_party", "type", "topic")).select(F.explode("suggest").alias("s"))
    return rows.select(F.explode("s.input").alias("input"), "s.weight")


@query("skip_duplicate_suggestions", f"with {V_DOC} select input, max(weight) as weight from ({SUGGEST_SQL}) t group by 1")
def _(spark, sf):
    return J.skip_duplicate_suggestions(suggestion_rows(spark, sf))


VERSIONS = """select doc_id as id, 0 as seq, source as name from documents
  union all select doc_id, 1, concat(source, 'b') from documents where lang = 'en'
  union all select doc_id, 2, concat(source, 'c') from documents where source in ('src1', 'src2')
  union all select -1 - doc_id, 2, 'new' from documents where lang = 'fr'"""


def versions(spark, sf):
    """(first versions, corrections and additions) of the documents."""
    d = table(spark, sf, "documents")
    new = J.union_terms(d.filter("lang = 'en'").selectExpr("doc_id as id", "1 as seq", "concat(source, 'b') as name"),
                        d.filter("source in ('src1', 'src2')").selectExpr("doc_id as id", "2 as seq", "concat(source, 'c') as name"),
                        d.filter("lang = 'fr'").selectExpr("-1 - doc_id as id", "2 as seq", "'new' as name"))
    return d.selectExpr("doc_id as id", "0 as seq", "source as name"), new


@query("upsert_by_id", f"select id, arg_max(name, seq) as name, max(seq) as seq from ({VERSIONS}) t group by 1")
def _(spark, sf):
    return J.upsert_by_id(*versions(spark, sf))


# ---- aggregations

@query("word_count", f"with {V_TOKEN} select tok as term, count(*) as freq from v_token group by 1")
def _(spark, sf):
    return A.word_count(token_array(spark, sf), "toks")


FACETS = {"speakers": "speaker", "parties": "party", "types": "type", "topics": "topics"}


@query("facet_terms", f"""with {V_DOC}, e as (
    select 'speakers' as facet, speaker as value from v_doc union all select 'parties', party from v_doc
    union all select 'types', type from v_doc union all select 'topics', unnest(list_distinct(regexp_extract_all(text, '[A-Z]\\w+', 0))) from v_doc),
  c as (select facet, value, count(*) as count from e where value is not null group by 1, 2)
  select facet, value, count from (select *, row_number() over (partition by facet order by count desc, value) as rn from c) t where rn <= 25""")
def _(spark, sf):
    d = docs(spark, sf).withColumn("topics", F.regexp_extract_all("text", F.lit(r"[A-Z]\w+"), F.lit(0)))
    return A.facet_terms(d, FACETS)


@query("facet_term_dates", f"""with {V_DOC}, t as (select cast(term as string) as term, count(*) as term_count from v_doc group by 1 order by 1 limit 10)
  select term, any_value(term_count) as term_count, date, count(*) as count
  from (select cast(term as string) as term, date from v_doc) v join t using (term) group by term, date""")
def _(spark, sf):
    return A.facet_term_dates(docs(spark, sf))


@query("value_counts", f"with {V_DOC} select party, count(*) as count from v_doc where party is not null group by 1")
def _(spark, sf):
    return A.value_counts(docs(spark, sf), "party")


@query("inlink_count", f"with {V_LINK} {INLINKS}")
def _(spark, sf):
    return A.inlink_count(links(spark, sf), "href")


@query("topic_cooccurrence", f"""with t as (select doc_id, unnest([doc_id % 7, doc_id % 11, doc_id % 24]) as topic,
    unnest([1, 2, 3]) as pos from documents),
  p as (select least(a.topic, b.topic) as s, greatest(a.topic, b.topic) as t, count(*) as n from t a
    join t b on a.doc_id = b.doc_id and a.pos < b.pos and a.topic <> b.topic group by 1, 2)
  select lpad(cast(a.i as string), 2, '0') as source, lpad(cast(b.i as string), 2, '0') as target, coalesce(n, 0) as weight
  from range(24) a(i) join range(24) b(i) on a.i < b.i left join p on p.s = a.i and p.t = b.i""")
def _(spark, sf):
    d = table(spark, sf, "documents").selectExpr(TOPICS)
    return A.topic_cooccurrence(d.select(F.split("topics", r"\|").alias("topics")), 24)


@query("indexed_sittings", f"""with {V_DOC} select distinct cast(doc_id % 300 as string) as sitting_nr from v_doc where term = 37""")
def _(spark, sf):
    return A.indexed_sittings(docs(spark, sf).withColumn("sitting_nr", F.col("doc_id") % 300), 37)


@query("bag_of_words", f"with {V_TOKEN} select doc_id, tok as term, count(*) as tf from v_token group by 1, 2")
def _(spark, sf):
    return A.bag_of_words(token_array(spark, sf), "doc_id", "toks")


@query("doc_frequency", f"with {V_TOKEN} select tok as term, count(distinct doc_id) as df from v_token group by 1")
def _(spark, sf):
    return A.doc_frequency(token_array(spark, sf), "toks")


STOP = ("the", "of", "de", "and", "a", "la")


def vocabulary(spark, sf, min_count: int = 50, skip_top: int = 25, docs=None):
    return A.build_vocabulary(token_array(spark, sf) if docs is None else docs, "toks", STOP, min_count, skip_top)


VOCAB_SQL = f"""select term, freq from (select *, row_number() over (order by freq desc, term) as rn from (
    select tok as term, count(*) as freq from v_token where tok not in {STOP} group by 1 having count(*) > 50) c) r where rn > 25"""


@query("topic_count_rule", f"with {V_TOKEN} select cast(round_even(pow(count(*) / 2, 1 / 3), 0) as int) as n from ({VOCAB_SQL}) v")
def _(spark, sf):
    return A.topic_count_rule(vocabulary(spark, sf))


@query("hit_histogram", f"with {V_DOC} select cast(date_trunc('month', date) as date) as bucket, count(*) as count from v_doc where contains(text, ' the ') group by 1")
def _(spark, sf):
    return A.hit_histogram(docs(spark, sf).filter(F.col("text").contains(" the ")))


@query("period_top_list", f"""with {V_DOC} select {PERIOD_SQL} as period, type, count(*) as count from v_doc
  where contains(speaker, 'src1') and {PERIOD_SQL} is not null group by 1, 2""")
def _(spark, sf):
    return A.period_top_list(FL.filter_name_excluding(docs(spark, sf), "src1", [], "speaker", "type"), PERIODS, "type", "date")


# ---- ordered operators

@query("carry_header", f"""with {V_SPEECH}, h as (select sitting_uid, arg_min(topic, idx) as header from v_speech where topic is not null and idx > 1 group by 1)
  select id, h.header from v_speech left join h using (sitting_uid)""")
def _(spark, sf):
    sp = speeches(spark, sf).withColumn("header", F.when(F.col("idx") > 1, F.col("topic")))
    return O.carry_header(sp).select("id", "header")


@query("carry_topic_forward", f"""with {V_SPEECH}, c as (select *, last_value(case when topic is not null then {{'t': topic, 'u': case when idx % 2 = 0 then role_url else '' end}} end
    ignore nulls) over (partition by sitting_uid order by idx rows between unbounded preceding and 1 preceding) as v
    from (select *, concat('/', speaker) as role_url from v_speech) s)
  select id, coalesce(v.t, '') as topic, coalesce(v.u, '') as bill_url from c""")
def _(spark, sf):
    sp = speeches(spark, sf).withColumn("href", F.when(F.col("idx") % 2 == 0, F.concat(F.lit("/"), "speaker")))
    return O.carry_topic_forward(sp, url="href", block=3).select("id", "topic", "bill_url")


@query("speech_index", "select conv_id, turn, row_number() over (partition by conv_id order by turn) as idx from conversations where role <> 'system'")
def _(spark, sf):
    c = table(spark, sf, "conversations").filter("role <> 'system'").select("conv_id", "turn")
    return O.speech_index(c, "conv_id", "turn", block=3)


@query("prev_next_speech", f"""with {V_SPEECH} select id, lag(id) over w as prev_speech_url, lead(id) over w as next_speech_url
  from v_speech window w as (partition by sitting_uid order by idx)""")
def _(spark, sf):
    return O.prev_next_speech(speeches(spark, sf), value="id", block=3).select("id", "prev_speech_url", "next_speech_url")


@query("top_topics_per_doc", f"""with {V_PROB} select * from (select *, cast(row_number() over (partition by doc_id order by prob desc, topic) as int) as rank
  from v_prob) t where rank <= 3""")
def _(spark, sf):
    return O.top_topics_per_doc(topic_probs(spark, sf))


@query("dominant_topic", f"with {V_PROB} select doc_id, arg_max(topic, prob) as topic, max(prob) as prob from v_prob group by 1 having max(prob) > 0.3")
def _(spark, sf):
    return O.dominant_topic(topic_probs(spark, sf), 0.3)


@query("topk_per_period", f"""with {V_DOC}, c as (select {PERIOD_SQL} as period, speaker, count(*) as count from v_doc where {PERIOD_SQL} is not null group by 1, 2)
  select * from (select *, cast(row_number() over (partition by period order by count desc, speaker) as int) as rank from c) t where rank <= 10""")
def _(spark, sf):
    return A.topk_per_period(A.period_top_list(docs(spark, sf), PERIODS, "speaker", "date"), "speaker")


@query("page_results", "select doc_id as id, n_chars as score from documents order by n_chars desc, doc_id limit 20 offset 40")
def _(spark, sf):
    return O.page_results(table(spark, sf, "documents").selectExpr("doc_id as id", "n_chars as score"), from_=40)


@query("drop_most_frequent", f"""with {V_TOKEN} select term, freq from (select *, row_number() over (order by freq desc, term) as rn
  from (select tok as term, count(*) as freq from v_token group by 1) c) r where rn > 25""")
def _(spark, sf):
    return A.drop_most_frequent(A.word_count(token_array(spark, sf), "toks"))


@query("sort_by_freq", f"with {V_LINK} select href as uri, count(*) as freq from v_link group by 1 order by freq desc, uri")
def _(spark, sf):
    counts = links(spark, sf).groupBy(F.col("href").alias("uri")).agg(F.count("*").alias("freq"))
    return O.sort_by_freq(counts)


@query("limit_records", "select doc_id, source from documents order by doc_id limit 100")
def _(spark, sf):
    return O.limit_records(table(spark, sf, "documents").select("doc_id", "source"), 100, "doc_id")


@query("build_vocabulary", f"with {V_TOKEN} {VOCAB_SQL}")
def _(spark, sf):
    return vocabulary(spark, sf)


@query("build_vocabulary_pos", f"""with {V_TOKEN}, c as (select tok as term, count(*) as freq from v_token
    where length(tok) % 4 < 3 and tok not in {STOP} group by 1 having count(*) > 50)
  select term, freq from (select *, row_number() over (order by freq desc, term) as rn from c) r where rn > 25""")
def _(spark, sf):
    tagged = F.transform("toks", lambda t: F.concat(t, F.lit("_"), F.element_at(
        F.array(*[F.lit(p) for p in ("NOUN", "ADJ", "PROPN", "VERB")]), (F.length(t) % 4 + 1).cast("int"))))
    return A.build_vocabulary(token_array(spark, sf).select(F.array_join(tagged, " ").alias("text")), "text", STOP, pos=FL.GOOD_POS)
