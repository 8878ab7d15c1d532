"""Registered queries: projections and filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from rostrum.functions import text as X
from rostrum.operators import filters as FL, project as P
from rostrum.operators.rows import compute_once
from rostrum.plans.registry import query, table
from rostrum.plans.views import V_DOC, V_LEMMA, V_SPEECH, V_TOKEN, docs, speeches, token_array, tokens


def nested(spark, sf) -> DataFrame:
    """Documents as crawled speeches with their sitting inside."""
    d = docs(spark, sf)
    return d.select(
        F.concat_ws("-", "term", F.col("doc_id")).alias("id"), "speaker", F.col("party").alias("speaker_party"), "text", "type",
        F.array(F.col("type"), F.col("speaker")).alias("topic"), F.lit(None).cast("string").alias("committee"),
        F.concat(F.lit("b"), F.col("doc_id") % 9).alias("bill_details"),
        F.struct(
            F.col("term").cast("string").alias("term"), F.col("date_filter").alias("date"), F.lit("hétfő").alias("day"),
            F.concat(F.lit("t"), F.col("doc_id") % 3).alias("type"), (F.col("doc_id") % 300).cast("string").alias("sitting_nr"),
            F.lit("9:00").alias("duration"), F.lit("8:30").alias("duration_raw"), F.lit("x").alias("sitting_day"),
            F.lit("h").alias("header")).alias("plenary_sitting_details"))


@query("flatten_speech", f"""with {V_DOC} select concat(term, '-', doc_id) as id, speaker, party as speaker_party, text, type,
  concat(type, '|', speaker) as topic, cast(term as string) as term, date_filter as date, 'hétfő' as day, 'hétfő' as sitting_day,
  concat('t', doc_id % 3) as sitting_type, cast(doc_id % 300 as string) as sitting_nr, '9:00' as sitting_duration,
  '8:30' as sitting_duration_raw from v_doc""")
def _(spark, sf):
    flat = P.flatten_speech(nested(spark, sf))
    return flat.withColumn("topic", F.array_join("topic", "|")).drop("committee")


@query("rename_drop", """select doc_id as Hash, lang as SpeechType, source as Name from documents""")
def _(spark, sf):
    return P.rename_drop(table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars"),
                         ["Hash", "Text", "SpeechType", "Name", "Unk1"], ["Text", "Unk1"])


@query("copy_to_filters", f"""with {V_DOC} select doc_id, type, type as type_filter, speaker, speaker as speaker_filter,
  cast(term as string) as term, cast(term as string) as term_filter, date, date_filter from v_doc""")
def _(spark, sf):
    d = docs(spark, sf).withColumn("term", F.col("term").cast("string"))
    return P.copy_to_filters(d.select("doc_id", "type", "speaker", "term", "date", "date_filter"))


@query("build_suggestions", f"""with {V_DOC}
  select doc_id, speaker as input, 10 as weight from v_doc
  union all select doc_id, party, 5 from v_doc where party is not null
  union all select doc_id, type, 7 from v_doc
  union all select doc_id, case when length(text) <= 250 then text
    else concat(regexp_replace(substring(text, 1, 250), ' [^ ]*\\z', ''), '...') end, 5 from v_doc
  union all select doc_id, unnest([text, speaker]), 5 from v_doc""")
def _(spark, sf):
    d = docs(spark, sf).withColumnRenamed("party", "speaker_party")
    d = P.build_suggestions(d.withColumn("topic", F.col("text")).withColumn("bill_title", F.array("text", "speaker")))
    d = d.select("doc_id", F.explode("suggest").alias("s")).select("doc_id", F.explode("s.input").alias("input"), "s.weight")
    return d


@query("normalize_record", """select doc_id, case when doc_id % 3 <> 0 then source end as name,
  concat(lang, ' x') as kind, case when doc_id % 4 <> 0 then lang end as tags, case when doc_id % 5 <> 0 then lang end as inner_note
  from documents""")
def _(spark, sf):
    d = table(spark, sf, "documents").selectExpr(
        "doc_id", "case when doc_id % 3 = 0 then concat(chr(160), ' ') else concat(' ', source, chr(10)) end as name",
        "concat(lang, chr(160), 'x') as kind",
        "case when doc_id % 4 = 0 then cast(array() as array<string>) else array(lang) end as tags",
        "named_struct('note', case when doc_id % 5 = 0 then ' ' else concat(' ', lang, ' ') end) as details")
    return P.normalize_record(d).select("doc_id", "name", "kind", F.array_join("tags", "|").alias("tags"),
                                        F.col("details.note").alias("inner_note"))


@query("speech_key", """select conv_id, turn, concat('36-', conv_id) as sitting_uid, concat('36-', conv_id, '-', turn + 1) as id
  from conversations""")
def _(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", (F.col("turn") + 1).alias("idx"), F.lit(36).alias("term"))
    return P.speech_key(c, nr="conv_id").select("conv_id", "turn", "sitting_uid", "id")


TOPICS = "concat(cast(doc_id % 7 as string), '|', cast(doc_id % 11 as string), '|', cast(doc_id % 24 as string)) as topics"


@query("with_topic_number", f"""select doc_id, topics, cast(doc_id % 7 as string) as topic_number
  from (select doc_id, {TOPICS} from documents) t""")
def _(spark, sf):
    return P.with_topic_number(table(spark, sf, "documents").selectExpr("doc_id", TOPICS))


@query("filter_date_eq", f"with {V_DOC} select doc_id, date_filter from v_doc where date_filter = '1998.02.07.'")
def _(spark, sf):
    return docs(spark, sf).filter(FL.date_eq("1998.02.07.")).select("doc_id", "date_filter")


@query("filter_date_range", f"""with {V_DOC} select doc_id, date_filter from v_doc
  where date_filter >= '2001.01.01.' and date_filter <= '2005.12.31.'""")
def _(spark, sf):
    return docs(spark, sf).filter(FL.date_range("2001.01.01.", "2005.12.31.")).select("doc_id", "date_filter")


@query("filter_speakers", f"with {V_DOC} select doc_id, speaker from v_doc where speaker in ('src1', 'src7', 'none')")
def _(spark, sf):
    return docs(spark, sf).filter(FL.any_of(["src1", "src7", "none"], "speaker")).select("doc_id", "speaker")


@query("filter_parties", f"with {V_DOC} select doc_id, party from v_doc where party in ('P0', 'P3')")
def _(spark, sf):
    return docs(spark, sf).filter(FL.any_of(["P0", "P3"], "party")).select("doc_id", "party")


@query("filter_types", f"with {V_DOC} select doc_id, type from v_doc where type in ('fr', 'de', 'EN')")
def _(spark, sf):
    return docs(spark, sf).filter(FL.any_of(["fr", "de", "EN"], "type")).select("doc_id", "type")


@query("filter_optional", f"""with {V_DOC} select doc_id, 'all' as call from v_doc
  union all select doc_id, 'some' from v_doc where date_filter between '2001.01.01.' and '2009.12.31.' and party in ('P1', 'P2')
  union all select doc_id, 'to' from v_doc where type in ('en')""")
def _(spark, sf):
    d = docs(spark, sf).selectExpr("doc_id", "date_filter", "party as speaker_party_filter", "type as type_filter", "speaker as speaker_filter")
    calls = {"all": {}, "some": {"date_from": "2001.01.01.", "date_to": "2009.12.31.", "parties": ["P1", "P2"]},
             "to": {"date_to": "1999.01.01.", "types": ["en"]}}
    flags = [F.when(FL.search_filter(**kw), F.lit(name)) for name, kw in calls.items()]
    return d.select("doc_id", F.explode(F.array_compact(F.array(*flags))).alias("call"))


@query("filter_sitting_speech", f"with {V_SPEECH} select id, idx from v_speech where sitting_uid = '36-7' and cast(idx as string) = '2'")
def _(spark, sf):
    return FL.filter_sitting_speech(speeches(spark, sf), "36-7", "2", sitting="sitting_uid").select("id", "idx")


@query("filter_name_excluding", f"""with {V_DOC} select doc_id, speaker, party from v_doc
  where contains(speaker, 'src1') and not contains(coalesce(party, ''), 'P1') and not contains(coalesce(party, ''), 'P2')""")
def _(spark, sf):
    return (FL.filter_name_excluding(docs(spark, sf), "src1", ["P1", "P2"], "speaker", "party")
            .select("doc_id", "speaker", "party"))


# The compared periods, from election year to election year, both ends open.
PERIODS = {str(y): (dt.date(y, 1, 1), dt.date(y + 4, 1, 1) if y < 2014 else None) for y in range(1998, 2015, 4)}
PERIOD_SQL = """case when date > date '1998-01-01' and date < date '2002-01-01' then '1998'
  when date > date '2002-01-01' and date < date '2006-01-01' then '2002' when date > date '2006-01-01' and date < date '2010-01-01' then '2006'
  when date > date '2010-01-01' and date < date '2014-01-01' then '2010' when date > date '2014-01-01' then '2014' end"""


@query("filter_period_open", f"with {V_DOC} select doc_id, date, {PERIOD_SQL} as period from v_doc where {PERIOD_SQL} is not null")
def _(spark, sf):
    d = docs(spark, sf).select("doc_id", "date", FL.period_label("date", PERIODS).alias("period"))
    return d.filter("period is not null")


@query("filter_important_pages", r"""with u as (select concat('http://x/', tok) as uri, count(*) as freq from (
    select unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+', 0)) as tok from documents) t group by 1)
  select uri, freq from u where freq > 100 and not contains(uri, 'la') and not contains(uri, 'th')
    and not regexp_matches(uri, '^.*/.*\d+.*$')""")
def _(spark, sf):
    uris = tokens(spark, sf).groupBy(F.concat(F.lit("http://x/"), "tok").alias("uri")).agg(F.count("*").alias("freq"))
    return FL.filter_important_pages(uris, words=["la", "th"])


@query("filter_articles", """select doc_id, length(text) as chars from documents
  where lang <> 'de' and source <> 'src3' and length(text) > 1000""")
def _(spark, sf):
    d = table(spark, sf, "documents").selectExpr(
        "doc_id", "case when lang = 'de' then concat('Cat:', source) else source end as title",
        "case when source = 'src3' then concat(repeat(chr(160), 2000), chr(10)) else text end as content")
    return FL.filter_articles(d, min_length=1000).select("doc_id", F.length("content").cast("long").alias("chars"))


@query("filter_pos", f"with {V_LEMMA} select doc_id, count(*) as n from v_lemma where not lemma_pos like '%\\_verb' escape '\\' group by 1")
def _(spark, sf):
    d = token_array(spark, sf)
    tags = F.array(*[F.lit(p) for p in ("NOUN", "ADJ", "PROPN", "VERB")])
    text = F.array_join(F.transform("toks", lambda t: F.concat(t, F.lit("_"), F.element_at(tags, (F.length(t) % 4 + 1).cast("int")))), " ")
    return compute_once(d, {"n": F.size(FL.keep_pos(text)).cast("long")}).select("doc_id", "n").filter("n > 0")


@query("filter_vocab", f"""with {V_TOKEN} select tok as term, count(*) as freq from v_token
  where tok not in ('the', 'of', 'de', 'and') group by 1 having count(*) > 50""")
def _(spark, sf):
    counts = tokens(spark, sf).groupBy(F.col("tok").alias("term")).agg(F.count("*").alias("freq"))
    return FL.filter_vocab(counts, ["the", "of", "de", "and"])


def topic_probs(spark, sf) -> DataFrame:
    """Vector entries as given topic weights: (doc_id, topic, prob)."""
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.posexplode("embedding").alias("topic", "p")) \
        .select("doc_id", "topic", F.col("p").cast("double").alias("prob"))


V_PROB = """v_prob as (select vec_id as doc_id, cast(generate_subscripts(embedding, 1) - 1 as int) as topic,
  cast(unnest(embedding) as double) as prob from embeddings)"""


@query("filter_confident_topic", f"with {V_PROB} select doc_id, topic, prob from v_prob where prob > 0.2")
def _(spark, sf):
    return FL.filter_confident_topic(topic_probs(spark, sf), 0.2)


@query("guard_text", r"""select vec_id as doc_id, coalesce(length(regexp_extract_all(text, '[\p{L}\p{N}]+', 0)), 0) as n
  from documents full join (select vec_id from embeddings) e on doc_id = vec_id where vec_id is not null
  union all select doc_id, coalesce(length(regexp_extract_all(text, '[\p{L}\p{N}]+', 0)), 0) from documents where doc_id not in (select vec_id from embeddings)""")
def _(spark, sf):
    """All texts; vectors without a document have none."""
    vecs = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"))
    every = table(spark, sf, "documents").select("doc_id", "text").join(vecs, "doc_id", "full")
    text = F.col("text")
    return every.select("doc_id", F.size(FL.guard_text(text, X.words(text))).cast("long").alias("n"))
