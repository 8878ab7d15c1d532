"""Registered queries: file formats. Each writes the given tables in a format to the shared folder and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostrum.functions.text import words
from rostrum.operators import aggregates as A, joins as J, project as P
from rostrum.operators.rows import unnest
from rostrum.plans.registry import query, table
from rostrum.plans.relational import VERSIONS, versions
from rostrum.plans.records import TOPICS, V_PROB, nested, topic_probs
from rostrum.plans.views import V_DOC, V_LINK, docs, links
from rostrum.operators.ordered import dominant_topic
from rostrum.session import scratch_path
from rostrum.sources import files as R, sinks as K
from rostrum.streaming import ingest


# ---- sources

@query("read_speech_lines", f"""with {V_DOC} select concat(term, '-', doc_id) as id, speaker, cast(term as string) as term,
    case when type = 'en' then concat(type, '|', speaker) else type end as topic, text, null as reason, 1 as n
  from v_doc where type <> 'es' and speaker <> 'src7'
  union all select null, null, null, null, null, 'no JSON', count(*) from v_doc where type = 'es'
  union all select null, null, null, null, null, 'no speaker', count(*) from v_doc where type <> 'es' and speaker = 'src7'""")
def _(spark, sf):
    d = nested(spark, sf).withColumn("speaker", F.expr("nullif(speaker, 'src7')"))
    one = F.to_json(F.struct(*[c for c in d.columns if c != "topic"], F.col("topic")[0].alias("topic")))
    many = F.to_json(F.struct(*d.columns))
    line = F.concat(F.when(F.col("type") == "en", many).otherwise(one), F.lit(","))
    line = F.when(F.col("type") == "es", F.replace(line, F.lit("}"), F.lit(""))).otherwise(line)
    path = scratch_path(spark, "speech-lines")
    d.select(F.explode(F.array(F.lit("["), line, F.lit("]"))).alias("value")).write.text(path)
    records, rejects = R.read_speech_lines(spark, path)
    flat = P.flatten_speech(records).select("id", "speaker", "term", F.array_join("topic", "|").alias("topic"), "text",
                                            F.lit(None).cast("string").alias("reason"), F.lit(1).cast("long").alias("n"))
    return J.union_terms(flat, rejects.groupBy("reason").agg(F.count("*").alias("n")))


@query("read_json_array", "select cast(conv_id as string) as id, role as speaker, text, concat(role, '|t') as topic from conversations")
def _(spark, sf):
    path = scratch_path(spark, "json-array")
    K.write_array_lines(table(spark, sf, "conversations").selectExpr(
        "cast(conv_id as string) as id", "role as speaker", "text", "array(role, 't') as topic"), path)
    return R.read_json_array(spark, path).select("id", "speaker", "text", F.array_join("topic", "|").alias("topic"))


BODY_SQL = """concat('Ülésnap', chr(10), source, chr(10), source, ': ', text)"""


@query("read_zip_text", "select cast(doc_id as string) as Hash, concat(' ', replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))) as Text from documents where source <> 'src9'")
def _(spark, sf):
    d = table(spark, sf, "documents").selectExpr(
        "case when source = 'src9' then concat('x/', doc_id, '.csv') else concat('speeches/', doc_id, '.v1.txt') end as member",
        f"{BODY_SQL} as body")
    path = scratch_path(spark, "zip-text")
    K.write_archives(K.zip_members(d, "member", "body"), path)
    return R.read_zip_text(spark, path)


@query("read_metadata_tsv", f"""with {V_DOC} select date_filter as Date, concat(speaker, ' (', type, ')') as NameAndParty,
  concat('p_azon=', speaker) as RawSpeakerId, type as SpeechType, cast(doc_id as string) as Hash from v_doc""")
def _(spark, sf):
    path = scratch_path(spark, "metadata")
    K.write_tsv(docs(spark, sf).selectExpr("date_filter as a", "'-' as b", "concat(speaker, ' (', type, ')') as c",
                                           "concat('p_azon=', speaker) as d", "type as e", "'képviselő' as f", "'http://x' as g",
                                           "cast(doc_id as string) as h"), path)
    return R.read_metadata_tsv(spark, path).select("Date", "NameAndParty", "RawSpeakerId", "SpeechType", "Hash")


# XML keeps no control characters and no carriage returns, so runs of white space are compared as one space.
@query("read_wiki_dump", "select doc_id as id, source as title, regexp_replace(text, '[\\s\\x00-\\x1f]+', ' ', 'g') as content from documents")
def _(spark, sf):
    path = scratch_path(spark, "wiki")
    text = F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ")  # XML has no control characters
    d = table(spark, sf, "documents").withColumn("text", text).selectExpr(
        "doc_id as id", "source as title", "named_struct('text', named_struct('_VALUE', text, '_bytes', '1')) as revision")
    d.write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").save(path)
    pages = R.read_wiki_dump(spark, path)
    return pages.withColumn("content", F.regexp_replace("content", r"[\s\x00-\x1f]+", " "))


@query("read_triples", f"with {V_LINK} select url as s, 'http://x/links' as p, concat('http://x', href) as o from v_link")
def _(spark, sf):
    path = scratch_path(spark, "triples")
    lines = links(spark, sf).selectExpr("concat('<', url, '> <http://x/links> <http://x', href, '> .') as line", "page_id")
    lines.select(F.explode(F.array(F.lit("# started"), F.col("line"))).alias("value")).write.text(path)
    return R.read_triples(spark, path)


@query("read_inlinks_csv", f"with {V_LINK} select count(*) as freq, replace(href, ' ', '_') as uri from v_link group by 2")
def _(spark, sf):
    path = scratch_path(spark, "inlinks")
    counts = A.inlink_count(links(spark, sf).withColumn("href", F.replace("href", F.lit(" "), F.lit("_"))), "href")
    counts.write.csv(path, sep=" ", header=False)
    return R.read_inlinks_csv(spark, path)


@query("read_zip_json", "select doc_id as id, source as title, text as content from documents where doc_id in (select doc_id from labels)")
def _(spark, sf):
    d = table(spark, sf, "documents").select(F.concat("doc_id", F.lit(".json")).alias("member"),
                                             F.to_json(F.struct(F.col("source").alias("title"), F.col("text").alias("content"))).alias("body"))
    path = scratch_path(spark, "zip-json")
    K.write_archives(K.zip_members(d, "member", "body"), path)
    ids = table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return R.read_zip_json(spark, path, ids)


@query("read_pages", "select page_id, url, html from pages")
def _(spark, sf):
    return R.read_pages(spark, f"{sf}/pages.parquet")


@query("read_topic_tsv", f"select cast(doc_id as string) as id, concat(doc_id % 7, '/', doc_id % 11, '/', doc_id % 24) as topics from documents")
def _(spark, sf):
    path = scratch_path(spark, "doc-topics")
    K.write_tsv(table(spark, sf, "documents").selectExpr("cast(doc_id as string) as id", TOPICS), path, header=False)
    return R.read_topic_tsv(spark, path).select("id", F.array_join("topics", "/").alias("topics"))


@query("read_word_list", r"select distinct unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) as word from benchmark")
def _(spark, sf):
    path = scratch_path(spark, "words")
    w = unnest(table(spark, sf, "benchmark"), word=words("text"))
    w.select(F.explode(F.array(F.lit("# source"), F.concat("word", F.lit(" ")), F.lit("Banner -- x"), F.lit(""))).alias("value")).write.text(path)
    return R.read_word_list(spark, path)


@query("read_annotations", "select doc_id, 'q' || quality as text, 'Q' as tag from labels union all select doc_id, 't' || toxic, 'T' from labels")
def _(spark, sf):
    path = scratch_path(spark, "annotations")
    table(spark, sf, "labels").selectExpr("doc_id", "array(named_struct('text', concat('q', quality), 'tag', 'Q'), "
                                          "named_struct('text', concat('t', toxic), 'tag', 'T')) as Entities").write.parquet(path)
    return unnest(R.read_annotations(spark, path), "doc_id", e="Entities").select("doc_id", "e.*")


# ---- sinks

@query("write_speech_feed", f"with {V_DOC} select concat(term, '-', doc_id) as id, cast(term as int) as term, speaker, text from v_doc")
def _(spark, sf):
    path = scratch_path(spark, "feed")
    K.write_speech_feed(docs(spark, sf).select(F.concat_ws("-", "term", "doc_id").alias("id"), "term", "speaker", "text"), path)
    return spark.read.schema("id string, speaker string, text string, term int").json(path)


@query("write_tsv", "select cast(doc_id as string) as id, lang, concat(' ', text, ' \"x\" ') as text from documents")
def _(spark, sf):
    path = scratch_path(spark, "tsv")
    K.write_tsv(table(spark, sf, "documents").selectExpr("cast(doc_id as string) as id", "lang", """concat(' ', text, ' "x" ') as text"""), path)
    return R.read_merged_tsv(spark, path, "id string, lang string, text string")


@query("write_by_topic", f"""with {V_PROB} select doc_id, text, topic from documents join
  (select doc_id, cast(arg_max(topic, prob) as int) as topic from v_prob group by 1 having max(prob) > 0.3) t using (doc_id)""")
def _(spark, sf):
    path = scratch_path(spark, "by-topic")
    topics = dominant_topic(topic_probs(spark, sf), 0.3).select("doc_id", "topic")
    K.write_by_topic(table(spark, sf, "documents").select("doc_id", "text").join(topics, "doc_id"), path)
    return spark.read.parquet(path)


@query("write_wiki_json", "select doc_id as id, source as title, text as content from documents where not contains(source, ':') and length(trim(text)) > 0")
def _(spark, sf):
    from rostrum.operators.filters import filter_articles

    path = scratch_path(spark, "wiki-json")
    K.write_wiki_json(filter_articles(table(spark, sf, "documents").selectExpr("doc_id as id", "source as title", "text as content")), path)
    return spark.read.schema("id bigint, title string, content string").json(path)


@query("write_topic_graph", f"""with t as (select doc_id, unnest([doc_id % 7, doc_id % 11, doc_id % 24]) as topic, unnest([1, 2, 3]) as pos from documents),
  p as (select least(a.topic, b.topic) as s, greatest(a.topic, b.topic) as t, count(*) as n from t a
    join t b on a.doc_id = b.doc_id and a.pos < b.pos and a.topic <> b.topic group by 1, 2)
  select concat('Topic ', lpad(cast(a.i as string), 2, '0')) as source_name, lpad(cast(b.i as string), 2, '0') as target,
    case when b.i is null then null else coalesce(n, 0) end as weight
  from range(24) a(i) left join range(24) b(i) on a.i < b.i left join p on s = a.i and t = b.i""")
def _(spark, sf):
    path = scratch_path(spark, "graph")
    d = table(spark, sf, "documents").selectExpr(TOPICS).select(F.split("topics", r"\|").alias("topics"))
    K.write_topic_graph(A.topic_cooccurrence(d, 24), 24, path)
    nodes = spark.read.parquet(f"{path}/nodes").selectExpr("id as source", "name as source_name")
    return nodes.join(spark.read.parquet(f"{path}/edges"), "source", "left").drop("source")


@query("publish_version", "select doc_id as id, lang as type from documents where length(text) > 500")
def _(spark, sf):
    path = scratch_path(spark, "published")
    d = table(spark, sf, "documents")
    K.publish_version(spark, d.selectExpr("doc_id as id", "lang as type"), path, 1)
    return K.publish_version(spark, d.filter("length(text) > 500").selectExpr("doc_id as id", "lang as type"), path, 2)


# ---- stream

@query("stream_ingest", f"select id, arg_max(name, seq) as name, max(seq) as seq from ({VERSIONS}) t group by 1")
def _(spark, sf):
    src, target, check = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-checkpoint"))
    schema = "id bigint, seq int, name string"
    old, new = versions(spark, sf)
    old.write.mode("append").json(src)
    ingest.stream_ingest(spark, src, target, check, schema).awaitTermination()
    new.write.mode("append").json(src)
    ingest.stream_ingest(spark, src, target, check, schema).awaitTermination()
    return ingest.current(spark, target)
