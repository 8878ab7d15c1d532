"""Registered queries: annotation, sentences, lemmas, similarity, topics."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Window, functions as F

from rostrum.functions.text import words
from rostrum.operators import aggregates as A, annotate as N, similarity as E, topic_tables as TT, topics as TM
from rostrum.operators.rows import spread, unnest
from rostrum.plans.registry import query, table
from rostrum.plans.relational import VOCAB_SQL, bench_words, vocabulary
from rostrum.plans.views import V_TOKEN, token_array
from rostrum.session import cut_lineage, save_table, scratch_path
from rostrum.sources.files import read_wiki_dump
from rostrum.sources.sinks import write_wiki_json

# ---- annotation


def capital_words():
    """Annotator: words with a capital first letter."""
    pattern = re.compile("[A-Z][a-z]+")
    return lambda text: [{"text": m, "tag": "CAP"} for m in pattern.findall(text)]


@query("annotate", """select doc_id, text, tag, count(*) as n from (
  select doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+')) as text, 'CAP' as tag from documents) t group by 1, 2, 3""")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    out = N.annotate(spread(d, "doc_id"), capital_words, "text", "text:string,tag:string", keep=["doc_id"])
    return N.explode_annotations(out, "annotations", "doc_id").groupBy("doc_id", "text", "tag").agg(F.count("*").alias("n"))


# Every text is cut into runs of two, three and one words in turn.
PHRASES = r"""select distinct phrase, tag from (select unnest(list_transform(range(1, len(w) - 4, 6), lambda i: array_to_string(w[i:i + 1], ' '))) as phrase, 'B2' as tag
    from (select regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from benchmark) b
  union all select unnest(list_transform(range(1, len(w) - 4, 6), lambda i: array_to_string(w[i + 2:i + 4], ' '))), 'B3'
    from (select regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from benchmark) b
  union all select unnest(list_transform(range(1, len(w) - 4, 6), lambda i: w[i + 5])), 'B1'
    from (select regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from benchmark) b) u"""


@query("gazetteer_entities", rf"""with p as ({PHRASES}), t as (select doc_id, unnest(w) as w1, unnest(w[2:]) as w2, unnest(w[3:]) as w3,
    generate_subscripts(w, 1) - 1 as pos from (select doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') as w from documents) d),
  g as (select doc_id, pos, w1 as phrase from t union all select doc_id, pos, concat(w1, ' ', w2) from t where w2 is not null
    union all select doc_id, pos, concat(w1, ' ', w2, ' ', w3) from t where w3 is not null)
  select doc_id, cast(pos as int) as pos, phrase, tag from g join p using (phrase)""")
def _(spark, sf):
    w = table(spark, sf, "benchmark").select(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)).alias("w"))
    starts = F.filter(F.transform("w", lambda _, i: i + 1), lambda i: (i % 6 == 1) & (i + 5 <= F.size("w")))
    runs = F.flatten(F.transform(starts, lambda i: F.array(*[F.struct(F.array_join(F.slice("w", i + a, n), " ").alias("phrase"), F.lit(t).alias("tag"))
                                                             for a, n, t in ((0, 2, "B2"), (2, 3, "B3"), (5, 1, "B1"))])))
    p = unnest(w, p=runs).select("p.*")
    return N.gazetteer_entities(token_array(spark, sf), p, "toks", ["doc_id"]).select("doc_id", "pos", "phrase", "tag")


@query("concept_threshold", "select doc_id, least(1.0, n_chars / 1500.0) as confidence, n_chars as support from documents where n_chars >= 1000")
def _(spark, sf):
    d = table(spark, sf, "documents").selectExpr("doc_id", "least(cast(1.0 as double), cast(n_chars as double) / 1500) as confidence", "n_chars as support")
    return N.concept_threshold(d, 0.5, 1000)


@query("explode_annotations", "select doc_id, unnest(['q', 't']) as tag, unnest([quality, toxic]) as value from labels")
def _(spark, sf):
    d = table(spark, sf, "labels").selectExpr("doc_id", "array(named_struct('tag', 'q', 'value', quality), named_struct('tag', 't', 'value', toxic)) as notes")
    return N.explode_annotations(d, "notes", "doc_id")


@query("split_sentences", r"""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as no from documents),
  s as (select doc_id, no, regexp_replace(array_to_string(regexp_extract_all(line, '[\p{L}\p{N}]+|[^\p{L}\p{N}\s]'), ' '), '([.!?]) ', '\1' || chr(10), 'g') as line from l),
  u as (select doc_id, no, unnest(string_split(line, chr(10))) as sentence from s)
  select doc_id, sentence, count(*) as n from u where sentence <> '' group by 1, 2""")
def _(spark, sf):
    d = spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return N.split_sentences(d, "text", "doc_id").groupBy("doc_id", "sentence").agg(F.count("*").alias("n"))


def _steps(c: str, *steps: tuple[str, str]) -> str:
    for pattern, stays in steps:
        c = f"regexp_replace({c}, '{pattern}', '{stays}', 'g')"
    return c


STRIPPED = _steps(
    "concat(chr(10), source, ' ', lang, 'x note ', chr(10), text, chr(10), chr(10), '== end &amp; more ==', chr(10))",
    ("<[^<>]+>", ""), (r"\[(?:https?|ftp)://\S+\s+([^\]]+)\]", r"\1"), (r"\[(?:https?|ftp)://\S+\]", ""), ("''{2,5}", ""),
    (r"(?m)^=+[ \t]*(.*?)[ \t]*=+[ \t]*$", r"\1"), (r"(?m)^[*#:;]+\s*", ""), ("__[A-Z]+__", ""),
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))


@query("strip_markup", f"select doc_id, trim(regexp_replace({STRIPPED}, '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10)) as plain from documents")
def _(spark, sf):
    wiki = F.concat(F.lit("{| class=w\n| a || {{b}}\n|}\n<!-- c -->'''"), "source", F.lit("''' [["), "lang", F.lit("|"), "lang",
                    F.lit("x]] {{t|{{u|1}}}}note <ref name=a>r</ref>\n"), "text", F.lit("\n<ref name=b/>\n== end &amp; more ==\n[[Kategória:X]]"))
    d = spread(table(spark, sf, "documents").select("doc_id", "text", "source", "lang"), "doc_id")
    return d.select("doc_id", N.strip_markup(wiki).alias("plain"))


LEMMAS_SQL = f"""select distinct lower(word) as s, substring(lower(word), 1, k) as lemma
  from (select distinct unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+')) as word from benchmark) b, (values (3), (4)) v(k) where length(word) > 5"""


@query("lemmatize_lookup", f"""with {V_TOKEN}, c as (select tok, count(*) as n from v_token group by 1), l as ({LEMMAS_SQL}),
  b as (select s, arg_max(lemma, length(lemma)) as lemma from l group by 1)
  select tok, n, case when length(tok) = 7 and tok in (select s from l) then tok else coalesce(lemma, tok) end as lemma from c left join b on s = tok""")
def _(spark, sf):
    w = bench_words(spark, sf).filter("length(word) > 5")
    lemmas = w.select(F.col("word").alias("surface"), F.explode(F.array(*[F.substring(F.lower("word"), 1, k) for k in (3, 4)])).alias("lemma"))
    counts = A.word_count(token_array(spark, sf), "toks", "tok", "n")
    return N.lemmatize_lookup(counts, lemmas, w.filter("length(word) = 7"))


# ---- similarity

ALPHA_STOP = ("the", "of", "and", "de")


def alpha_bag(spark, sf, name: str, key: str):
    d = spread(table(spark, sf, name).select(key, "text"), key)
    return A.bag_of_words(d.select(key, E.alpha_tokens(F.col("text"), ALPHA_STOP).alias("toks")), key, "toks")


def bag_sql(name: str, key: str) -> str:
    return rf"""select {key}, tok as term, count(*) as tf from (select {key}, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) as tok from {name}) t
    where regexp_full_match(tok, '\p{{L}}+') and tok not in {ALPHA_STOP} group by 1, 2"""


def tfidf_sql(name: str, key: str) -> str:
    return f"""bag as ({bag_sql(name, key)}), idf as (select term, log2((select count(*) from {name}) / count(*)) as idf from bag group by 1),
  raw as (select bag.*, idf, tf * idf as rw from bag join idf using (term) where idf > 0),
  tfidf as (select {key}, term, tf, idf, rw / sqrt(sum(rw * rw) over (partition by {key})) as w from raw)"""


@query("tfidf", f"with {tfidf_sql('documents', 'doc_id')} select doc_id, term, tf, round(w, 6) as w from tfidf")
def _(spark, sf):
    return E.tfidf(alpha_bag(spark, sf, "documents", "doc_id"), table(spark, sf, "documents")).select("doc_id", "term", "tf", F.round("w", 6).alias("w"))


@query("esa_top_concepts", f"""with {tfidf_sql('benchmark', 'item_id')}, d as ({bag_sql('documents', 'doc_id')}),
  v as (select doc_id, term, tf * idf as dw from d join (select distinct term, idf from tfidf) i using (term)),
  u as (select doc_id, term, dw / sqrt(sum(dw * dw) over (partition by doc_id)) as dw from v),
  s as (select doc_id, item_id, sum(dw * w) as score from u join tfidf using (term) group by 1, 2)
  select doc_id, item_id, round(score, 6) as score, rank from (select *, cast(row_number() over (partition by doc_id order by round(score, 9) desc, item_id) as int) as rank from s) r
  where rank <= 10""")
def _(spark, sf):
    concepts = E.tfidf(alpha_bag(spark, sf, "benchmark", "item_id"), table(spark, sf, "benchmark"), "item_id")
    top = E.esa_top_concepts(alpha_bag(spark, sf, "documents", "doc_id"), concepts)
    return top.select("doc_id", "item_id", F.round("score", 6).alias("score"), "rank")


# ---- topic model

@lru_cache(maxsize=4)
def _words(spark, sf: str):
    """(words of each document, vocabulary with frequencies), each stored once."""
    docs = save_table(token_array(spark, sf), "topic-tokens").rows
    return docs, save_table(vocabulary(spark, sf, docs=docs), "topic-vocabulary").rows


@lru_cache(maxsize=4)
def _model(spark, sf: str, k: int = 24):
    """(vocabulary table, vectors, fitted model) of the documents; the model queries share it."""
    docs, counts = _words(spark, sf)
    vocab = cut_lineage(TM.index_vocabulary(counts))
    vectors = TM.index_vectors(docs, vocab)
    return vocab, vectors, TM.fit_lda(vectors, k, size=vocab.count())


@query("vectorize", f"""with {V_TOKEN}, v as (select term, row_number() over (order by freq desc, term) - 1 as idx from ({VOCAB_SQL}) f)
  select doc_id, idx, tok as term, count(*) as tf from v_token join v on tok = term group by 1, 2, 3""")
def _(spark, sf):
    return TM.term_vectors(token_array(spark, sf), TM.index_vocabulary(vocabulary(spark, sf)))


@query("fit_lda", f"""with {V_TOKEN} select cast(range as int) as topic, (select count(*) from ({VOCAB_SQL}) v) as words, 1.0::double as weight
  from range(24)""")
def _(spark, sf):
    vocab, _, model = _model(spark, sf)
    return TM.topic_words(model, vocab).groupBy("topic").agg(F.count("*").alias("words"), F.round(F.sum("weight"), 6).alias("weight"))


@query("topic_distribution")
def _(spark, sf):
    _, vectors, model = _model(spark, sf)
    return TM.topic_distribution(model, vectors)


@query("topic_distribution_sums", f"""with {V_TOKEN}, d as (select distinct doc_id from v_token where tok in (select term from ({VOCAB_SQL}) v))
  select doc_id, cast(24 as bigint) as topics, case when doc_id in (select doc_id from d) then 1.0 else 0.0 end::double as prob
  from documents where text is not null""")
def _(spark, sf):
    _, vectors, model = _model(spark, sf)
    every = TM.topic_distribution(model, vectors, min_prob=0)
    return every.groupBy("doc_id").agg(F.count("*").alias("topics"), F.round(F.sum("prob"), 6).alias("prob"))


@query("topic_top_words_facts", f"""with {V_TOKEN} select cast(range as int) as topic, least(40, (select count(*) from ({VOCAB_SQL}) v)) as words,
    least(40, (select count(*) from ({VOCAB_SQL}) v)) as known, 0::bigint as rising from range(24)""")
def _(spark, sf):
    """Per topic: words, those of the vocabulary, and ranks that weigh more than the rank before."""
    vocab, _, model = _model(spark, sf)
    top = TM.topic_top_words(model, vocab).join(_words(spark, sf)[1], "term", "left")
    rise = F.col("weight") > F.lag("weight").over(Window.partitionBy("topic").orderBy("rank"))  # 40 rows a topic
    return top.withColumn("up", rise).groupBy("topic").agg(F.count("*").alias("words"), F.count("freq").alias("known"), F.count_if("up").alias("rising"))


@query("topic_relevance_facts", f"""with {V_TOKEN} select (select count(*) from ({VOCAB_SQL}) v) * 24 as rows, 24::bigint as topics, 1.0::double as prevalence, 0::bigint as wrong""")
def _(spark, sf):
    """All words of all topics; prevalences sum to one; the formula computed anew from the returned weights and the counts."""
    vocab, vectors, model = _model(spark, sf)
    counts = _words(spark, sf)[1]
    rows = TM.topic_relevance(model, vocab, counts, TM.topic_distribution(model, vectors, min_prob=0), TM.vector_lengths(vectors))
    again = rows.join(counts, "term").withColumn("p", F.col("freq") / counts.agg(F.sum("freq")).scalar())
    off = F.abs(F.col("relevance") - F.log("weight") + 0.4 * F.log("p")) > 1e-6
    per = again.groupBy("topic").agg(F.count("*").alias("n"), F.max("prevalence").alias("share"), F.count_if(off).alias("off"))
    return per.agg(F.sum("n").alias("rows"), F.count("*").alias("topics"), F.round(F.sum("share"), 6).alias("prevalence"), F.sum("off").alias("wrong"))


@query("topic_top_words")
def _(spark, sf):
    vocab, _, model = _model(spark, sf)
    return TM.topic_top_words(model, vocab)


@query("topic_relevance")
def _(spark, sf):
    vocab, vectors, model = _model(spark, sf)
    return TM.topic_relevance(model, vocab, _words(spark, sf)[1], TM.topic_distribution(model, vectors), TM.vector_lengths(vectors))


# ---- topic model whose topics × words stay in tables: what its counts must sum to holds for any start and any number of steps

def topic_tables(spark, sf: str, steps: int):
    docs, vocab = _words(spark, sf)
    bag = A.bag_of_words(docs, "doc_id", "toks")
    return TT.fit_topic_tables(bag, TM.index_vocabulary(vocab), steps=steps)


@query("topic_table_words", f"""with {V_TOKEN} select term, freq, cast(24 as int) as topics, true as positive from ({VOCAB_SQL}) v""")
def _(spark, sf):
    """Per word the expected counts of all topics, which sum to its frequency in the corpus; the learnt prior is positive."""
    mass = F.aggregate("lam", F.lit(0.0), lambda a, x: a + x - F.col("eta"))
    return topic_tables(spark, sf, 3).words.select("term", F.round(mass).cast("long").alias("freq"), F.size("lam").alias("topics"), (F.col("eta") > 0).alias("positive"))


@query("topic_table_documents", f"""with {V_TOKEN} select doc_id, count(*) as words, cast(24 as bigint) as topics, 1.0::double as prob
  from v_token join ({VOCAB_SQL}) v on tok = term group by 1""")
def _(spark, sf):
    """Per document the expected counts of all topics, which sum to its words of the vocabulary, and the sum of its shares."""
    model = topic_tables(spark, sf, 2)
    shares = TT.document_topics(model).groupBy("doc_id").agg(F.count("*").alias("topics"), F.round(F.sum("prob"), 6).alias("prob"))
    mass = F.aggregate("gamma", F.lit(-sum(model.alpha)), lambda a, g: a + g)
    return model.docs.select("doc_id", F.round(mass).cast("long").alias("words")).join(shares, "doc_id")


def source_words(spark, sf: str):
    """Sources as topics: the share of every word in the words of a source."""
    toks = table(spark, sf, "documents").select(F.col("source").alias("topic"), words(F.lower("text")).alias("toks"))
    counts = unnest(toks, "topic", term="toks").groupBy("topic", "term").agg(F.count("*").alias("n"))
    totals = counts.groupBy("topic").agg(F.sum("n").alias("total"))
    return counts.join(totals, "topic").select("topic", "term", (F.col("n") / F.col("total")).alias("weight"))


@query("topic_distances", r"""with c as (select source, tok, count(*) as n from (select source, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+', 0)) as tok from documents) t group by 1, 2),
  p as (select source, tok, n / sum(n) over (partition by source) as p from c), s as (select distinct source from p),
  e as (select a.source as a, b.source as b, tok, coalesce(max(p) filter (where p.source = a.source), 0) as x, coalesce(max(p) filter (where p.source = b.source), 0) as y
    from s a join s b on a.source < b.source join p on p.source in (a.source, b.source) group by 1, 2, 3)
  select a, b, round(sum(case when x > 0 then x * ln(2 * x / (x + y)) else 0 end + case when y > 0 then y * ln(2 * y / (x + y)) else 0 end) / 2, 9) as distance from e group by 1, 2""")
def _(spark, sf):
    return TT.topic_distances(source_words(spark, sf)).select("a", "b", F.round("distance", 9).alias("distance"))


@query("topic_map")
def _(spark, sf):
    return TT.topic_map(TT.topic_distances(source_words(spark, sf)))


EDGES_SQL = """with t as (select vec_id as doc_id, cast(generate_subscripts(embedding, 1) - 1 as int) as topic, unnest(embedding) as prob from embeddings),
  r as (select doc_id, topic from (select *, row_number() over (partition by doc_id order by prob desc, topic) as rn from t) x where rn <= 3),
  p as (select a.topic as s, b.topic as t, count(*) as n from r a join r b on a.doc_id = b.doc_id and a.topic < b.topic group by 1, 2)
  select lpad(cast(a.i as string), 2, '0') as source, lpad(cast(b.i as string), 2, '0') as target, coalesce(n, 0) as weight
  from range(64) a(i) join range(64) b(i) on a.i < b.i left join p on p.s = a.i and p.t = b.i"""


@query("topic_edges", EDGES_SQL)
def _(spark, sf):
    from rostrum.plans.records import topic_probs

    return TM.topic_edges(topic_probs(spark, sf), 64)


ARTICLE = _steps(
    r"regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[\x00-\x08\x0b\x0c\x0e-\x1f]', ' ', 'g')",
    ("<[^<>]+>", ""), (r"\[(?:https?|ftp)://\S+\s+([^\]]+)\]", r"\1"), (r"\[(?:https?|ftp)://\S+\]", ""), ("''{2,5}", ""),
    (r"(?m)^=+[ \t]*(.*?)[ \t]*=+[ \t]*$", r"\1"), (r"(?m)^[*#:;]+\s*", ""), ("__[A-Z]+__", ""),
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))


@query("wiki_articles", rf"""with p as (select doc_id, source, text from documents where not contains(source, ':') and length(trim(text)) > 0),
  l as (select doc_id, unnest(string_split({ARTICLE}, chr(10))) as line, generate_subscripts(string_split({ARTICLE}, chr(10)), 1) as no from p),
  s as (select doc_id, no, string_split(regexp_replace(array_to_string(regexp_extract_all(line, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s]'), ' '), '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) as part from l),
  u as (select doc_id, no, unnest(part) as sentence, generate_subscripts(part, 1) as i from s),
  t as (select doc_id, string_agg(sentence, chr(10) order by no, i) as content from u where sentence <> '' group by 1)
  select doc_id as id, source as title, coalesce(content, '') as content from p left join t using (doc_id)""")
def _(spark, sf):
    """Dump → articles → plain sentences → JSON."""
    dump, out = scratch_path(spark, "dump"), scratch_path(spark, "articles")
    text = F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ")  # XML has no control characters
    d = table(spark, sf, "documents").withColumn("text", text).selectExpr(
        "doc_id as id", "source as title", "named_struct('text', named_struct('_VALUE', text, '_bytes', '1')) as revision")
    d.write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").save(dump)
    write_wiki_json(N.plain_articles(read_wiki_dump(spark, dump)), out)
    return spark.read.schema("id bigint, title string, content string").json(out)
