"""Registered queries: scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rostrum.functions import text as X
from rostrum.operators.project import clean_speech
from rostrum.plans.registry import query, table
from rostrum.plans.views import V_DOC, V_LEMMA, V_LINK, docs, lemmas, links


def _raw(spark, sf, expr: str, *keep: str) -> DataFrame:
    """Documents with a column ``raw`` stated in SQL that both engines read alike."""
    return table(spark, sf, "documents").selectExpr("doc_id", f"{expr} as raw", *keep)


def _sql(expr: str, select: str) -> str:
    return f"with r as (select doc_id, text, lang, source, {expr} as raw from documents) select doc_id, {select} from r"


@query("smart_truncate", r"""select doc_id, case when length(text) <= 250 then text
  else concat(regexp_replace(substring(text, 1, 250), ' [^ ]*\z', ''), '...') end as short from documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.smart_truncate("text").alias("short"))


NAME_PARTY = """case doc_id % 4 when 0 then concat(lang, ' Elek (', lang, ' x) tail') when 1 then source
  when 2 then concat(lang, '-B.(', upper(lang), ')') else concat('(', lang, ')') end"""


@query("split_name_party", _sql(NAME_PARTY, r"""
  case when regexp_matches(raw, '^[\p{L}\s.\-]+\([\p{L}\s]+\)') then trim(regexp_extract(raw, '^([\p{L}\s.\-]+)\(', 1)) else raw end as name,
  case when regexp_matches(raw, '^[\p{L}\s.\-]+\([\p{L}\s]+\)') then trim(regexp_extract(raw, '^[\p{L}\s.\-]+\(([\p{L}\s]+)\)', 1)) end as party"""))
def _(spark, sf):
    return _raw(spark, sf, NAME_PARTY).select("doc_id", X.split_name_party("raw").alias("s")).select("doc_id", "s.*")


SPEAKER_PARTY = """case doc_id % 3 when 0 then concat(source, ' (', lang, ') x') when 1 then source
  else concat(source, ' (', lang) end"""


@query("split_speaker_party", _sql(SPEAKER_PARTY, """
  case when instr(raw, '(') > 0 then trim(split_part(raw, '(', 1)) else raw end as speaker,
  case when instr(raw, '(') > 0 then split_part(split_part(raw, '(', 2), ')', 1) end as party"""))
def _(spark, sf):
    return (_raw(spark, sf, SPEAKER_PARTY).select("doc_id", X.split_speaker_party("raw").alias("s"))
            .select("doc_id", "s.*"))


CLEAN = """case doc_id % 5 when 0 then concat(' ', source, ' (', upper(lang), '): ') when 1 then concat('Elnök (', source, ')')
  when 2 then concat(source, ':') when 3 then concat('(', lang, ')') else concat('Dr. ', source, ' ( ', lang, ' ) x') end"""


@query("clean_speaker", _sql(CLEAN, r"""
  case when regexp_matches(s, '[^(]+\([^)]+\)') then case when lower(a) = 'elnök' then b else a end else s end as speaker,
  case when regexp_matches(s, '[^(]+\([^)]+\)') and lower(a) = 'elnök' then 'Elnök' end as title,
  case when regexp_matches(s, '[^(]+\([^)]+\)') and lower(a) <> 'elnök' then b end as party""").replace(
    "from r", r"""from (select *, trim(regexp_extract(s, '([^(]+)\(([^)]+)\)', 1)) as a,
    trim(regexp_extract(s, '([^(]+)\(([^)]+)\)', 2)) as b from (select *, trim(raw, ' :') as s from r) t1) t2"""))
def _(spark, sf):
    return (_raw(spark, sf, CLEAN).select("doc_id", X.clean_speaker("raw").alias("s"))
            .select("doc_id", "s.speaker", "s.title", "s.party"))


HEADER = """case doc_id % 4 when 0 then '(x - Elnök: Név Elek. - jegyző)' when 1 then concat('Ma az Az elnöki széket ', source, ' foglalja el')
  when 2 then null else lang end"""
ROLE = "case doc_id % 3 when 0 then 'elnök' when 1 then 'Elnök' else source end"


@query("chair_from_header", _sql(HEADER, f"""
  case when lower({ROLE}) = 'elnök' and doc_id % 4 = 0 then 'Név Elek' when lower({ROLE}) = 'elnök' and doc_id % 4 = 1 then source
    else {ROLE} end as speaker,
  case when lower({ROLE}) = 'elnök' and raw is not null then {ROLE} end as title"""))
def _(spark, sf):
    return (_raw(spark, sf, HEADER, f"{ROLE} as role").select("doc_id", X.chair_from_header("role", "raw").alias("s"))
            .select("doc_id", "s.*"))


UPPER = "case doc_id % 3 when 0 then upper(concat(source, ' ', lang, '-x')) when 1 then source else concat(upper(lang), ' b') end"


@query("titlecase_upper", _sql(UPPER, r"""case when raw = upper(raw) and raw <> lower(raw) then
  array_to_string(list_transform(regexp_extract_all(raw, '\p{L}+|[^\p{L}]+'), lambda x: concat(upper(x[1]), lower(x[2:]))), '')
  else raw end as name"""))
def _(spark, sf):
    return _raw(spark, sf, UPPER).select("doc_id", X.titlecase_upper("raw").alias("name"))


FROM_TEXT = """case doc_id % 3 when 0 then concat(upper(lang), ' ELEK,  ', lang, ' titkár : ', text)
  when 1 then concat(source, ': ', text) else text end"""


@query("speaker_from_text", _sql(FROM_TEXT, """
  case when doc_id % 7 = 0 then source when doc_id % 3 = 0 then concat(upper(lang[1]), lang[2], ' Elek') when doc_id % 3 = 1 then source
    when instr(raw, ':') > 0 then split_part(raw, ':', 1) when doc_id % 2 = 0 then ' ' end as speaker,
  case when doc_id % 7 <> 0 and doc_id % 3 = 0 then concat(lang, ' titkár') end as title"""))
def _(spark, sf):
    raw = _raw(spark, sf, FROM_TEXT, "case when doc_id % 7 = 0 then source when doc_id % 2 = 0 then ' ' end as speaker")
    return raw.select("doc_id", X.speaker_from_text("speaker", "raw").alias("s")).select("doc_id", "s.*")


CLEAN_TEXT = """concat('A felszólalás szövege:', chr(160), replace(text, '. ', concat('. ', chr(160), chr(13), chr(10), chr(10))), ' ', chr(10))"""


@query("clean_text", _sql(CLEAN_TEXT, r"""trim(regexp_replace(replace(replace(raw, 'A felszólalás szövege:', ''), chr(160), ' '),
  '[\s\p{Z}]*[\r\n]+', chr(10), 'g'), concat(' ', chr(10))) as clean"""))
def _(spark, sf):
    return _raw(spark, sf, CLEAN_TEXT).select("doc_id", X.clean_text("raw").alias("clean"))


@query("strip_bill_titles", """select doc_id, array_to_string(list_transform(string_split(text, chr(10)),
  lambda x: trim(concat(' ', x, ' '), concat(' ', chr(10)))), '|') as titles from documents""")
def _(spark, sf):
    lines = F.transform(F.split("text", "\n"), lambda x: F.concat(F.lit(" "), x, F.lit(" ")))
    return table(spark, sf, "documents").select("doc_id", F.array_join(X.strip_bill_titles(lines), "|").alias("titles"))


AZON = "case doc_id % 3 when 0 then concat('p_azon=', source, ' ') when 1 then source else concat('x p_azon=', source) end"


@query("speaker_id", _sql(AZON, "case when doc_id % 3 = 0 then source end as speaker_id"))
def _(spark, sf):
    return _raw(spark, sf, AZON).select("doc_id", X.speaker_id("raw").alias("speaker_id"))


BODY = "concat(source, chr(10), lang, chr(10), case when doc_id % 2 = 0 then concat(source, ': ') else '' end, text)"


@query("speech_body", _sql(BODY, """case when doc_id % 2 = 0 then concat(' ', text)
  else substring(text, instr(text, ':') + 1) end as body"""))
def _(spark, sf):
    return _raw(spark, sf, BODY).select("doc_id", X.speech_body("raw").alias("body"))


@query("date_and_number", f"""with {V_DOC} select doc_id, date_filter as date_text, date,
  cast(doc_id % 300 as string) as nr from v_doc""")
def _(spark, sf):
    raw = F.concat("date_filter", F.lit("("), (F.col("doc_id") % 300).cast("string"), F.lit(") ülésnap"))
    return docs(spark, sf).select("doc_id", X.date_and_number(raw).alias("s")).select("doc_id", "s.*")


@query("term_years", """select doc_id, cast(1990 + (doc_id % 9) * 4 as int) as start_year,
  cast(case when 34 + doc_id % 9 < 41 then 1994 + (doc_id % 9) * 4 end as int) as end_year from documents""")
def _(spark, sf):
    s = X.term_years(F.lit(34) + F.col("doc_id") % 9)
    return table(spark, sf, "documents").select("doc_id", s["start"].alias("start_year"), s["end"].alias("end_year"))


RANGE = """case doc_id % 4 when 0 then concat(cast(doc_id as string), '-', cast(doc_id + 3 as string)) when 1 then cast(doc_id as string)
  when 2 then concat(' ', cast(doc_id as string), '-', cast(doc_id - 1 as string)) else lang end"""


@query("expand_id_range", """select doc_id, cast(unnest(case doc_id % 4 when 0 then range(doc_id, doc_id + 4) when 1 then [doc_id]
  else [] end) as int) as nr from documents""")
def _(spark, sf):
    return _raw(spark, sf, RANGE).select("doc_id", F.explode(X.expand_id_range("raw")).alias("nr"))


@query("build_speech_url", f"""with {V_DOC} select doc_id, concat(
  'https://www.parlament.hu/internet/cplsql/ogy_naplo.naplo_fadat?p_ckl=', term, '&p_uln=', doc_id % 300,
  '&p_felsz=', doc_id, '&p_szoveg=&p_felszig=', doc_id) as url from v_doc""")
def _(spark, sf):
    url = X.build_speech_url("term", F.col("doc_id") % 300, "doc_id")
    return docs(spark, sf).select("doc_id", url.alias("url"))


@query("resolve_url", rf"""with {V_LINK} select page_id, href,
  concat(regexp_extract(url, '^https?://[^/?#]+'), href) as target from v_link""")
def _(spark, sf):
    return links(spark, sf).select("page_id", "href", X.resolve_url("url", "href").alias("target"))


# DuckDB has no compatibility decomposition; the letters left without their marks can be compared.
@query("nfkd", f"with {V_LINK} select page_id, href, strip_accents(href) as base from v_link")
def _(spark, sf):
    return links(spark, sf).select("page_id", "href", F.regexp_replace(X.nfkd("href"), r"\p{M}", "").alias("base"))


URI = "concat(source, '+', lang, '%C3%A9%zz/', cast(doc_id as string), '%')"


@query("uri_decode", _sql(URI, "concat(source, ' ', lang, 'é%zz/', cast(doc_id as string), '%') as uri"))
def _(spark, sf):
    return _raw(spark, sf, URI).select("doc_id", X.uri_decode("raw").alias("uri"))


@query("uri_tail", "select page_id, regexp_extract(url, '[^/]*$') as tail from pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.uri_tail("url").alias("tail"))


TYPES = """case doc_id % 5 when 0 then concat('Schema:X,DBpedia:Place,DBpedia:', lang) when 1 then '' when 2 then 'Schema:Y'
  when 3 then 'DBpedia:A:B,Schema:Z' else null end"""


@query("concept_category", _sql(TYPES, "case doc_id % 5 when 0 then lang when 3 then 'B' end as category"))
def _(spark, sf):
    return _raw(spark, sf, TYPES).select("doc_id", X.concept_category("raw").alias("category"))


@query("lemma_pos", rf"""with {V_LEMMA} select regexp_extract(lemma_pos, '^(.*)_([^_]*)$', 1) as lemma,
  regexp_extract(lemma_pos, '^(.*)_([^_]*)$', 2) as pos, count(*) as n from v_lemma group by 1, 2""")
def _(spark, sf):
    parts = lemmas(spark, sf).select(X.lemma_pos("lemma_pos").alias("s")).select("s.*")
    return parts.groupBy("lemma", "pos").agg(F.count("*").alias("n"))


ACCENTS = "translate(text, 'ouOU', 'õûÕÛ')"


@query("fix_accents", "select doc_id, translate(text, 'ouOU', 'őűŐŰ') as text from documents")
def _(spark, sf):
    return _raw(spark, sf, ACCENTS).select("doc_id", X.fix_accents("raw").alias("text"))


@query("lc_norm", "select doc_id, lower(translate(text, 'ouOU', 'őűŐŰ')) as text from documents")
def _(spark, sf):
    return _raw(spark, sf, ACCENTS).select("doc_id", X.lc_norm("raw").alias("text"))


@query("ascii_fold", "select doc_id, replace(strip_accents(lower(text)), 'ß', 'ss') as folded from documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.ascii_fold(F.lower("text")).alias("folded"))


@query("topic_label", """select doc_id, concat('Topic ', case when doc_id % 120 < 10 then '0' else '' end,
  cast(doc_id % 120 as string)) as label from documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.topic_label(F.col("doc_id") % 120).alias("label"))


@query("topic_or_pair", """select doc_id, case when doc_id % 3 = 0 then source when doc_id % 2 = 0 then source
  else concat(source, '|', lang, ' ', text_head) end as topic
  from (select *, rtrim(regexp_extract(text, '^[^."]*')) as text_head from documents) t""")
def _(spark, sf):
    head = F.regexp_extract("text", '^[^."]*', 0)
    texts = F.when(F.col("doc_id") % 3 == 0, F.array(F.concat(F.lit("\n "), "source"))).otherwise(
        F.array(F.concat(F.lit(" "), "source"), F.concat(F.lit('\r\n "'), "lang"), F.concat(head, F.lit('" \n'))))
    topic = X.topic_or_pair(texts, F.col("doc_id") % 2 == 0)
    return table(spark, sf, "documents").select("doc_id", F.array_join(topic, "|").alias("topic"))


SPEAKER_RAW = """case doc_id % 5 when 0 then ' Elnök:' when 1 then concat('ELNÖK (', source, ') :') when 2 then upper(source)
  when 3 then concat(source, ' ( P', cast(doc_id % 4 as string), ' ):') else concat(' ', source, ' : ') end"""
HEADER_RAW = "case doc_id % 2 when 0 then concat('Ülés - Elnök: ', source, 'x - jegyzők') else concat('Az elnöki széket ', source, 'y foglalja el') end"


@query("clean_speech", rf"""select doc_id, case doc_id % 5 when 0 then concat(source, case doc_id % 2 when 0 then 'x' else 'y' end)
    when 2 then concat(upper(source[1]), lower(source[2:])) else source end as speaker, case when doc_id % 5 < 2 then 'Elnök' end as speaker_title,
    case when doc_id % 5 = 3 then concat('P', doc_id % 4) end as speaker_party,
    nullif(trim(regexp_replace(replace(replace({CLEAN_TEXT}, 'A felszólalás szövege:', ''), chr(160), ' '), '[\s\p{{Z}}]*[\r\n]+', chr(10), 'g'),
      concat(' ', chr(10))), '') as text, concat(source, '|', lang) as bills from documents""")
def _(spark, sf):
    """The whole chain from a raw record to the stored one."""
    raw = table(spark, sf, "documents").selectExpr("doc_id", f"{SPEAKER_RAW} as speaker", f"{HEADER_RAW} as header", f"{CLEAN_TEXT} as text",
                                                   "array(concat(' ', source, ' \n'), concat(lang, ' ')) as bill_title")
    return clean_speech(raw).select("doc_id", "speaker", "speaker_title", "speaker_party", "text", F.array_join("bill_title", "|").alias("bills"))
