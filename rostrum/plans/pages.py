"""Registered queries: page extraction. Links come from the given pages; the parliament's page layouts are built around the
given texts, so that every expected value is known from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rostrum.operators import html as H
from rostrum.operators.ordered import carry_topic_forward
from rostrum.operators.rows import spread
from rostrum.plans.registry import query, table

ESC = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def built(spark, sf, html: str, *keep: str, url: str = "concat('http://x/dir/', doc_id, '.htm')") -> DataFrame:
    d = spread(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    return d.selectExpr("doc_id", f"{url} as url", f"{html} as html", *keep)


def plain(c: str) -> str:
    """Entities of the given pages as characters."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        c = f"replace({c}, '{name}', '{char}')"
    return c


CLEAN = r"regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>', '', 'g')"
V_ANCHOR = f"""v_anchor as (select page_id, url, cast(generate_subscripts(h, 1) - 1 as int) as pos, unnest(h) as href, {plain('unnest(t)')} as anchor from (
  select page_id, url, regexp_extract_all({CLEAN}, '<a href="([^"]*)">([^<]*)</a>', 1) as h, regexp_extract_all({CLEAN}, '<a href="([^"]*)">([^<]*)</a>', 2) as t from pages) x)"""


@query("extract_links", f"with {V_ANCHOR} select page_id, pos, {plain('href')} as href, anchor from v_anchor")
def _(spark, sf):
    return H.extract_links(spread(table(spark, sf, "pages"), "page_id"), "page_id")


@query("link_by_text", f"with {V_ANCHOR} select page_id, {plain('arg_min(href, pos)')} as href from v_anchor where anchor in ('la', 'the', 'The') group by 1")
def _(spark, sf):
    return H.link_by_text(table(spark, sf, "pages"), ["la", "the", "The"], "page_id")


@query("quarantine_blocked", "select page_id, 'parse' as state from pages where not contains(url, 'spam') union all select page_id, 'blocked' from pages where contains(url, 'spam')")
def _(spark, sf):
    p = table(spark, sf, "pages").selectExpr("page_id", "case when contains(url, 'spam') then concat(html, '<p>CAPTCHA') else html end as html")
    good, bad = H.quarantine_blocked(p)
    return good.select("page_id", F.lit("parse").alias("state")).unionByName(bad.select("page_id", F.lit("blocked").alias("state")))


@query("extract_page_text", """select doc_id, 40 as term, concat(text, 'x', source) as text from documents
  union all select doc_id, 34, trim(array_to_string(list_filter(string_split(text, chr(10)), lambda x: len(x) > 0), ' ')) from documents""")
def _(spark, sf):
    new = built(spark, sf, f"""concat('<html><body><div class="pair-content"><div id="egy_felszolalas"><table><tr><td>', source, '</td></tr></table></div><div>',
      {ESC}, '</div><div><script>var a="</div>";</script><b>x</b>', source, '</div></div><div>', lang, '</div></body></html>')""")
    old = built(spark, sf, f"concat('<html><body><pre>', source, '</pre><p>', replace({ESC}, chr(10), '<p>'), '</body></html>')")
    return (H.extract_page_text(new, 40, "doc_id").withColumn("term", F.lit(40))
            .unionByName(H.extract_page_text(old, 34, "doc_id").withColumn("term", F.lit(34))))


@query("extract_header", "select doc_id, case when doc_id % 3 <> 0 then concat('- Elnök: ', source, ' -') end as header from documents")
def _(spark, sf):
    p = built(spark, sf, "concat('<html><body>', case when doc_id % 3 <> 0 then concat('<pre>', chr(10), ' - Elnök: ', source, ' -', chr(10), '</pre>') else '' end, '<p>', lang, '</body></html>')")
    return H.extract_header(p, "doc_id")


def sitting_page(extra: str) -> str:
    """A sitting table with one linked row and one row without link."""
    return f"""concat('<table><thead><tr><th>Dátum</th></tr></thead><tbody><tr><td><a href="/n/', doc_id, '">2018.05.08.(', doc_id, ')</a></td><td> kedd </td>', {extra},
      '<td>tavaszi</td><td>rendes</td><td>1</td><td><a href="#">8:00</a></td><td>9:', lang, '</td><td>12</td><td>3</td><td>', source, '</td></tr><tr><td>összesen</td><td>9</td></tr></tbody></table>')"""


@query("parse_sitting_list", """select doc_id, term, concat(term, '-', doc_id) as sitting_uid, '2018.05.08.' as date, 'kedd' as day, 'rendes' as type,
    '8:00' as duration_raw, concat('9:', lang) as duration, '12' as sitting_id, '3' as sitting_day, case when term <> '34' then source end as note,
    case when term = '40' then concat('v', doc_id) end as video_time,
    case when term = '34' then concat('/n/', doc_id) else concat('https://www.parlament.hu/internet/cplsql/ogy_naplo.ulnap_felszo?p_lista=f&p_nap=', doc_id, '&p_ckl=', term) end as toc_url
  from documents, (values ('34'), ('36'), ('37'), ('40')) t(term)""")
def _(spark, sf):
    video = """concat('<td><a href="/v">v', doc_id, '</a></td>')"""
    parts = [H.parse_sitting_list(built(spark, sf, sitting_page(video if t > 36 else "''")), t, "doc_id") for t in (34, 36, 37, 40)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("doc_id", "term", "sitting_uid", "date", "day", "type", "duration_raw", "duration", "sitting_id", "sitting_day", "note",
                      "video_time", "toc_url")


@query("parse_sitting_toc", """with s as (select doc_id, source, lang, unnest(range(1, 3 + doc_id % 3)) as idx from documents)
  select concat('40-', doc_id, '-', idx) as id, cast(idx as int) as idx, case when idx = 1 then 'vezérszónok' else lang end as type,
    case when idx = 1 then 'Bizottság' end as committee, case doc_id % 3 when 0 then source when 1 then concat(source, '|', lang, ' x') else source end as topic,
    case when doc_id % 3 = 2 then concat('T/', doc_id, '  ', lang) else '' end as bills,
    case when doc_id % 3 = 2 then concat('http://x/b?i=', doc_id) else '' end as bill_urls,
    concat('https://www.parlament.hu/internet/cplsql/ogy_naplo.naplo_fadat?p_ckl=40&p_uln=', doc_id, '&p_felsz=', idx, '&p_szoveg=&p_felszig=', idx) as url from s""")
def _(spark, sf):
    head = """case doc_id % 3 when 0 then concat(' ', source, ' ') when 1 then concat(source, ' <br>"', lang, '<br>x"')
      else concat(source, ' <a href="/b?i=', doc_id, '">T/', doc_id, '</a> ', lang) end"""
    p = built(spark, sf, f"""concat('<html><body><div class="pair-content"><table><thead><tr><th>', {head}, '</th></tr></thead><tbody>',
      '<tr><td><a href="a">1</a></td><td>n</td><td>vezérszónok</td><td><b>Bizottság</b></td><td>9:01</td></tr><tr><td>nincs</td></tr>',
      '<tr><td><a href="b"> 2-', 2 + doc_id % 3, ' </a></td><td>n</td><td>', lang, '</td><td></td><td>9:02</td></tr></tbody></table></div></body></html>')""",
              "40 as term", "cast(doc_id as string) as sitting_nr", "concat('40-', doc_id) as sitting_uid", url="'http://x/toc'")
    out = H.parse_sitting_toc(p)
    return out.select("id", "idx", "type", "committee", F.array_join("topic", "|").alias("topic"), F.array_join("bill_title", "|").alias("bills"),
                      F.array_join("bill_url", "|").alias("bill_urls"), "url")


ITEMS = r"""regexp_extract_all(regexp_replace(html, '(?s)<script.*?</script>', '', 'g'), '<li><a href="([^"]*)">', 1)"""


@query("parse_toc_list_34", f"""select page_id, cast(generate_subscripts(h, 1) as int) as idx, strip_accents({plain('unnest(h)')}) as path
  from (select page_id, {ITEMS} as h from pages) t""")
def _(spark, sf):
    out = H.parse_toc_list_34(spread(table(spark, sf, "pages"), "page_id"), "page_id")
    path = F.regexp_replace("url", "^https?://[^/]*", "")
    return out.select("page_id", "idx", F.regexp_replace(path, r"\p{M}", "").alias("path"))


LIST_35 = """concat('<ul><li><a href="1.htm">1</a> ', upper(lang), ': [05:1', doc_id % 10, ' perc]<h4>', source, ' (<a href="b?', doc_id, '">bill</a>)</h4></li>',
  '<li>only text<h4>ignored</h4></li><li><a href="3.htm">3</a> <a href="k?a">', source, ' </a> (12:34) </li><li><a href="4.htm">4</a> ', lang, ' :<h4>next (</h4></li>',
  '<li><a href="5.htm">5</a> <a href="k?b">N</a>', chr(10), '</li></ul>')"""


@query("parse_toc_list_35", """select doc_id, unnest([1, 3, 4, 5]) as idx, unnest(['1', '3', '4', '5']) || '.htm' as file, unnest([upper(lang), source, lang, 'N']) as speaker,
  unnest([concat('05:1', doc_id % 10), '12:34', null, null]) as duration, unnest(['', source, source, 'next']) as topic,
  unnest(['', concat('http://x/dir/b?', doc_id), concat('http://x/dir/b?', doc_id), '']) as bill_url from documents""")
def _(spark, sf):
    rows = H.parse_toc_list_35(built(spark, sf, LIST_35), "doc_id")
    rows = carry_topic_forward(rows, "doc_id", "idx", "next_topic", url="next_topic_url")
    return rows.select("doc_id", "idx", F.substring_index("url", "/", -1).alias("file"), "speaker", "duration", "topic", "bill_url")


@query("parse_speech_page", """select doc_id, 40 as term, source as speaker, case when doc_id % 2 = 0 then upper(lang) end as speaker_party,
    concat('http://x/k?p_azon=', source) as speaker_url, '05:10' as duration, '/v' as video_url, text, concat('http://x/dir/p', doc_id) as prev_speech_url, null as next_speech_url, null as header from documents
  union all select doc_id, 35, null, null, null, null, null, array_to_string(list_filter(string_split(text, chr(10)), lambda x: len(x) > 0), ' '),
    null, concat('http://x/dir/n', doc_id), source from documents""")
def _(spark, sf):
    new = built(spark, sf, f"""concat('<html><body><div class="pair-content"><div id="egy_felszolalas"><table><tr><td>h</td></tr><tr><td>Felszólaló</td><td><a href="/k?p_azon=', source, '">',
      source, case when doc_id % 2 = 0 then concat(' (', upper(lang), ') ') else '' end, '</a></td></tr><tr><td>3</td></tr><tr><td>4</td></tr><tr><td>5</td></tr>',
      '<tr><td>6</td><td><a href="/v">05:10</a></td></tr></table></div><div>', {ESC}, '</div></div><a href="p', doc_id, '">Előző</a></body></html>')""")
    old = built(spark, sf, f"""concat('<html><body><pre> ', source, chr(10), '</pre><p>', replace({ESC}, chr(10), '<p>'), '<div><a href="n', doc_id, '">Következõ</a></div></body></html>')""")
    return (H.parse_speech_page(new, 40, "doc_id").withColumn("term", F.lit(40))
            .unionByName(H.parse_speech_page(old, 35, "doc_id").withColumn("term", F.lit(35))))


@query("parse_bill_page", "select doc_id, source as bill_title, trim(array_to_string(list_filter(string_split(text, chr(10)), lambda x: len(x) > 0), ' ')) as bill_details from documents")
def _(spark, sf):
    p = built(spark, sf, f"concat('<html><body><h1>x</h1><h2> ', source, ' </h2><p>', replace({ESC}, chr(10), '</p><p>'), '</p></body></html>')")
    return H.parse_bill_page(p, "doc_id")
