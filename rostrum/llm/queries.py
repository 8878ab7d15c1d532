"""The registered queries of this subpackage, and the SQL that states the same result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rostrum.llm import covertree, divergence, importance, jaccard, licenses, main_text, nbest, packing, preference, quality_rules as rules, token_counts, toxicity, trie_codes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER_TEXT = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LOWER_WORDS = WORDS.format(LOWER_TEXT)

JACCARD_SQL = f"""with recursive w as (select doc_id, {LOWER_WORDS} as w from documents),
  s as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) end as s from w),
  n as (select doc_id, len(s) as n from s), g as (select doc_id, unnest(s) as g from s),
  pairs as (select a.doc_id as a, b.doc_id as b, count(*) as o from g a join g b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
  links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * o >= 90 * (x.n + y.n - o)),
  reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
  select n.doc_id, cast(n.n as bigint) as n_shingles, least(n.doc_id, coalesce(min(reach.b), n.doc_id)) as component_id
  from n left join reach on reach.a = n.doc_id group by n.doc_id, n.n"""


@query("op1_ngram_jaccard", JACCARD_SQL)
def _(spark, sf):
    return jaccard.jaccard_components(table(spark, sf, "documents"))


RULES_SQL = f"""with t as (select doc_id, coalesce(source, '') as host, coalesce(text, '') as text, {WORDS.format("coalesce(text, '')")} as w from documents),
  pos as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from t) p),
  twice as (select doc_id, g from pos group by 1, 2 having count(*) > 1),
  covered as (select doc_id, count(*) as c from (select distinct doc_id, unnest([i, i + 1, i + 2]) as p from pos join twice using (doc_id, g)) c group by 1),
  l as (select doc_id, host, unnest(string_split(text, chr(10))) as line from t),
  lw as (select doc_id, host, line, {LOWER_WORDS.replace("text", "line")} as lw from l),
  dup as (select doc_id, sum(c - 1) as c from (select doc_id, line, count(*) as c from lw where len(lw) > 0 group by 1, 2) d group by 1),
  ln as (select doc_id, host, array_to_string(lw, ' ') as line, sum(len(lw)) as words from lw where len(lw) > 0 group by 1, 2, 3),
  whole as (select doc_id, host, list_filter(list_transform(string_split(text, chr(10)), lambda x: array_to_string({LOWER_WORDS.replace("text", "x")}, ' ')),
      lambda x: x <> '') as lines from t),
  held as (select host, array_to_string(lines, chr(10)) as copy, unnest(list_distinct(lines)) as line from whole),
  sizes as (select host, count(*) as documents from t group by 1),
  common as (select host, line from (select host, line, count(distinct copy) as found from held group by 1, 2) c join sizes using (host)
    where found > 20 and found > 0.01 * documents),
  lost as (select doc_id, sum(words) as lost from ln join common using (host, line) group by 1),
  base as (select doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as word_chars,
      len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, coalesce(dup.c, 0) as n_dup_lines, coalesce(covered.c, 0) as n_repeat_words,
      coalesce(lost.lost, 0) as lost from t left join dup using (doc_id) left join covered using (doc_id) left join lost using (doc_id))
  select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
    cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words,
    n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, cast(n_words - lost as bigint) as n_left,
    not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and lost <= 0.5 * n_words as kept from base"""


@query("op2_line_frequency_rules", RULES_SQL)
def _(spark, sf):
    return rules.quality_rules(table(spark, sf, "documents")).drop("cleaned")  # the SQL states the digest columns


@query("op3_token_counts")
def _(spark, sf):
    return token_counts.token_counts(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_sum_of_squares_packing")
def _(spark, sf):
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op7_subword_toxicity")
def _(spark, sf):
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op9_importance_resampling")
def _(spark, sf):
    return importance.importance_sample(table(spark, sf, "documents"), table(spark, sf, "labels"))


def _side(start: str, end: str) -> str:
    """SQL for the assistant's spans in the rendered turns start..end of one side (list ``d``)."""
    size = "22 + length(s.r) + length(s.x) + 2"
    return f"""array_to_string(list_filter(list_transform(range(1, len(d) + 1), lambda i: case when d[i].r = 'assistant' then
      cast(coalesce(list_sum(list_transform(d[1:i - 1], lambda s: {size})), 0) + 13 + length(d[i].r) as bigint) || '-' ||
      cast(list_sum(list_transform(d[1:i], lambda s: {size})) as bigint) end), lambda v: v is not null), ',')"""


def _rendered(d: str) -> str:
    return f"coalesce(array_to_string(list_transform({d}, lambda s: '<|im_start|>' || s.r || chr(10) || s.x || '<|im_end|>' || chr(10)), ''), '')"


PREFERENCE_SQL = f"""with t as (select conv_id, list(struct_pack(r := replace(coalesce(role, ''), '<|', '< |'), x := replace(coalesce(text, ''), '<|', '< |'))
      order by turn, role, text) as c from conversations group by conv_id),
  p as (select conv_id, c, list_filter(range(1, len(c) + 1), lambda i: c[i].r = 'assistant') as a from t),
  q as (select conv_id, c, list_transform(range(1, len(c) + 1), lambda i: case when len(a) > 0 and i = a[len(a)]
      then struct_pack(r := c[i].r, x := case when a[1] < a[len(a)] then c[a[1]].x else '' end) else c[i] end) as b from p),
  n as (select *, coalesce(list_filter(range(1, len(c) + 1), lambda i: c[i] <> b[i])[1], len(c) + 1) - 1 as n from q)
  select conv_id, cast(n as int) as n_prompt_turns, {_rendered('c[1:n]')} as prompt, {_rendered('c[n + 1:]')} as chosen_completion,
    {_rendered('b[n + 1:]')} as rejected_completion, {_side('', '').replace('d[', 'c[n + 1:][').replace('len(d)', 'len(c[n + 1:])')} as chosen_mask,
    {_side('', '').replace('d[', 'b[n + 1:][').replace('len(d)', 'len(b[n + 1:])')} as rejected_mask, n < len(c) as usable from n"""


def _spans_text(c: str):
    return F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias(c)


@query("op6_preference_pairs", PREFERENCE_SQL)
def _(spark, sf):
    pairs = preference.stale_answers(preference.conversations(table(spark, sf, "conversations")))
    return preference.preference(pairs).select("conv_id", "n_prompt_turns", "prompt", "chosen_completion", "rejected_completion",
                                               _spans_text("chosen_mask"), _spans_text("rejected_mask"), "usable")


COVER_SQL = """with recursive v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(embedding) > 0),
  u as (select vec_id, v, sqrt(list_dot_product(v, v)) as n from v where list_dot_product(v, v) > 0),
  links as (select x.vec_id as a, y.vec_id as b from u x join u y on x.vec_id <> y.vec_id and len(x.v) = len(y.v)
    where list_dot_product(x.v, y.v) / (x.n * y.n) >= 0.95),
  reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
  c as (select a, min(b) as b from reach group by 1), k as (select a, count(*) as k from links group by 1)
  select e.vec_id, coalesce(k.k, 0) as n_links, least(e.vec_id, coalesce(c.b, e.vec_id)) as component_id, e.vec_id <= coalesce(c.b, e.vec_id) as kept
  from embeddings e left join c on c.a = e.vec_id left join k on k.a = e.vec_id"""


@query("op8_cover_tree_duplicates", COVER_SQL)
def _(spark, sf):
    return covertree.near_duplicates(table(spark, sf, "embeddings"))


@query("op10_license_compression")
def _(spark, sf):
    found = licenses.license_scan(table(spark, sf, "documents"))
    return found.select("doc_id", "n_blocks", F.size("notices").cast("long").alias("n_notices"), "restricted",
                        F.array_join(F.array_sort(F.array_distinct(F.transform("notices", lambda n: n["license"]))), "|").alias("licenses"),
                        F.aggregate("notices", F.lit(0), lambda a, n: a + n["changed"]).cast("long").alias("n_changed"))


@query("op5_nbest_pieces")
def _(spark, sf):
    return nbest.nbest(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


DIVERGENCE_SQL = f"""with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all({LOWER_TEXT}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents),
  occ as (select r, lang, source, unnest(w) as term from d),
  kept as (select lang, term, count(*) as total from occ group by 1, 2 having count(distinct r) >= 3),
  langs as (select lang, count(*) as v, sum(total) as n from kept group by 1),
  cnt as (select lang, source, term, count(*) as c from occ join kept using (lang, term) group by 1, 2, 3),
  g as (select lang, source, coalesce(v, 0) as v, coalesce(sum(c), 0) as n from (select distinct lang, source from d) x
    left join cnt using (lang, source) left join langs using (lang) group by 1, 2, 3),
  p as (select g.lang, g.source, kept.term, coalesce(c, 0) as c, cast(1 + cast(1000000000 as hugeint) * (coalesce(c, 0) + 1) // (g.n + g.v) as bigint) as p
    from g join kept on kept.lang = g.lang left join cnt on cnt.lang = g.lang and cnt.source = g.source and cnt.term = kept.term),
  q as (select kept.lang, term, cast(1 + cast(1000000000 as hugeint) * (total + 1) // (n + v) as bigint) as q from kept join langs using (lang)),
  diff as (select a.lang, a.source, b.source as other, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
    from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
  pairs as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
    from g a join g b on a.lang = b.lang and a.source <> b.source left join diff on diff.lang = a.lang and diff.source = a.source and diff.other = b.source),
  terms as (select lang, source, 'term' as part, term as item, cast((p - q) * (p - q) // q as bigint) as value from p join q using (lang, term) where c > 0 and p > q),
  ranked as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank from (from pairs union all from terms) u)
  select * from ranked where part = 'pair' or rank <= 200"""


@query("op11_source_divergence", DIVERGENCE_SQL)
def _(spark, sf):
    return divergence.source_divergence(table(spark, sf, "documents"))


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The rounds written one after the other, every distance by the definition."""
    each = lambda form, sep=", ": sep.join(form.format(k=k) for k in range(parts))
    sql = f"""with v as (select row_number() over (order by vec_id, embedding) as r, vec_id, label,
        list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as x from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
      p as (select r, k, x[k * (len(x) // {parts}) + 1:(k + 1) * (len(x) // {parts})] as x from v cross join (select unnest(range({parts})) as k) s),
      b0 as (select k, r - 1 as e, x as y from p where r <= {entries})"""
    near = """select r, k, arg_min(e, (d, e)) as e, min(d) as d, any_value(x) as x from (select r, p.k, e, x,
        list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d from p join {book} b on b.k = p.k) t group by 1, 2"""
    for n in range(rounds):
        sql += f""", a{n} as ({near.format(book=f"b{n}")}),
      m{n} as (select k, e, list(m order by i) as y from (select k, e, i, cast((s - ((s % c) + c) % c) // c as bigint) as m from
        (select k, e, i, sum(x[i]) as s, count(*) as c from (select k, e, x, unnest(range(1, len(x) + 1)) as i from a{n}) t group by 1, 2, 3) u) w group by 1, 2),
      b{n + 1} as (select b.k, b.e, coalesce(m.y, b.y) as y from b{n} b left join m{n} m on m.k = b.k and m.e = b.e)"""
    return sql + f""", f as ({near.format(book=f"b{rounds}")}),
      codes as (select r, string_agg(printf('%02x', e), '' order by k) as code, cast(sum(d) as bigint) as error from f group by 1),
      digest as (select sha256(string_agg(array_to_string(y, ','), ',' order by k, e)) as codebooks_sha256 from b{rounds})
      select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from v join codes using (r) cross join digest"""


@query("op12_trie_codes", _codes_sql())
def _(spark, sf):
    return trie_codes.trie_codes(table(spark, sf, "embeddings"))


@query("op13_main_text")
def _(spark, sf):
    return main_text.extract(table(spark, sf, "pages"))
