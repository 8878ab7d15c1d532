"""Entity and concept annotation, sentences, mark-up, lemmas."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rostrum.functions.text import WORD, lc_norm
from rostrum.operators.filters import filter_articles
from rostrum.operators.joins import join_protected_words
from rostrum.operators.rows import unnest

Annotator = Callable[[str], Iterable]


def annotate(df: DataFrame, annotator: Callable[[], Annotator], text_col: str, out_schema: str, out: str = "annotations",
             keep: Sequence[str] = ("Hash",)) -> DataFrame:
    """Run a text annotator over a column → array of ``out_schema`` structs.

    ``annotator`` is a factory called once per task, so that models load there. Missing texts and texts the annotator
    fails on give an empty list.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tag = annotator()

        def one(text):
            if not isinstance(text, str):
                return []
            try:
                return list(tag(text))
            except Exception:  # a text the annotator cannot read has no annotations
                return []
        for b in batches:
            yield b[list(keep)].assign(**{out: [one(t) for t in b[text_col]]})

    kept = df.select(*keep, text_col)
    schema = ", ".join(f"`{c}` {t}" for c, t in df.select(*keep).dtypes) + f", {out} array<struct<{out_schema}>>"
    return kept.mapInPandas(run, schema)


def ngrams(toks: Column, n_max: int = 3) -> Column:
    """All runs of one to ``n_max`` words with position and length, as array of structs."""
    def run(n: int) -> Column:
        return F.filter(F.transform(toks, lambda _, i: F.struct(
            F.array_join(F.slice(toks, i + 1, n), " ").alias("phrase"), i.alias("pos"),
            F.when(i + n <= F.size(toks), F.lit(n)).alias("n"))), lambda g: g["n"].isNotNull())
    return F.concat(*[run(n) for n in range(1, n_max + 1)])


def gazetteer_entities(df: DataFrame, phrases: DataFrame, toks: str, keep: Sequence[str], n_max: int = 3) -> DataFrame:
    """Dictionary tagger: phrases (phrase, tag) found in word arrays → (keep…, pos, phrase, tag).

    Only places that hold the first word of some phrase are expanded, to runs of the lengths that its phrases have. The dictionary may be large, so
    both steps are joins; the dictionary holds each phrase once and hot words are split by adaptive execution.
    """
    each = phrases.dropDuplicates(["phrase", "tag"])
    parts = F.split("phrase", " ")
    firsts = each.groupBy(parts[0].alias("_first")).agg(F.collect_set(F.when(F.size(parts) <= n_max, F.size(parts))).alias("_sizes"))  # at most n_max sizes
    places = F.transform(toks, lambda t, i: F.struct(t.alias("first"), i.alias("pos"), F.slice(toks, i + 1, n_max).alias("run")))
    found = unnest(df, *keep, g=places).select(*keep, "g.*").join(firsts, F.col("first") == F.col("_first"))
    runs = F.transform(F.filter("_sizes", lambda n: n <= F.size("run")), lambda n: F.array_join(F.slice("run", 1, n), " "))
    return unnest(found, *keep, "pos", phrase=runs).join(each, "phrase").select(*keep, "pos", "phrase", "tag")


def concept_threshold(df: DataFrame, confidence: float = 0.5, support: int = 100) -> DataFrame:
    return df.filter((F.col("confidence") >= confidence) & (F.col("support") >= support))


def explode_annotations(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per document and annotation; documents without any drop out."""
    return unnest(df, *keep, _a=column).select(*keep, "_a.*")


def sentences(c: Column | str) -> Column:
    """Words and signs joined by spaces, as array of sentences: lines are split after ``.``, ``!`` and ``?``."""
    tokens = F.transform(F.split(c, "\n"), lambda line: F.array_join(
        F.regexp_extract_all(line, F.lit(WORD + r"|[^\p{L}\p{N}\s]"), F.lit(0)), " "))
    pieces = F.flatten(F.transform(tokens, lambda line: F.split(F.regexp_replace(line, r"([.!?]) ", "$1\n"), "\n")))
    return F.filter(pieces, lambda s: s != "")


def split_sentences(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per sentence."""
    return df.select(*keep, F.posexplode_outer(sentences(text)).alias("nr", "sentence")).filter("nr is not null")


# Mark-up removal steps of wiki pages, in order: pattern and what stays of it.
MARKUP = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<(math|code|nowiki|pre|gallery|timeline|syntaxhighlight)\b[^>]*>.*?</\1>", ""),
    (r"(?is)<ref\b[^>/]*/>", ""), (r"(?is)<ref\b[^>]*>.*?</ref>", ""),
    (r"<[^<>]+>", ""),
]
# Name spaces of media and categories.
MEDIA = re.compile(r"(?:file|image|fájl|kép|kategória|category):", re.IGNORECASE)
LINKS = [
    (r"\[\[[^\[\]|]*\|([^\[\]|]*)\]\]", "$1"), (r"\[\[([^\[\]|]*)\]\]", "$1"),
    (r"\[(?:https?|ftp)://\S+\s+([^\]]+)\]", "$1"), (r"\[(?:https?|ftp)://\S+\]", ""),
    (r"'{2,5}", ""), (r"(?m)^=+[ \t]*(.*?)[ \t]*=+[ \t]*$", "$1"), (r"(?m)^[*#:;]+\s*", ""), (r"__[A-Z]+__", ""),
    (r"&nbsp;", " "), (r"&lt;", "<"), (r"&gt;", ">"), (r"&quot;", '"'), (r"&amp;", "&"),
]


def drop_table_rows(c: Column) -> Column:
    """Lines of a wiki table: they start with a bar or a table sign."""
    lines = F.filter(F.split(c, "\n"), lambda line: ~line.rlike(r"(?U)\A(\s*\{\)|\||\|\})"))
    return F.array_join(lines, "\n")


def cut_nested(text: str, opening: str, closing: str, only: re.Pattern | None = None) -> str:
    """Text without its balanced brackets of any depth; with ``only``, without those whose content starts with the pattern."""
    stack: list[int] = []
    cuts: list[tuple[int, int]] = []
    for m in re.finditer(re.escape(opening) + "|" + re.escape(closing), text):
        if m.group() == opening:
            stack.append(m.start())
        elif stack:
            start = stack.pop()
            if only is None or only.match(text, start + len(opening)):
                while cuts and cuts[-1][0] >= start:
                    cuts.pop()
                cuts.append((start, m.end()))
    at, kept = 0, []
    for start, end in cuts:
        kept.append(text[at:start])
        at = end
    return "".join([*kept, text[at:]])


def _drop_brackets(c: Column) -> Column:
    """Templates, tables and media links, by a scan with a stack: patterns alone cannot match any depth."""
    def clean(t: str) -> str:
        return cut_nested(cut_nested(cut_nested(t, "{{", "}}"), "{|", "|}"), "[[", "]]", MEDIA)

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(clean, na_action="ignore")

    return F.pandas_udf(run, "string")(c)


def strip_markup(c: Column, table_lines: bool = False) -> Column:
    """Wiki mark-up → plain text. Templates, tables and media links go at any depth; brackets that do not close stay as text."""
    c = drop_table_rows(c) if table_lines else c
    for pattern, stays in MARKUP:
        c = F.regexp_replace(c, pattern, stays)
    c = _drop_brackets(c)
    for pattern, stays in LINKS:
        c = F.regexp_replace(c, pattern, stays)
    return F.btrim(F.regexp_replace(c, r"\n{3,}", "\n\n"), F.lit(" \n"))


def lemmatize_lookup(tokens: DataFrame, lemmas: DataFrame, protected: DataFrame, token: str = "tok", out: str = "lemma") -> DataFrame:
    """Dictionary lemma of each token: protected words stay, the longest candidate wins, unknown words stay."""
    best = lemmas.groupBy(lc_norm("surface").alias("_s")).agg(F.max_by("lemma", F.struct(F.length("lemma"), "lemma")).alias("_l"))
    marked = join_protected_words(tokens, protected, token, out="_p")
    joined = marked.join(best, lc_norm(marked[token]) == best["_s"], "left")
    return joined.withColumn(out, F.when(F.col("_p"), F.col(token)).otherwise(F.coalesce("_l", token))).drop("_p", "_s", "_l")


def plain_articles(pages: DataFrame, content: str = "content") -> DataFrame:
    """Article pages with their content as plain text, one sentence a line; other pages drop out."""
    plain = filter_articles(pages, content=content).withColumn(content, strip_markup(F.col(content)))
    return plain.withColumn(content, F.array_join(sentences(content), "\n"))
