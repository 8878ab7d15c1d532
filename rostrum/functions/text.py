"""Scalar functions on speeches: plain Column expressions, evaluated in the JVM."""

from __future__ import annotations

import unicodedata
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

NBSP = "\u00a0"

# The label put before the text on speech pages, the chair's role name,
# and the two ways a sitting header names the chair.
TEXT_LABEL = "A felszólalás szövege:"
CHAIR = "elnök"
CHAIR_TITLE = "Elnök"
CHAIR_PATTERNS = [
    r"(?dU)-\s*Elnök:\s*([^\-\)\r\n]+)\s*[\-\)\r\n]",
    r"(?dU)Az elnöki széket (.*) foglalja",
]

# Fixed value: address of a speech page (term, sitting number, speech number, speech number).
SPEECH_URL = (
    "https://www.parlament.hu/internet/cplsql/ogy_naplo.naplo_fadat"
    "?p_ckl=%s&p_uln=%s&p_felsz=%s&p_szoveg=&p_felszig=%s"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_space(c: Column | str) -> Column:
    """Trim all Unicode white space at both ends."""
    return F.regexp_replace(_col(c), r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def strip_chars(c: Column | str, chars: str) -> Column:
    """Trim any of ``chars`` at both ends."""
    return F.btrim(_col(c), F.lit(chars))


def before(c: Column | str, sep: str) -> Column:
    """Part before the first ``sep``, or everything."""
    return F.substring_index(_col(c), sep, 1)


def after(c: Column | str, sep: str) -> Column:
    """Part after the first ``sep``, or the empty string."""
    c = _col(c)
    at = F.instr(c, sep)
    return F.when(c.isNull(), None).when(at > 0, F.substring(c, at + len(sep), F.length(c))).otherwise("")


def smart_truncate(c: Column | str, length: int = 250, suffix: str = "...") -> Column:
    """Cut long strings at a word boundary and mark the cut."""
    c = _col(c)
    cut = F.regexp_replace(F.substring(c, 1, length), r" [^ ]*\z", "")
    return F.when(F.length(c) <= length, c).otherwise(F.concat(cut, F.lit(suffix)))


def split_name_party(c: Column | str) -> Column:
    """``Name (Party)`` at the start → struct(name, party); anything else → (text, NULL)."""
    c = _col(c)
    pattern = r"(?U)\A([\p{L}\s.\-]+)\(([\p{L}\s]+)\)"
    hit = c.rlike(pattern)
    return F.struct(
        F.when(hit, strip_space(F.regexp_extract(c, pattern, 1))).otherwise(c).alias("name"),
        F.when(hit, strip_space(F.regexp_extract(c, pattern, 2))).alias("party"),
    )


def split_speaker_party(c: Column | str) -> Column:
    """Speaker before the first bracket, party inside it; without bracket the text is the speaker."""
    c = _col(c)
    hit = F.instr(c, "(") > 0
    return F.struct(
        F.when(hit, strip_space(before(c, "("))).otherwise(c).alias("speaker"),
        F.when(hit, before(after(c, "("), ")")).alias("party"),
    )


def title_case(c: Column | str) -> Column:
    """Capital after every non-letter, small letters elsewhere."""
    runs = F.regexp_extract_all(_col(c), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def titlecase_upper(c: Column | str) -> Column:
    """Title case for names written in capitals only."""
    c = _col(c)
    return F.when((c == F.upper(c)) & (c != F.lower(c)), title_case(c)).otherwise(c)


def clean_speaker(c: Column | str) -> Column:
    """Trim and split ``A (B)`` → struct(speaker, title, party, bracketed); a chair's own name is in the bracket."""
    s = strip_chars(c, " :")
    pattern = r"([^(]+)\(([^)]+)\)"
    hit = s.rlike(pattern)
    outer = strip_space(F.regexp_extract(s, pattern, 1))
    inner = strip_space(F.regexp_extract(s, pattern, 2))
    chair = F.lower(outer) == CHAIR
    return F.struct(
        F.when(hit & chair, inner).when(hit, outer).otherwise(s).alias("speaker"),
        F.when(hit & chair, F.lit(CHAIR_TITLE)).alias("title"),
        F.when(hit & ~chair, inner).alias("party"),
        F.coalesce(hit, F.lit(False)).alias("bracketed"),
    )


def chair_from_header(speaker: Column | str, header: Column | str) -> Column:
    """A speaker given only as the chair: role → title, name from the sitting header → struct(speaker, title)."""
    s, h = _col(speaker), _col(header)
    chair = (F.lower(s) == CHAIR) & h.isNotNull()
    name = s
    for pattern in reversed(CHAIR_PATTERNS):
        name = F.when(h.rlike(pattern), strip_chars(F.regexp_extract(h, pattern, 1), " .\r\n")).otherwise(name)
    return F.struct(F.when(chair, name).otherwise(s).alias("speaker"), F.when(chair, s).alias("title"))


def speaker_from_text(speaker: Column | str, text: Column | str) -> Column:
    """A missing speaker is taken from the text before its first colon → struct(speaker, title)."""
    s, t = _col(speaker), _col(text)
    pattern = r"(?dU)([^,]+),\s*(.+)"
    head = before(t, ":")
    missing = (strip_space(F.coalesce(s, F.lit(""))) == "") & (F.instr(t, ":") > 0)
    titled = head.rlike(pattern)
    return F.struct(
        F.when(missing & titled, title_case(strip_space(F.regexp_extract(head, pattern, 1))))
        .when(missing, head).otherwise(s).alias("speaker"),
        F.when(missing & titled, strip_space(F.regexp_extract(head, pattern, 2))).alias("title"),
    )


def clean_text(c: Column | str) -> Column:
    """Remove the label, turn hard spaces into spaces and blank lines into one line break, trim."""
    s = F.replace(F.replace(_col(c), F.lit(TEXT_LABEL), F.lit("")), F.lit(NBSP), F.lit(" "))
    return strip_chars(F.regexp_replace(s, r"(?U)\s*[\r\n]+", "\n"), " \n")


def strip_bill_titles(c: Column | str) -> Column:
    return F.transform(_col(c), lambda t: strip_chars(t, " \n"))


def speaker_id(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c.startswith("p_azon="), strip_space(F.substring(c, 8, F.length(c))))


def speech_body(c: Column | str) -> Column:
    """Text file of a speech without its two head lines and without the speaker up to the first colon."""
    lines = F.split(F.regexp_replace(_col(c), r"\r\n?", "\n"), "\n")
    rest = F.array_join(F.slice(lines, 3, F.greatest(F.size(lines), F.lit(1))), "\n")
    return F.substring(rest, F.instr(rest, ":") + 1, F.length(rest))


def date_and_number(c: Column | str) -> Column:
    """``2018.05.08.(3)`` → struct(date_text, date, nr)."""
    c = _col(c)
    day = before(c, "(")
    return F.struct(
        day.alias("date_text"),
        F.try_to_date(day, "yyyy.MM.dd.").alias("date"),
        before(after(c, "("), ")").alias("nr"),
    )


def term_years(term: Column | str, current: int = 41) -> Column:
    """First and last year of a four-year term; the current term has no last year."""
    t = _col(term).cast("int")
    start = 1990 + (t - 34) * 4
    return F.struct(start.alias("start"), F.when(t < current, start + 4).alias("end"))


def expand_id_range(c: Column | str) -> Column:
    """``12-15`` → [12, 13, 14, 15], ``7`` → [7]; to be exploded. Other text gives NULL."""
    c = strip_space(_col(c))
    lo = F.regexp_extract(c, r"\A([0-9]+)", 1).try_cast("int")
    hi = F.regexp_extract(c, r"\A[0-9]+-([0-9]+)\z", 1).try_cast("int")
    return (
        F.when(c.rlike(r"\A[0-9]+\z"), F.array(lo))
        .when(hi >= lo, F.sequence(lo, hi))
        .when(hi < lo, F.array().cast("array<int>"))
    )


def build_speech_url(term: Column | str, sitting_nr: Column | str, nr: Column | str) -> Column:
    return F.format_string(SPEECH_URL, _col(term).cast("string"), _col(sitting_nr).cast("string"),
                           _col(nr).cast("string"), _col(nr).cast("string"))


@F.pandas_udf(T.StringType())
def _resolve(base: pd.Series, href: pd.Series) -> pd.Series:
    def one(b, h):
        if h is None or b is None:
            return None
        try:
            return urljoin(b, h)
        except ValueError:
            return None
    return pd.Series([one(b, h) for b, h in zip(base, href)], dtype="object")


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute address of a link on a page (no built-in joins relative addresses)."""
    return _resolve(_col(base), _col(href))


@F.pandas_udf(T.StringType())
def _nfkd(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else unicodedata.normalize("NFKD", v)).astype("object")


def nfkd(c: Column | str) -> Column:
    """Compatibility decomposition (no built-in); plain ASCII never leaves the JVM's fast branch upstream."""
    return _nfkd(_col(c))


def uri_decode(c: Column | str) -> Column:
    """Percent and plus decoding; a percent sign that starts no code stays as it is."""
    safe = F.regexp_replace(_col(c), "%(?![0-9a-fA-F]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), _col(c))


def uri_tail(c: Column | str) -> Column:
    return F.substring_index(_col(c), "/", -1)


def concept_category(types: Column | str) -> Column:
    """Last DBpedia class of a comma list, without its prefix; NULL when there is none."""
    named = F.filter(F.split(_col(types), ","), lambda x: x.contains("DBpedia"))
    return F.substring_index(F.try_element_at(named, F.lit(-1)), ":", -1)


def lemma_pos(c: Column | str) -> Column:
    """``lemma_POS`` split at the last underscore → struct(lemma, pos)."""
    c = _col(c)
    pattern = r"(?s)\A(.*)_([^_]*)\z"
    return F.struct(
        F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).alias("lemma"),
        F.nullif(F.regexp_extract(c, pattern, 2), F.lit("")).alias("pos"),
    )


def fix_accents(c: Column | str) -> Column:
    """Old encodings wrote the long umlauts with tilde or circumflex."""
    c = _col(c)
    return F.when(c.rlike("[õÕûÛ]"), F.translate(c, "õÕûÛ", "őŐűŰ")).otherwise(c)


def lc_norm(c: Column | str) -> Column:
    return F.lower(fix_accents(c))


def _fold_table() -> tuple[str, str]:
    """Latin letters whose decomposition starts with an ASCII letter, and that letter."""
    source, target = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii() and base.isalpha():
            source.append(chr(code))
            target.append(base)
    # Letters with a stroke or without dot have no decomposition.
    return "".join(source) + "øØđĐłŁħĦŧŦı", "".join(target) + "oOdDlLhHtTi"


FOLD_FROM, FOLD_TO = _fold_table()
# Letters folded to two.
FOLD_PAIRS = [("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("þ", "th"), ("Æ", "AE"), ("Œ", "OE")]


def ascii_fold(c: Column | str) -> Column:
    """Accented Latin letters → ASCII; texts without any skip the character table."""
    c = _col(c)
    pairs = c
    for letter, pair in FOLD_PAIRS:
        pairs = F.replace(pairs, F.lit(letter), F.lit(pair))
    single = F.translate(F.when(c.rlike(f"[{''.join(x for x, _ in FOLD_PAIRS)}]"), pairs).otherwise(c), FOLD_FROM, FOLD_TO)
    return F.when(c.rlike(r"[^\x00-\x7f]"), single).otherwise(c)


def topic_label(c: Column | str) -> Column:
    return F.concat(F.lit("Topic "), pad_topic(c))


def pad_topic(c: Column | str) -> Column:
    t = _col(c).cast("string")
    return F.when(F.length(t) >= 2, t).otherwise(F.lpad(t, 2, "0"))


def topic_or_pair(texts: Column | str, has_bills: Column | str) -> Column:
    """Header texts of an agenda block → [topic], or [topic, rest] when there are several and no bill."""
    t = _col(texts)
    head = strip_space(F.try_element_at(t, F.lit(1)))
    rest = strip_chars(F.array_join(F.slice(t, 2, F.greatest(F.size(t), F.lit(1))), " "), ' \r\n"')
    return F.when((F.size(t) == 1) | _col(has_bills), F.array(head)).otherwise(F.array(head, rest))


WORD = r"[\p{L}\p{N}]+"


def words(c: Column | str) -> Column:
    """Letter and digit runs, case kept."""
    return F.regexp_extract_all(_col(c), F.lit(WORD), F.lit(0))
