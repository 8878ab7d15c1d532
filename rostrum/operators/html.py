"""Extraction from stored parliament pages.

Links are found by patterns in the JVM. Structured pages go through a small tree helper inside ``mapInPandas``: one page
in, its rows out, nothing kept between pages.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from html.entities import name2codepoint
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rostrum.functions.text import SPEECH_URL, expand_id_range, topic_or_pair
from rostrum.operators.rows import compute_once, unnest
from rostrum.schemas import SITTING_FIELDS

# Link labels, the id of the speech table, the marker of a blocked page, the contents page of a sitting.
PREV_LABELS = ("Előző", "Elõzõ")
NEXT_LABELS = ("Következő", "Következõ")
SITTINGS_LABEL = "Ülésnap felszólalásai"
SPEECH_DIV = "egy_felszolalas"
CONTENT_CLASS = "pair-content"
BLOCKED = "CAPTCHA"
TOC_URL = "https://www.parlament.hu/internet/cplsql/ogy_naplo.ulnap_felszo?p_lista=f&p_nap=%s&p_ckl=%s"


# ---- links, in the JVM

HREF = r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
ANCHOR = r"(?is)<a\b[^>]*?" + HREF + r"[^>]*>(.*?)</a\s*>"
REFERENCE = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z]{2,8});"


def unescape(c: Column) -> Column:
    """Character references: decimal, hexadecimal, and the names of HTML 4 and ``&apos;``; unknown ones stay."""
    names = F.create_map(*[F.lit(x) for name, code in {**name2codepoint, "apos": 39}.items() for x in (name, chr(code))])

    def one(ref: Column) -> Column:
        body = F.substr(ref, F.lit(2), F.length(ref) - 2)
        number = F.when(body.startswith("#x") | body.startswith("#X"), F.conv(F.substr(body, F.lit(3)), 16, 10)).otherwise(F.substr(body, F.lit(2)))
        code = number.try_cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.coalesce(F.when(body.startswith("#"), char).otherwise(F.element_at(names, body)), ref)

    # Pieces between the references and the references themselves, in turn: what one gives is not read again.
    plain = F.split(c, REFERENCE, -1)
    refs = F.transform(F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(0)), one)
    joined = F.array_join(F.transform(plain, lambda p, i: F.concat(p, F.coalesce(F.get(refs, i), F.lit("")))), "")
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)


def _anchors(html: Column) -> Column:
    c = F.regexp_replace(html, r"(?s)<!--.*?-->|(?i)<script\b.*?</script\s*>", "")
    found = F.regexp_extract_all(c, F.lit(ANCHOR), F.lit(0))
    return F.transform(found, lambda a, i: F.struct(
        i.alias("pos"), unescape(F.concat(*[F.regexp_extract(a, ANCHOR, k) for k in (1, 2, 3)])).alias("href"),
        unescape(F.regexp_replace(F.regexp_extract(a, ANCHOR, 4), "<[^>]*>", "")).alias("anchor")))


def extract_links(pages: DataFrame, *keep: str, html: str = "html") -> DataFrame:
    """One row per link: position, address (in any quoting or none), plain anchor text."""
    return unnest(pages, *keep, a=_anchors(F.col(html))).select(*keep, "a.pos", "a.href", "a.anchor")


def link_by_text(pages: DataFrame, label: str | Sequence[str], *keep: str, html: str = "html") -> DataFrame:
    """Address of the first link of each page whose text is the label, found inside the row."""
    labels = [label] if isinstance(label, str) else list(label)
    found = compute_once(pages.select(*keep, html), {"_hit": F.get(F.filter(_anchors(F.col(html)), lambda a: a["anchor"].isin(labels)), F.lit(0))})
    return found.filter(F.col("_hit").isNotNull()).select(*keep, F.col("_hit")["href"].alias("href"))


def term_label(start: int, current: bool = False) -> str:
    """Label of the link to a term: both years, or an open end for the current term."""
    return f"{start}-{'' if current else start + 4}"


def quarantine_blocked(pages: DataFrame, html: str = "html") -> tuple[DataFrame, DataFrame]:
    """(pages to parse, pages that show a robot check instead of content)."""
    blocked = F.coalesce(F.col(html).contains(BLOCKED), F.lit(False))
    return pages.filter(~blocked), pages.filter(blocked)


# ---- tree helper

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"p", "div", "table", "ul", "ol", "li", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "form", "article", "nav"}
# An opening tag ends these open ones, up to the given border.
CLOSES = {"li": ({"li", "p"}, {"ul", "ol"}), "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}),
          "th": ({"td", "th", "p"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tr", "td", "th", "p"}, {"table"}),
          "thead": ({"tbody", "tr", "td", "th", "p"}, {"table"}), **{b: ({"p"}, {"div", "td", "li", "body"}) for b in BLOCKS if b != "li"}}


RESULT_CHARS = 4_000_000  # characters of pages whose rows are held at once


class Node:
    """Element with its attributes and its children (elements and text pieces)."""

    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs=()):
        self.tag, self.attrs, self.kids = tag, dict(attrs), []

    def children(self, tag: str) -> list["Node"]:
        return [k for k in self.kids if isinstance(k, Node) and k.tag == tag]

    def walk(self, *tags: str) -> Iterator["Node"]:
        todo = self.kids[::-1]
        while todo:
            k = todo.pop()
            if isinstance(k, Node):
                if k.tag in tags:
                    yield k
                todo += k.kids[::-1]

    def own(self) -> list[str]:
        return [k for k in self.kids if isinstance(k, str)]

    def first(self) -> str | None:
        return next(iter(self.own()), None)

    def texts(self) -> Iterator[str]:
        todo = self.kids[::-1]
        while todo:
            k = todo.pop()
            if isinstance(k, str):
                yield k
            elif k.tag not in ("script", "style"):
                todo += k.kids[::-1]

    def text_after(self, kid: "Node") -> str | None:
        seen = False
        for k in self.kids:
            seen = seen or k is kid
            if seen and isinstance(k, str):
                return k
        return None


class _Tree(HTMLParser):
    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]
        self.depth: Counter[str] = Counter()  # open elements by tag
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        ends, border = CLOSES.get(tag, ((), ()))
        at = len(self.open)
        for i in range(len(self.open) - 1, 0, -1) if ends else ():
            if self.open[i].tag in border:
                break
            if self.open[i].tag in ends:
                at = i
        self._shut(at)
        node = Node(tag, attrs)
        self.open[-1].kids.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.depth[tag] += 1

    def _shut(self, at: int) -> None:
        for node in self.open[at:]:
            self.depth[node.tag] -= 1
        del self.open[at:]

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1) if self.depth[tag] else ():
            if self.open[i].tag == tag:
                self._shut(i)
                return

    def parse_marked_section(self, i, report=1):
        """A marked section of any kind is skipped like a comment, as browsers do."""
        return self.parse_bogus_comment(i)

    def handle_data(self, data):
        kids = self.open[-1].kids
        if kids and isinstance(kids[-1], str):
            kids[-1] += data
        else:
            kids.append(data)


def tree(html: str) -> Node:
    return _Tree(html).root


def _strip(s: str | None) -> str | None:
    return None if s is None else s.strip()


def _norm(s: str) -> str:
    return unicodedata.normalize("NFKD", s)


def _join(base: str, href: str | None) -> str | None:
    if href is None:
        return None
    try:
        return urljoin(base, _norm(href))
    except ValueError:
        return None


def _cell(cells: list[Node], n: int) -> str | None:
    return cells[n - 1].first() if n <= len(cells) else None


def _link(cells: list[Node], n: int) -> Node | None:
    return next(iter(cells[n - 1].children("a")), None) if n <= len(cells) else None


def _rows(table: Node) -> list[Node]:
    return [r for body in table.children("tbody") for r in body.children("tr")]


def parse_pages(pages: DataFrame, parse: Callable[[Node, str], list[dict]], schema: str, keep: Sequence[str] = (),
                url: str = "url", html: str = "html", failed: bool = False) -> DataFrame:
    """Rows of each page: ``parse(tree, url)`` gives dicts with the fields of ``schema``; ``keep`` columns are copied.

    A page that cannot be parsed has no rows and ends no job; with ``failed`` the result is those pages alone: ``keep``, url and error.
    """
    kept = pages.select(*[c for c in dict.fromkeys([*keep, url, html])])
    types = dict(kept.dtypes)
    schema = "url string, error string" if failed else schema
    copied = [c for c in keep if not (failed and c == "url")]
    full = ", ".join([f"`{c}` {types[c]}" for c in copied] + [schema])
    names = [f.name for f in kept.select(*copied).schema.fields] + [p.strip().split()[0] for p in _fields(schema)]

    def rows_of(source: str, address: str) -> list[dict]:
        try:
            found = parse(tree(source), address or "")
        except Exception as e:  # whatever a broken page raises
            return [{"url": address, "error": f"{type(e).__name__}: {e}"[:500]}] if failed else []
        return [] if failed else found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, size = [], 0
            for i, (u, page) in enumerate(zip(b[url], b[html])):
                if isinstance(page, str):
                    held = {c: b[c].iat[i] for c in copied}
                    rows += [{**held, **row} for row in rows_of(page, u)]
                    size += len(page)
                if size >= RESULT_CHARS:
                    yield pd.DataFrame(rows, columns=names, dtype="object")
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=names, dtype="object")

    return kept.filter(F.col(html).isNotNull()).mapInPandas(run, full)


def _fields(schema: str) -> list[str]:
    """Top-level fields of a schema text."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            out.append(schema[start:i])
            start = i + 1
    return [*out, schema[start:]]


# ---- page kinds

def extract_page_text(pages: DataFrame, term: int, *keep: str, failed: bool = False) -> DataFrame:
    """Speech text of a page: content blocks from term 36 on, paragraphs joined by spaces before."""
    def parse(root: Node, _: str) -> list[dict]:
        return [{"text": _speech_text(root, term)}]

    return parse_pages(pages, parse, "text string", keep, failed=failed)


def _speech_text(root: Node, term: int) -> str:
    if term < 36:
        text = " ".join(t for p in root.walk("p") for t in p.own())
        return text.strip() if term == 34 else text
    blocks = [d for c in root.walk("div") if c.attrs.get("class") == CONTENT_CLASS for d in c.children("div")]
    return "".join(t for d in blocks if d.attrs.get("id") != SPEECH_DIV for t in d.texts())


def _header(root: Node) -> str | None:
    head = next((p.first() for p in root.walk("pre") if p.first()), None)
    return _strip(head) or None


def extract_header(pages: DataFrame, *keep: str, failed: bool = False) -> DataFrame:
    """Sitting header: the page's first preformatted text, NULL without one."""
    return parse_pages(pages, lambda root, _: [{"header": _header(root)}], "header string", keep, failed=failed)


SITTING_ROW = ", ".join(f"{f} string" for f in SITTING_FIELDS if f != "header")


def parse_sitting_list(pages: DataFrame, term: int, *keep: str, failed: bool = False) -> DataFrame:
    """Rows of a term's sitting table; rows without a linked date are skipped.

    From term 37 on the table has a video column, used from term 38 on. Terms 34 and 35 take the contents address
    from the row and give no sitting number; later terms build it.
    """
    old, shift = term < 36, int(term > 36)

    def parse(root: Node, _: str) -> list[dict]:
        out = []
        for row in (r for t in root.walk("table") for r in _rows(t)):
            cells = row.children("td")
            link = _link(cells, 1)
            label = link.first() if link else None
            if label is None or (old and not link.attrs.get("href")):
                continue
            label = label.strip() if term == 35 else label
            nr = label.partition("(")[2].partition(")")[0]
            raw = _link(cells, 6 + shift)
            rest = ["session", "type", "day_of_session", None, "duration", "sitting_id", "sitting_day", None if old else "note"]
            rec = {name: _cell(cells, 3 + shift + i) for i, name in enumerate(rest) if name}
            if old:
                rec = {name: _strip(v) for name, v in rec.items()}
            rec.update(term=str(term), date=label.partition("(")[0], day=_strip(_cell(cells, 2)), sitting_uid=f"{term}-{nr}",
                       duration_raw=(_strip(raw.first()) if old else raw.first()) if raw else None,
                       toc_url=link.attrs["href"] if old else TOC_URL % (nr, term), sitting_nr=None if old else nr)
            if term > 37 and (video := _link(cells, 3)):
                rec.update(video_time=video.first(), video_url=video.attrs.get("href"))
            out.append(rec)
        return out

    return parse_pages(pages, parse, SITTING_ROW, keep, failed=failed)


TOC_ROW = ("number string, type string, committee string, started_at string, topics array<string>, "
           "bill_title array<string>, bill_url array<string>")


def parse_sitting_toc(pages: DataFrame, term: str = "term", nr: str = "sitting_nr", uid: str = "sitting_uid", failed: bool = False) -> DataFrame:
    """Speeches of a sitting's contents page (term 36 on); number ranges give one row each, rows without link none."""
    def parse(root: Node, url: str) -> list[dict]:
        out = []
        for block in (t for h in root.children("html") for b in h.children("body") for c in b.children("div")
                      if c.attrs.get("class") == CONTENT_CLASS for t in c.children("table")):
            heads = [th for head in block.children("thead") for tr in head.children("tr")[:1] for th in tr.children("th")]
            bills = [(th, a) for th in heads for a in th.walk("a")]
            titles = [" ".join(x for x in (a.first(), th.text_after(a)) if x) for th, a in bills]
            urls = [_join(url, a.attrs.get("href")) for _, a in bills]
            for row in (r for body in block.children("tbody") for r in body.walk("tr")):
                cells = row.children("td")
                link = _link(cells, 1)
                if link is None or link.first() is None:
                    continue
                out.append({"number": _norm(link.first()).strip(), "type": _cell(cells, 3),
                            "committee": next(cells[3].texts(), None) if len(cells) > 3 else None, "started_at": _cell(cells, 5),
                            "topics": [t for th in heads for t in th.own()], "bill_title": titles, "bill_url": urls})
        return out

    if failed:
        return parse_pages(pages, parse, TOC_ROW, (term, nr, uid), failed=True)
    rows = parse_pages(pages, parse, TOC_ROW, (term, nr, uid))
    rows = unnest(rows, *rows.columns, idx=expand_id_range("number"))
    i = F.col("idx").cast("string")
    return rows.select(
        F.concat_ws("-", uid, i).alias("id"), F.format_string(SPEECH_URL, F.col(term).cast("string"), F.col(nr).cast("string"), i, i).alias("url"),
        uid, "idx", "type", "committee", "started_at",
        F.when(F.size("topics") > 0, topic_or_pair("topics", F.size("bill_title") > 0)).alias("topic"), "bill_title", "bill_url")


def parse_toc_list_34(pages: DataFrame, *keep: str, failed: bool = False) -> DataFrame:
    """Linked list items of a contents page: position among all items, address, speaker behind the link."""
    def parse(root: Node, url: str) -> list[dict]:
        out = []
        for i, li in enumerate(root.walk("li"), 1):
            link = next(iter(li.children("a")), None)
            if link and link.attrs.get("href"):
                out.append({"idx": i, "url": _join(url, link.attrs["href"]), "speaker": _strip(li.text_after(link))})
        return out

    return parse_pages(pages.withColumnRenamed("url", "page_url"), parse, "idx int, url string, speaker string", keep, url="page_url", failed=failed)


def parse_toc_list_35(pages: DataFrame, *keep: str, failed: bool = False) -> DataFrame:
    """Linked list items with speaker, duration and the topic announced for the following speeches."""
    def parse(root: Node, url: str) -> list[dict]:
        out = []
        for i, li in enumerate(root.walk("li"), 1):
            links = li.children("a")
            if not links:
                continue
            row = {"idx": i, "url": _join(url, links[0].attrs.get("href"))}
            if len(links) == 1:
                speaker, _, rest = " ".join(li.own()).strip(" :\r\n").partition("[")
                row["speaker"] = speaker.strip(" :\r\n")
                row["duration"] = rest.partition(" ")[0] if rest else None
            elif len(links) == 2:
                tail = li.text_after(links[1])
                row.update(speaker=_strip(links[1].first()), speaker_url=_join(url, links[1].attrs.get("href")),
                           duration=tail.strip(" \n")[1:6] if tail and tail != "\n" else None)
            heads = li.children("h4")
            if heads:
                link = next(iter(heads[-1].children("a")), None)
                row["next_topic"] = (heads[-1].first() or "").strip(" (")
                row["next_topic_url"] = _join(url, link.attrs.get("href")) if link else None
            out.append(row)
        return out

    return parse_pages(pages.withColumnRenamed("url", "page_url"), parse,
                       "idx int, url string, speaker string, speaker_url string, duration string, next_topic string, next_topic_url string",
                       keep, url="page_url", failed=failed)


def parse_speech_page(pages: DataFrame, term: int, *keep: str, failed: bool = False) -> DataFrame:
    """A speech page: speaker, party, links, duration, text, neighbours; a header for terms 34 and 35."""
    def table_cell(root: Node, n: int) -> Node | None:
        for div in (d for d in root.walk("div") if d.attrs.get("id") == SPEECH_DIV):
            rows = [r for t in div.children("table") for r in [*t.children("tr"), *_rows(t)]]
            cells = rows[n - 1].children("td") if len(rows) >= n else []
            return cells[1] if len(cells) > 1 else None
        return None

    def neighbour(root: Node, url: str, labels: Sequence[str]) -> str | None:
        href = next((a.attrs.get("href") for a in root.walk("a") if a.first() in labels), None)
        if not href:
            return None
        if term == 34:  # names without accents, next to the current page
            return f"{url.rsplit('/', 1)[0]}/{_norm(href).encode('ascii', 'ignore').decode()}"
        return urljoin(url, href) if term == 35 else _join(url, href)

    def parse(root: Node, url: str) -> list[dict]:
        rec = {"text": _speech_text(root, term), "header": _header(root) if term < 36 else None,
               "prev_speech_url": neighbour(root, url, PREV_LABELS), "next_speech_url": neighbour(root, url, NEXT_LABELS)}
        who = table_cell(root, 2) if term > 35 else None
        if who is not None:
            full = next(who.texts(), "")
            name, bracket, rest = full.partition("(")
            rec.update(speaker=name.strip() if bracket else full, speaker_party=rest.partition(")")[0] if bracket else None)
            link = next(iter(who.children("a")), None)
            rec["speaker_url"] = _join(url, link.attrs.get("href")) if link else None
        length = table_cell(root, 6) if term > 35 else None
        if length is not None:
            link = next(iter(length.children("a")), None)
            rec["duration"] = (link.first() if link else None) if term > 36 else length.first()
            rec["video_url"] = link.attrs.get("href") if link and term > 36 else None
        return [rec]

    return parse_pages(pages, parse, "speaker string, speaker_party string, speaker_url string, duration string, video_url string, "
                       "text string, prev_speech_url string, next_speech_url string, header string", keep, failed=failed)


def parse_bill_page(pages: DataFrame, *keep: str, failed: bool = False) -> DataFrame:
    """Title and description of a bill."""
    def parse(root: Node, _: str) -> list[dict]:
        return [{"bill_title": _strip(next((h.first() for h in root.walk("h2") if h.first()), None)),
                 "bill_details": " ".join(t for p in root.walk("p") for t in p.own()).strip()}]

    return parse_pages(pages, parse, "bill_title string, bill_details string", keep, failed=failed)
