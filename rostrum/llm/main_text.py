"""Operator 13: the main text of a page by composite text density.

For every node of the page's tree the density is its characters per tag, raised where few of them are link characters: with C characters, LC of
them in links, T tags and LT link tags below the node, and Cb, LCb those of the body,

    density = C / T * log(C / LC * T / LT) / log(ln(C / (C - LC) * LC + LCb / Cb * C + e))

(counts of 0 in a divisor are 1; on a page without links it is C / T). The density sum of a node adds up the densities of its children, its own
direct text, with the inline elements in it, being one of them. The node with the largest sum is the heart of the article; the smallest density on its path to the body, the body
left out as its menus would lower it, is the threshold. Every node above it contributes the node with the largest sum below it, and the smallest subtree with all of these, or the article
element around the heart, is the content. What its element or name marks as something else takes no part.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rostrum.llm.fixed import bounded_batches

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?)?)*+)>"""
                   r"""|<[!?/][^>]*+>?""", re.S)
LOOSE = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>[^>]*+)>?|<[!/?][^>]*+>?", re.S)
ATTR = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""")
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Element names of HTML, and the words by which pages name what is not their article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
HEAD = set("title meta link style script base noscript template".split())
BLOCK = set("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
            "header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - set("body br button caption dd dt html legend li optgroup option select tbody td tfoot th thead tr".split()) | {"li", "dd", "dt"}
SIBLING = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"})}
DROPPED = set("nav footer aside form head title script style noscript template iframe object svg button select textarea dialog menu dir xmp noembed noframes search".split())
CONTENT = {"article", "main"}
STANDS_ALONE = set("p h1 h2 h3 h4 h5 h6 blockquote pre figure dl".split())
NAMED = set("ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
            "sidebar footer header masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription share sharing social related "
            "recommended comment comments disqus reply replies respond pagination pager toolbar login signup contentinfo complementary search alert alertdialog "
            "dialog".split())


def _named(attrs: str) -> bool:
    """Do class, id or role name something other than an article, or is the element hidden?"""
    for name, value in ATTR.findall(attrs) if attrs else ():
        name = name.lower()
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if name in ("class", "id", "role") and any(p.lower() in NAMED for p in PIECE.findall(value)):
            return True
    return False


class Page:
    """The nodes of a page in document order; node 0 is the body. ``texts`` holds (node, text) and (node, None) for a border of a block."""

    def __init__(self, source: str):
        self.tag, self.parent, self.named, self.last = ["body"], [-1], [False], [0]
        self.texts: list[tuple[int, str | None]] = []
        self._open = [0]
        self._count: dict[str, int] = {}
        self._read(source)
        for node in range(len(self.tag) - 1, 0, -1):  # the last node of each subtree
            up = self.parent[node]
            self.last[up] = max(self.last[up], self.last[node])

    def _text(self, raw: str) -> None:
        if self._count.get("head") and raw.strip():
            self._close("head")
        self.texts.append((self._open[-1], html.unescape(raw)))

    def _start(self, tag: str, attrs: str) -> None:
        if self._count.get("head") and tag not in HEAD:
            self._close("head")
        if tag in CLOSES_P and self._count.get("p"):
            self._close("p", {"table", "td", "th", "caption", "button", "object"})
        if tag in SIBLING:
            own, around = SIBLING[tag]
            for other in own:
                if self._count.get(other):
                    self._close(other, around)
        if tag in BLOCK:
            self.texts.append((self._open[-1], None))
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self._open[-1])
        self.named.append(_named(attrs))
        self.last.append(node)
        if tag not in VOID:
            self._open.append(node)
            self._count[tag] = self._count.get(tag, 0) + 1

    def _close(self, tag: str, within: set[str] = frozenset()) -> None:
        """Close the innermost open element of this name, with what is open in it, unless one of ``within`` lies between."""
        at = len(self._open) - 1
        inline = tag not in BLOCK and tag not in DROPPED
        while at > 0 and self.tag[self._open[at]] != tag:
            other = self.tag[self._open[at]]
            if other in within or inline and other in BLOCK:
                return
            at -= 1
        if at == 0:
            return
        for node in self._open[at:]:
            self._count[self.tag[node]] -= 1
            if self.tag[node] in BLOCK:
                self.texts.append((self.parent[node], None))
        del self._open[at:]

    def _read(self, source: str) -> None:
        at, n, pattern = 0, len(source), TOKEN
        while at < n:
            less = source.find("<", at)
            if less < 0:
                self._text(source[at:])
                return
            if less > at:
                self._text(source[at:less])
            m = pattern.match(source, less)
            if m is None and pattern is TOKEN and source[less + 1: less + 2].isalpha():
                pattern = LOOSE  # a quote that never ends: from here on a tag ends at the next >
                m = LOOSE.match(source, less)
            if m is None:
                self._text("<")
                at = less + 1
                continue
            at = m.end()
            if not m["tag"]:
                continue
            tag, end, attrs = m["tag"].lower(), m["end"], m["attrs"]
            if tag in ("html", "body"):
                if self._count.get("head"):
                    self._close("head")
            elif end:
                if self._count.get(tag):
                    self._close(tag)
            else:
                self._start(tag, attrs)
                if tag in RAW:
                    stop = re.compile("</" + tag + r"(?=[\s/>])", re.I).search(source, at)
                    if stop:
                        at = stop.start()
                    elif tag != "title":
                        return


def _density(c: int, lc: int, t: int, lt: int, share: float) -> float:
    if not c:
        return 0.0
    t = max(t, 1)
    if not share:
        return c / t
    base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
    return c / t * math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0)) / math.log(base)


def main_text(source: str | None) -> str:
    """The article of a page as one line; empty if there is none."""
    if not source:
        return ""
    page = Page(source)
    n, tag, parent, last = len(page.tag), page.tag, page.parent, page.last
    # A name condemns an element only if it does not hold the article or its title.
    holds = [False] * n
    for node in range(n - 1, 0, -1):
        holds[node] |= tag[node] in CONTENT | {"h1"} and not page.named[node]
        holds[parent[node]] |= holds[node]
    out, inside, link = [False] * n, [False] * n, [False] * n
    for node in range(1, n):
        up, name = parent[node], tag[node]
        inside[node] = inside[up] or name in CONTENT and not page.named[node]
        link[node] = link[up] or name == "a"
        weak = page.named[node] or name in ("form", "button")
        out[node] = out[up] or name in DROPPED - {"form", "button"} or weak and not holds[node] or name == "header" and not inside[node]
    block = list(range(n))  # the block around an inline element; its text and tags are that block's own
    for node in range(1, n):
        if tag[node] not in BLOCK:
            block[node] = block[parent[node]]
    own, own_link, own_tags, own_links = [0] * n, [0] * n, [0] * n, [0] * n
    c, lc, t, lt = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in page.texts:
        if text is not None and not out[node]:
            size = len(" ".join(text.split()))
            for at, chars, linked in ((node, c, lc), (block[node], own, own_link)):
                chars[at] += size
                linked[at] += size if link[node] else 0
    for node in range(n - 1, 0, -1):
        if not out[node]:
            up, a = parent[node], int(tag[node] == "a")
            c[up], lc[up] = c[up] + c[node], lc[up] + lc[node]
            t[up], lt[up] = t[up] + t[node] + 1, lt[up] + lt[node] + a
            if block[node] != node:
                own_tags[block[node]] += 1
                own_links[block[node]] += a
    if not c[0]:
        return ""
    share = lc[0] / c[0]
    density = [0.0 if out[i] else _density(c[i], lc[i], t[i], lt[i], share) for i in range(n)]
    total = [0.0 if out[i] or block[i] != i else _density(own[i], own_link[i], own_tags[i], own_links[i], share) for i in range(n)]
    for node in range(n - 1, 0, -1):
        if block[node] == node:
            total[block[parent[node]]] += density[node]
    heart = max(range(n), key=lambda i: (total[i], -i))
    path = [heart]
    while path[-1]:
        path.append(parent[path[-1]])
    least = min(density[i] for i in path[:-1] or path)  # the body's own density counts only where the body is the heart
    article = next((i for i in reversed(path) if tag[i] == "article" and not page.named[i]), None)
    best, marks = list(range(n)), [heart]
    for node in range(n - 1, -1, -1):
        if node and not out[node] and block[node] == node and density[node] >= least:
            marks.append(best[node])
        if node and total[best[node]] >= total[best[parent[node]]]:
            best[parent[node]] = best[node]
    first, end = min(marks), max(marks)
    root = article if article is not None else next(i for i in path if i <= first and end <= last[i])
    keep = [False] * n  # nodes with a marked one below
    for node in marks:
        while node > root and not keep[node]:
            keep[node] = True
            node = parent[node]
    if article is None:
        # Blocks before the first and after the last marked child are not of the article, unless they are plain paragraphs or headings.
        inner = [i for i in range(root + 1, last[root] + 1) if parent[i] == root]
        kept = [k for k, i in enumerate(inner) if keep[i]]
        for k, i in enumerate(inner):
            if kept and not kept[0] <= k <= kept[-1] and tag[i] in BLOCK - STANDS_ALONE:
                out[i] = True
    for node in range(root + 1, last[root] + 1):
        menu = tag[node] in ("ul", "ol", "div", "table", "section") and not keep[node] and lt[node] > 2 and 2 * lc[node] > c[node]
        out[node] |= parent[node] >= root and out[parent[node]] or menu
    words = [" " if text is None else text for node, text in page.texts if root <= node <= last[root] and not out[node]]
    return " ".join("".join(words).split())


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row: the article's text in page order and its code points.

    References are decoded; white space of any kind inside a block, and between blocks, is one space. A null, empty or blank page, and one without
    any text of its own, has the empty text. Whole pages are read, whatever their length; unclosed elements, comments, scripts and quotes
    end as a browser ends them. Rows that repeat an id are pages of their own. An empty table has no result; further columns are not read.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(source).cast("string").alias("html"))

    def kernel(batches):
        for batch in batches:
            texts = [main_text(v) for v in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(kernel, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
