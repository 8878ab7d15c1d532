"""Inputs of extreme length or depth, and broken ones, end no job."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from rostrum import session
from rostrum.operators import annotate as N, html as H
from rostrum.sources import files


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "c string").select(fn(F.col("c"))).first()[0]


def test_markup_of_any_length_and_depth(spark):
    assert one(spark, "a [[File:" + "x" * 1_000_000 + "]] b", N.strip_markup) == "a  b"
    assert one(spark, "a " + "{{t|" * 50 + "x" + "}}" * 50 + "b", N.strip_markup) == "a b"
    assert one(spark, "[[Image:i.png|see [[Ada|Ada L.]] and " + "[[b]] " * 5000 + "]]c [[File", N.strip_markup) == "c [[File"
    assert one(spark, "{{open {{shut}} {| x {| y |} |} [[Kép:a|b]] [[c|d]]", N.strip_markup) == "{{open   d".replace("   ", "    ")
    assert one(spark, None, N.strip_markup) is None


def test_triple_with_long_literal(spark):
    long = "x\\u0151 " * 150_000
    lines = spark.createDataFrame([(f'<s> <p> "{long}"@hu .',), ('<s> <p> "a \\"b\\" c"^^<t> .',), ("# note",)], "value string")
    rows = files.parse_triples(lines).collect()
    assert [len(r.o) for r in rows] == [len(long), len('a \\"b\\" c')]


def test_deep_page_and_broken_archive(spark):
    page = "<p>start</p>" + "<font>" * 100_000 + "<p>deep</p>"
    rows = H.extract_page_text(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"), 35, "page_id").collect()
    assert rows[0].text == "start deep"
    good = io.BytesIO()
    with zipfile.ZipFile(good, "w") as z:
        z.writestr("d/h1.txt", "text")
    archives = spark.createDataFrame([("a.zip", bytearray(b"no archive")), ("b.zip", bytearray(good.getvalue()))], "path string, content binary")
    texts, bad = files.zip_texts(archives)
    assert [r.Hash for r in texts.collect()] == ["h1"]
    assert [(r.archive, r.error.split(":")[0]) for r in bad.collect()] == [("a.zip", "BadZipFile")]


def test_links_in_any_form(spark):
    page = "<a href='/a'>A</a><a class=x href=/b>B &amp;amp;</a><a href=\"/c?x=1&amp;y=2\">El&#337;z&#x151; &eacute;&nosuch;</a><a name=n>no</a>"
    pages = spark.createDataFrame([(1, page), (2, "none"), (3, None)], "page_id long, html string")
    rows = H.extract_links(pages, "page_id").orderBy("pos").collect()
    assert [(r.href, r.anchor) for r in rows] == [("/a", "A"), ("/b", "B &amp;"), ("/c?x=1&y=2", "Előző é&nosuch;")]
    hit = H.link_by_text(pages, ["Előző é&nosuch;", "A"], "page_id")
    assert [(r.page_id, r.href) for r in hit.collect()] == [(1, "/a")]
    assert "Exchange" not in hit._jdf.queryExecution().executedPlan().toString()


def test_scratch_folder_must_be_shared(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.shared_root(Session())
    Context.getCheckpointDir = lambda self: "hdfs:///shared"
    assert session.shared_root(Session()) == "hdfs:///shared"


def test_broken_pages_are_rejects(spark, monkeypatch):
    """Marked sections of any kind are skipped; whatever a page raises, the others keep their rows and it becomes a reject."""
    assert "".join(H.tree("<p>a<![bogus foo]]>b</p>").texts()) == "ab" and "".join(H.tree("<p>a</p><![CDATA[x]]>b").texts()) == "ab"
    bad = ["<p>a<![bogus foo]]>b</p>", "<![ [", "<![", "<!", "<!-", "</", "<a href='", "<p>" * 5000]
    rows = [(i, f"http://x/{i}", h) for i, h in enumerate([*bad, None, ""])] + [(50, "http://[", "<ul><li><a href='y'>x</a> [1:00 perc]</li></ul><a href='z'>Következő</a>")]
    pages = spark.createDataFrame([(*r, 40, "7", "40-7") for r in rows], "page_id int, url string, html string, term int, sitting_nr string, sitting_uid string")
    parsers = [lambda p, **k: H.extract_page_text(p, 34, "page_id", **k), lambda p, **k: H.extract_header(p, "page_id", **k), lambda p, **k: H.parse_sitting_list(p, 40, "page_id", **k),
               lambda p, **k: H.parse_sitting_toc(p, **k), lambda p, **k: H.parse_toc_list_34(p, "page_id", **k), lambda p, **k: H.parse_toc_list_35(p, "page_id", **k),
               lambda p, **k: H.parse_speech_page(p, 40, "page_id", **k), lambda p, **k: H.parse_bill_page(p, "page_id", **k)]
    for parse in parsers:
        assert parse(pages).count() >= 0 and parse(pages, failed=True).collect() == []
    rejects = H.parse_speech_page(pages, 35, "page_id", failed=True).collect()
    assert [(r.page_id, r.url, r.error.partition(":")[0]) for r in rejects] == [(50, "http://[", "ValueError")]
    assert 50 not in {r.page_id for r in H.parse_speech_page(pages, 35, "page_id").collect()}
