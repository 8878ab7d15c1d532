"""Page extraction on hand-made pages."""

from rostrum.operators import html as H
from rostrum.operators.ordered import carry_header, carry_topic_forward

TABLE = "<table><tbody>{}</tbody></table>"


def pages(spark, html, url="http://x/d/p.htm", **cols):
    return spark.createDataFrame([(url, html, *cols.values())], ", ".join(["url string", "html string", *[f"{c} string" for c in cols]]))


def row(cells):
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


def test_sitting_list_terms(spark):
    tail = ["tavaszi", "rendes", "1", '<a href="#">8:00</a>', "9:00", "12", "3", "megj"]
    head = ['<a href="/s">2003.02.04.(5)</a>', " kedd "]
    for term, cells in ((36, head + tail), (37, head + ["v"] + tail), (38, head + ['<a href="/v">V</a>'] + tail)):
        got = H.parse_sitting_list(pages(spark, TABLE.format(row(cells) + row(["összesen", "x"]))), term).collect()
        assert len(got) == 1
        g = got[0]
        assert (g["date"], g["sitting_nr"], g["sitting_uid"], g["day"], g["session"], g["duration_raw"], g["sitting_day"], g["note"]) == (
            "2003.02.04.", "5", f"{term}-5", "kedd", "tavaszi", "8:00", "3", "megj")
        assert (g["video_url"], g["video_time"]) == (("/v", "V") if term == 38 else (None, None))


def test_list_35_topic_rules(spark):
    html = ('<ul><li><a href="1">1</a>A B: <li><a href="2">2</a>C<h4>Első (<a href="b1">x</a></h4>'
            "<li>nincs<h4>kihagyva</h4><li><a href=\"4\">4</a>D [10:20 p]<h4>Második</h4><li><a href=\"5\">5</a> E</ul>")
    rows = carry_topic_forward(H.parse_toc_list_35(pages(spark, html, s="35-1"), "s"), "s", "idx", "next_topic", url="next_topic_url")
    got = [(r["idx"], r["speaker"], r["duration"], r["topic"], r["bill_url"]) for r in rows.orderBy("idx").collect()]
    assert got == [(1, "A B", None, "", ""), (2, "C", None, "", ""), (4, "D", "10:20", "Első", "http://x/d/b1"), (5, "E", None, "Második", "")]


def test_list_34_index_advances(spark):
    got = H.parse_toc_list_34(pages(spark, '<ul><li>cím<li><a href="a.htm">1</a> Név Elek \n</ul>')).collect()
    assert [(r["idx"], r["url"], r["speaker"]) for r in got] == [(2, "http://x/d/a.htm", "Név Elek")]


def test_toc_ranges(spark):
    html = ('<html><body><div class="pair-content"><table><thead><tr><th>Cím<a href="/b">T/1</a> javaslat</th></tr></thead><tbody>'
            + row(['<a href="x">12-15</a>', "", "felszólalás", "<i>B</i>", "9:00"]) + row(["nincs"]) + row(['<a href="y">7</a>', "", "v", "", ""])
            + "</tbody></table></div></body></html>")
    got = H.parse_sitting_toc(pages(spark, html, term="40", sitting_nr="3", sitting_uid="40-3")).orderBy("idx").collect()
    assert [r["id"] for r in got] == ["40-3-7", "40-3-12", "40-3-13", "40-3-14", "40-3-15"]
    assert (got[1]["topic"], got[1]["bill_title"], got[1]["bill_url"], got[1]["committee"]) == (["Cím"], ["T/1  javaslat"], ["http://x/b"], "B")


def test_speech_page_36_has_no_video(spark):
    table = "<table>" + "".join(f"<tr><td>{i}</td><td>{c}</td></tr>" for i, c in enumerate(["", "Név Elek", "", "", "", "4:30"])) + "</table>"
    html = f'<div class="pair-content"><div id="egy_felszolalas">{table}</div><div>A <b>B</b></div><div>C</div></div><a href="n.htm">Következő</a>'
    g = H.parse_speech_page(pages(spark, html), 36).first()
    assert (g["speaker"], g["speaker_party"], g["duration"], g["video_url"], g["text"], g["next_speech_url"], g["prev_speech_url"]) == (
        "Név Elek", None, "4:30", None, "A BC", "http://x/d/n.htm", None)


def test_paragraph_text_keeps_own_words_only(spark):
    html = "<pre>\n Fej - Elnök: X - \n</pre><p>Egy<b>ki</b>kettő<p>három"
    g = H.parse_speech_page(pages(spark, html), 34).first()
    assert (g["text"], g["header"]) == ("Egy kettő három", "Fej - Elnök: X -")


def test_links(spark):
    html = '<!-- <a href="no">x</a> --><a class=b href="/a?x=1&amp;y=2"><b>El</b>őző</a><a href="/c">Előző</a><a name="z">n</a>'
    got = H.extract_links(pages(spark, html), "url").orderBy("pos").collect()
    assert [(r["href"], r["anchor"]) for r in got] == [("/a?x=1&y=2", "Előző"), ("/c", "Előző")]
    assert H.link_by_text(pages(spark, html), H.PREV_LABELS, "url").first()["href"] == "/a?x=1&y=2"
    assert H.term_label(1998) == "1998-2002" and H.term_label(2018, current=True) == "2018-"


def test_header_reaches_all_speeches(spark):
    df = spark.createDataFrame([("34-1", 1, "h"), ("34-1", 2, None), ("34-1", 3, None), ("34-2", 1, None)], "sitting_uid string, idx int, header string")
    assert sorted((r["sitting_uid"], r["idx"], r["header"]) for r in carry_header(df).collect()) == [
        ("34-1", 1, "h"), ("34-1", 2, "h"), ("34-1", 3, "h"), ("34-2", 1, None)]


def test_given_pages_text(spark):
    """On the given pages the text holds every heading word, and no script."""
    p = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = H.extract_page_text(p, 34, "page_id")
    assert got.count() == p.count()
    assert got.filter("contains(text, 'track(')").count() == 0
