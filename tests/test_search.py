"""Search rules on a small collection, and agreement of the two scoring ways."""

import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rostrum.operators import filters as FL, search as S
from rostrum.operators.project import copy_to_filters

DOCS = [
    ("1", "Az atomerőmű bővítése. Szó sincs róla! Az Atomeromu drága.", "Szél Éva", "LMP", "Energia", "2017.02.01.", "felszólalás"),
    ("2", "Energia és víz.", "Lázár János", "Fidesz", "atomerőmű", "2017.03.01.", "felszólalás"),
    ("3", "Nincs téma.", "Sneider Tamás", "Jobbik", "Egyéb", "2018.01.01.", "kérdés"),
    ("4", "Bővítése az atomerőmű ügyének.", "Szel Eva", None, None, "2016.01.01.", "kérdés"),
]
STOP = ["az", "és"]


@pytest.fixture(scope="module")
def index(spark):
    df = spark.createDataFrame(DOCS, "id string, text string, speaker string, speaker_party string, topic string, date_filter string, type string")
    df = df.withColumn("date", F.to_date("date_filter", "yyyy.MM.dd.")).withColumn("term", F.lit("40"))
    return S.index_documents(copy_to_filters(df), STOP)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_accents_do_not_matter(index):
    want = ["1", "2", "4"]
    for q in ("atomerőmű", "atomeromu", "ATOMERÕMÛ"):
        assert ids(S.search_hits(index, q, STOP)) == want


def test_all_terms_in_one_field(index):
    assert ids(S.search_hits(index, "atomerőmű bővítése", STOP)) == ["1", "4"]
    assert ids(S.search_hits(index, "az atomerőmű", STOP)) == ["1", "2", "4"]  # a stop word asks for nothing
    assert ids(S.search_hits(index, "energia atomerőmű", STOP)) == []  # never in one field


def test_speaker_keeps_accents_and_party_is_whole(index):
    assert ids(S.search_hits(index, "szél", STOP)) == ["1"]
    assert ids(S.search_hits(index, "fidesz", STOP)) == ["2"]
    assert ids(S.search_hits(index, "fid", STOP)) == []


def test_phrase_ranks_first(index):
    page = S.search(index, "atomerőmű bővítése", stop=STOP)[0].collect()
    assert [r["id"] for r in page] == ["1", "4"]  # the phrase outweighs the shorter field
    assert page[0]["h_text"] == ["Az <em>atomerőmű</em> <em>bővítése</em>.", "Az <em>Atomeromu</em> drága."]
    assert page[0]["h_topic"] == []


def test_score_formula(index):
    score = {r["id"]: r["score"] for r in S.bm25_score(index, "text", "víz", STOP).collect()}
    lengths = [7, 2, 2, 3]  # without stop words
    idf = math.log(1 + (4 - 1 + 0.5) / 1.5)
    assert score == {"2": pytest.approx(2.2 * idf / (1 + 1.2 * (0.25 + 0.75 * 2 / (sum(lengths) / 4))))}


def test_postings_give_the_same(spark, index, tmp_path):
    S.write_postings(S.build_postings(index), str(tmp_path / "p"))
    S.field_stats(index).write.parquet(str(tmp_path / "s"))
    postings, stats = spark.read.parquet(str(tmp_path / "p")), spark.read.parquet(str(tmp_path / "s"))
    docs = index.drop(*[c for c in index.columns if c.startswith("t_")])
    for q, kw in (("atomerőmű", {}), ("atomerőmű bővítése", {"types": ["kérdés"]}), ("lázár jános", {}), ("LMP", {})):
        a = {r["id"]: round(r["score"], 9) for r in S.search_hits(index, q, STOP, **kw).collect()}
        b = {r["id"]: round(r["score"], 9) for r in S.search_postings(postings, stats, docs, q, STOP, **kw).collect()}
        assert a == b and a


def test_filters_and_facets(index):
    page, facets, dates = S.search(index, "atomerőmű", stop=STOP, date_from="2017.01.01.", date_to="2017.12.31.", types=["felszólalás"])
    assert sorted(r["id"] for r in page.collect()) == ["1", "2"]
    got = {(r["facet"], r["value"]): r["count"] for r in facets.collect()}
    assert got == {("speakers", "Szél Éva"): 1, ("speakers", "Lázár János"): 1, ("parties", "LMP"): 1, ("parties", "Fidesz"): 1,
                   ("topics", "Energia"): 1, ("topics", "atomerőmű"): 1, ("types", "felszólalás"): 2}
    assert sorted((r["term_filter"], str(r["date"]), r["count"]) for r in dates.collect()) == [("40", "2017-02-01", 1), ("40", "2017-03-01", 1)]


def test_open_date_range(index):
    with pytest.raises(ValueError):
        FL.search_filter(date_from="2017.01.01.")
    assert S.search_hits(index, "atomerőmű", STOP, date_to="2000.01.01.").count() == 3  # ignored without a start


def test_suggestions(spark):
    df = spark.createDataFrame([("Hadházy Ákos", 10), ("Hadházy Ákos", 5), ("hadsereg", 5), ("A had", 7), ("Had-ügy", 7)], "input string, weight int")
    assert [(r["input"], r["weight"]) for r in S.suggest_prefix(df, "had").collect()] == [("Hadházy Ákos", 10), ("Had-ügy", 7), ("hadsereg", 5)]


def test_token_analysis(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    tokens = df([(1, 0, "Az"), (1, 1, "Almák"), (1, 2, "Péterek"), (1, 3, "körte")], "doc int, pos int, tok string")
    lemmas = df([("almák", "alma"), ("almák", "alm"), ("péterek", "péter")], "surface string, lemma string")
    out = S.analyze_tokens(tokens, df([("az",)], "word string"), lemmas, df([("PÉTEREK",)], "word string"))
    assert sorted((r["pos"], r["term"]) for r in out.collect()) == [(1, "alma"), (2, "peterek"), (3, "korte")]
    assert len(S.hungarian_stop_words(spark)) == 199


def test_refreshed_postings(spark, index):
    changed = S.index_documents(copy_to_filters(spark.createDataFrame([("3", "Mégis atomerőmű.", "Sneider Tamás", "Jobbik", "Egyéb", "2018.01.01.", "kérdés")],
                                "id string, text string, speaker string, speaker_party string, topic string, date_filter string, type string")), STOP)
    new = S.refresh_postings(S.build_postings(index), changed)
    assert sorted(r["id"] for r in new.filter("term = 'atomeromu'").select("id").distinct().collect()) == ["1", "2", "3", "4"]
    assert new.filter("id = '3' and term = 'tema'").count() == 0


def test_stems(spark, index, tmp_path):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    lemmas = df([("ügyének", "ügy"), ("ügyek", "ügy"), ("bővítése", "bővít"), ("bővítése", "bő"), ("Évának", "Éva")], "surface string, lemma string")
    stems = S.stem_table(lemmas, df([("évának",)], "word string"))
    assert {r["form"]: r["stem"] for r in stems.collect()} == {"ugyenek": "ugy", "ugyek": "ugy", "bovitese": "bovit"}
    terms = S.analyze_query(spark, "Ügyek bővít", STOP, stems)
    assert terms.folded == (("ugy", 0), ("bovit", 1)) and terms.forms == {"ugy": ("ugy", "ugyek", "ugyenek"), "bovit": ("bovit", "bovitese")}
    assert ids(S.search_hits(index, "ügy", STOP)) == []
    page = S.search(index, "ügyek bővít", stop=STOP, stems=stems)[0].collect()
    assert [r["id"] for r in page] == ["4"] and page[0]["h_text"] == ["<em>Bővítése</em> az atomerőmű <em>ügyének</em>."]
    S.write_postings(S.build_postings(index), str(tmp_path / "p"))
    docs = index.drop(*[c for c in index.columns if c.startswith("t_")])
    stored = S.search_postings(spark.read.parquet(str(tmp_path / "p")), S.field_stats(index), docs, "bővít", STOP, stems=stems)
    want = {r["id"]: round(r["score"], 9) for r in S.search_hits(index, "bővít", STOP, stems=stems).collect()}
    assert {r["id"]: round(r["score"], 9) for r in stored.collect()} == want and sorted(want) == ["1", "4"]


def test_one_evaluation(index):
    whole = {r["id"]: round(r["score"], 9) for r in S.search_hits(index, "atomerőmű", STOP).collect()}
    page, _, dates = S.search(index, "atomerőmű", stop=STOP)
    assert {r["id"]: round(r["score"], 9) for r in page.collect()} == whole
    assert "regexp" not in dates._jdf.queryExecution().optimizedPlan().toString()  # reads the stored hits


def test_postings_of_many_documents_come_sorted(spark):
    """Words of many documents are grouped together: by term and id, with the positions and lengths of each document."""
    texts = [(9, "b a the b"), (2, "the a"), (5, None), (7, ""), (None, "a c"), (2, "b")]
    index = S.index_documents(spark.createDataFrame(texts, "id long, text string"), ["the"]).coalesce(1)
    rows = S.build_postings(index).collect()
    want = sorted((term, i, [p for p, w in enumerate(t.split()) if w == term], sum(w != "the" for w in t.split()))
                  for i, t in texts if t and i is not None for term in {*t.split()} - {"the"})
    got = [(r.term, r.id, r.positions, r.dl) for r in rows if r.id is not None]
    assert [g[:2] for g in got] == sorted(g[:2] for g in got) and sorted(got) == want and all(r.tf == len(r.positions) and r.field == "text" for r in rows)
    assert sorted((r.term, r.positions, r.dl) for r in rows if r.id is None) == [("a", [0], 2), ("c", [1], 2)]
    texts = S.build_postings(S.index_documents(spark.createDataFrame([("é", "x"), ("a", "x")], "id string, text string"))).coalesce(1)
    assert texts.dtypes == [("id", "string"), ("field", "string"), ("dl", "int"), ("term", "string"), ("tf", "int"), ("positions", "array<int>")] and texts.count() == 2


def test_equal_words_beyond_one_number_of_64_bits():
    """Too many keys for one number are sorted in two steps, with the same rows."""
    lists = pa.array([["a", "b", "a"], ["b"], None], pa.list_(pa.string()))
    want = [x.to_pylist() for x in S._posted(pa.array([3, 1, 2]), lists)]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(S, "BITS", 1)
        assert [x.to_pylist() for x in S._posted(pa.array([3, 1, 2]), lists)] == want == [[3, 1, 3], [3, 1, 3], ["a", "b", "b"], [2, 1, 1], [[0, 2], [0], [1]]]
