"""Scalar functions on hand-made strings."""

import unicodedata
from urllib.parse import unquote_plus, urljoin

import pytest
from pyspark.sql import functions as F

from rostrum.functions import text as X


def value(spark, column, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} {'array<string>' if isinstance(v, list) else 'string'}" for c, v in cols.items()))
    return df.select(column.alias("v")).first()["v"]


def test_smart_truncate(spark):
    words = "szó " * 80
    assert value(spark, X.smart_truncate("s"), s="x" * 250) == "x" * 250
    assert value(spark, X.smart_truncate("s"), s="x" * 300) == "x" * 250 + "..."
    assert value(spark, X.smart_truncate("s"), s=words[:251]) == words[:250].rsplit(" ", 1)[0] + "..."


@pytest.mark.parametrize("raw, speaker, title, party", [
    ("Név Elek (PÁRT)", "Név Elek", None, "PÁRT"), (" Név Elek: ", "Név Elek", None, None),
    ("Elnök (Név Elek)", "Név Elek", "Elnök", None), ("ELNÖK ( Név Elek )", "Név Elek", "Elnök", None)])
def test_clean_speaker(spark, raw, speaker, title, party):
    got = value(spark, X.clean_speaker("s"), s=raw)
    assert (got["speaker"], got["title"], got["party"]) == (speaker, title, party)


@pytest.mark.parametrize("header, speaker", [
    ("2018.\n- Elnök: Név Elek -\n", "Név Elek"), ("Az elnöki széket Név Elek foglalja el", "Név Elek"), ("semmi", "elnök")])
def test_chair_from_header(spark, header, speaker):
    got = value(spark, X.chair_from_header("s", "h"), s="elnök", h=header)
    assert (got["speaker"], got["title"]) == (speaker, "elnök")
    assert value(spark, X.chair_from_header("s", "h"), s="Más Éva", h=header)["title"] is None


def test_titlecase(spark):
    for s in ("NÉV ELEK", "DR. SZABÓ-KIS ÉVA", "Név Elek", "123"):
        assert value(spark, X.titlecase_upper("s"), s=s) == (s.title() if s.isupper() else s)


def test_speaker_from_text(spark):
    got = value(spark, X.speaker_from_text("s", "t"), s=" ", t="NÉV ELEK, miniszter: Tisztelt Ház!")
    assert (got["speaker"], got["title"]) == ("Név Elek", "miniszter")
    got = value(spark, X.speaker_from_text("s", "t"), s=None, t="ELNÖK: Tisztelt Ház!")
    assert (got["speaker"], got["title"]) == ("ELNÖK", None)
    assert value(spark, X.speaker_from_text("s", "t"), s="A B", t="X: y")["speaker"] == "A B"


def test_clean_text(spark):
    raw = "A felszólalás szövege: \r\n\r\n Tisztelt Ház!  \r\n \n Köszönöm. \n"
    assert value(spark, X.clean_text("s"), s=raw) == "Tisztelt Ház!\n Köszönöm."


def test_split_name_party(spark):
    got = value(spark, X.split_name_party("s"), s="Dr. Név-Más Elek (Új Párt) x")
    assert (got["name"], got["party"]) == ("Dr. Név-Más Elek", "Új Párt")
    got = value(spark, X.split_name_party("s"), s="Név Elek")
    assert (got["name"], got["party"]) == ("Név Elek", None)


def test_speech_body(spark):
    assert value(spark, X.speech_body("s"), s="1\r\n2\r\nELNÖK: a: b\r\nc") == " a: b\nc"
    assert value(spark, X.speech_body("s"), s="1\n2\nnincs") == "nincs"
    assert value(spark, X.speech_body("s"), s="1") == ""


@pytest.mark.parametrize("raw, ids", [("12-15", [12, 13, 14, 15]), ("7", [7]), (" 8 ", [8]), ("5-3", []), ("x", None)])
def test_expand_id_range(spark, raw, ids):
    assert value(spark, X.expand_id_range("s"), s=raw) == ids


def test_urls_and_forms(spark):
    for base, href in [("http://a/b/c.htm", "d.htm"), ("http://a/b/", "../x"), ("http://a/b?q", "?r=1"), ("http://a", "http://z/")]:
        assert value(spark, X.resolve_url("b", "h"), b=base, h=href) == urljoin(base, href)
    for s in ("ﬁ Ä ²", "őű", "a b"):
        assert value(spark, X.nfkd("s"), s=s) == unicodedata.normalize("NFKD", s)
    for s in ("K%C3%A9p+x", "100%", "a%zz+b", "%41%"):
        assert value(spark, X.uri_decode("s"), s=s) == unquote_plus(s)


def test_concepts(spark):
    assert value(spark, X.concept_category("s"), s="Schema:Place,DBpedia:Place,DBpedia:City,Wikidata:Q1") == "City"
    assert value(spark, X.concept_category("s"), s="") is None
    assert value(spark, X.concept_category("s"), s="Schema:Place") is None


def test_accents(spark):
    assert value(spark, X.fix_accents("s"), s="Elõzõ ÛÕû") == "Előző ŰŐű"
    assert value(spark, X.ascii_fold("s"), s="árvíztűrő ÁŐ straße cœur") == "arvizturo AO strasse coeur"
    assert value(spark, X.topic_label("s"), s="3") == "Topic 03"
    assert value(spark, X.topic_label("s"), s="123") == "Topic 123"


def test_topic_or_pair(spark):
    assert value(spark, X.topic_or_pair("t", F.lit(False)), t=[" a "]) == ["a"]
    assert value(spark, X.topic_or_pair("t", F.lit(True)), t=[" a ", "b"]) == ["a"]
    assert value(spark, X.topic_or_pair("t", F.lit(False)), t=["a", ' "b', 'c"\r\n']) == ["a", "b c"]
