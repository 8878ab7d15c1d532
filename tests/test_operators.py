"""Ordered operators, similarity, topics, annotation and streaming against brute force or invariants."""

import datetime as dt
import json
import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rostrum.operators import aggregates as A, annotate as N, filters as FL, joins as J, ordered as O, similarity as E, topics as TM
from rostrum.operators import project as P
from rostrum.plans.records import PERIODS
from rostrum.session import cut_lineage
from rostrum.sources import sinks as K
from rostrum.streaming import ingest


@pytest.fixture(scope="module")
def sittings(spark):
    """One sitting holds most rows; positions have gaps."""
    rnd = random.Random(3)
    rows = []
    for s in range(6):
        for i in sorted(rnd.sample(range(1, 4000), 1500 if s == 0 else 20)):
            topic = f"t{i}" if rnd.random() < 0.02 else None
            rows.append((f"36-{s}", i, f"u{i}", topic, f"b{i}" if topic and rnd.random() < 0.5 else None))
    return rows, spark.createDataFrame(rows, "sitting_uid string, idx int, url string, topic string, href string")


@pytest.mark.parametrize("block", [7, 500, O.BLOCK])
def test_blocks_do_not_show(sittings, block):
    rows, df = sittings
    want, state = {}, {}
    for s, i, u, topic, href in rows:
        count, (t, b), last = state.get(s, (0, ("", ""), None))
        want[s, i] = [count + 1, t, b, last, None]
        if last is not None:
            want[s, int(last[1:])][4] = u
        state[s] = (count + 1, (topic, href or "") if topic else (t, b), u)
    n = {(r["sitting_uid"], r["idx"]): r["n"] for r in O.speech_index(df, order="idx", out="n", block=block).collect()}
    t = {(r["sitting_uid"], r["idx"]): r for r in O.carry_topic_forward(df, url="href", block=block).collect()}
    p = {(r["sitting_uid"], r["idx"]): r for r in O.prev_next_speech(df, block=block).collect()}
    got = {k: [n[k], t[k]["topic"], t[k]["bill_url"], p[k]["prev_speech_url"], p[k]["next_speech_url"]] for k in want}
    assert got == want and len(n) == len(rows)


def test_periods_are_open(spark):
    df = spark.createDataFrame([(dt.date(2002, 1, 1),), (dt.date(2002, 1, 2),), (dt.date(1998, 1, 1),), (dt.date(2030, 1, 1),)], "Date date")
    got = sorted(str(r["p"]) for r in df.select(FL.period_label("Date", PERIODS).alias("p")).collect())
    assert got == ["2002", "2014", "None", "None"]


def test_cooccurrence_pads(spark):
    df = spark.createDataFrame([(["1", "12", "3"],), (["3", "1", "0"],)], "topics array<string>")
    got = {(r["source"], r["target"]): r["weight"] for r in A.topic_cooccurrence(df, 24).collect()}
    assert len(got) == 24 * 23 // 2 and sum(got.values()) == 6
    assert got["01", "03"] == 2 and got["01", "12"] == 1 and got["03", "12"] == 1 and got["00", "01"] == 1 and got["05", "06"] == 0


def test_bills(spark):
    sp = spark.createDataFrame([("1", "u"), ("2", ""), ("3", None), ("4", "gone")], "id string, bill_url string")
    bills = spark.createDataFrame([("u", "T", "D")], "bill_url string, bill_title string, bill_details string")
    assert {r["id"]: r["bill_title"] for r in J.join_bill_left(sp, bills).collect()} == {"1": "T", "2": None, "3": None, "4": None}


def test_similarity_blocks_agree(spark):
    rnd = random.Random(5)
    bag = [(d, f"w{w}", rnd.randint(1, 4)) for d in range(30) for w in rnd.sample(range(60), 15)]
    given = spark.createDataFrame(bag, "item_id bigint, term string, tf bigint")
    concepts = E.tfidf(given, spark.range(30), "item_id")
    joined = E.tfidf(given, spark.range(30), "item_id", max_rows=5)
    assert sorted((r["item_id"], r["term"], round(r["w"], 9)) for r in concepts.collect()) == sorted(
        (r["item_id"], r["term"], round(r["w"], 9)) for r in joined.collect())
    norms = concepts.groupBy("item_id").agg(F.sum(F.col("w") * F.col("w")).alias("n")).collect()
    assert all(abs(r["n"] - 1) < 1e-9 for r in norms)
    docs = spark.createDataFrame([(d + 100, t, n) for d, t, n in bag], "doc_id bigint, term string, tf bigint")
    one = E.esa_top_concepts(docs, concepts, k=3).collect()
    many = E.esa_top_concepts(docs, concepts, k=3, max_rows=60).collect()
    key = lambda rows: sorted((r["doc_id"], r["rank"], r["item_id"], round(r["score"], 9)) for r in rows)
    assert key(one) == key(many)
    best = {r["doc_id"]: r for r in one if r["rank"] == 1}
    assert all(r["item_id"] == d - 100 and abs(r["score"] - 1) < 1e-9 for d, r in best.items())


def test_similarity_tile_holds_few_products():
    """Common terms make many products per weight; the memory of a tile follows its rows."""
    rng = np.random.default_rng(1)
    x = pd.DataFrame({"doc_id": np.repeat(np.arange(4000), 10), "term": [f"w{i}" for _ in range(4000) for i in range(10)], "_dw": rng.random(40_000)})
    y = pd.DataFrame({"item_id": np.repeat(np.arange(100), 10), "term": [f"w{i}" for _ in range(100) for i in range(10)], "_cw": rng.random(1000)})
    tracemalloc.start()
    got = E._tile(x, y, 3, "doc_id", "item_id", "term")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100_000_000
    want = x["_dw"].to_numpy().reshape(4000, 10) @ y["_cw"].to_numpy().reshape(100, 10).T
    assert len(got) == 12_000 and np.allclose(got["score"].to_numpy().reshape(4000, 3), -np.sort(-want, axis=1)[:, :3])


def test_topic_model(spark):
    docs = spark.createDataFrame([(i, ["alma", "körte"] * 5 if i % 2 else ["busz", "vonat"] * 5) for i in range(40)], "doc_id bigint, toks array<string>")
    vocab = TM.vocabulary_list(A.word_count(docs, "toks"))
    vectors = TM.vectorize(docs, vocab)
    model = TM.fit_lda(vectors, k=3, min_steps=15)
    d = TM.topic_distribution(model, vectors, min_prob=0.0)
    sums = d.groupBy("doc_id").agg(F.sum("prob").alias("s"), F.count("*").alias("n")).collect()
    assert len(sums) == 40 and all(abs(r["s"] - 1) < 1e-6 and r["n"] == 3 for r in sums)
    words = TM.topic_top_words(model, vocab, 2)
    assert words.count() == 6 and words.select("topic").distinct().count() == 3
    assert O.top_topics_per_doc(d, 2).count() == 80
    rel = TM.topic_relevance(model, vocab, A.word_count(docs, "toks"), d, TM.vector_lengths(vectors))
    shares = rel.select("topic", "prevalence").distinct().agg(F.sum("prevalence")).first()[0]
    assert rel.count() == 12 and abs(shares - 1) < 1e-6
    assert TM.topic_edges(d, 3).agg(F.sum("weight")).first()[0] == 40 * 3
    with pytest.raises(ValueError):
        TM.vocabulary_list(A.word_count(docs, "toks"), limit=3)


def test_word_groups_become_topics(spark):
    groups = [["alma", "körte", "szilva", "meggy"], ["busz", "vonat", "villamos", "hajó"]]
    docs = spark.createDataFrame([(i, [groups[i % 2][(i * 7 + j * j) % 4] for j in range(30)]) for i in range(200)], "doc_id bigint, toks array<string>")
    vocab = TM.vocabulary_list(A.word_count(docs, "toks"))
    vectors = cut_lineage(TM.vectorize(docs, vocab))
    top = TM.topic_distribution(TM.fit_lda(vectors, k=2), vectors).filter("prob > 0.95").collect()
    assert len(top) == 200 and len({(r["doc_id"] % 2, r["topic"]) for r in top}) == 2


def test_vocabulary_table(spark):
    counts = spark.range(1000).select(F.concat(F.lit("w"), "id").alias("term"), (F.col("id") % 7).alias("freq"))
    index = TM.index_vocabulary(counts.repartition(5))
    assert [r["term"] for r in index.orderBy("idx").collect()] == TM.vocabulary_list(counts)
    assert sorted(r["idx"] for r in index.collect()) == list(range(1000))
    docs = spark.createDataFrame([(1, ["w3", "w3", "w9", "x"]), (2, ["x"]), (3, [])], "doc_id bigint, toks array<string>")
    key = lambda rows: sorted((r["doc_id"], r["term"], r["tf"]) for r in rows)
    rows = key(TM.term_vectors(docs, index).collect())
    assert rows == [(1, "w3", 2), (1, "w9", 1)] == key(TM.vector_terms(TM.vectorize(docs, vocab := TM.vocabulary_list(counts)), vocab).collect())
    assert TM.index_vocabulary(counts.limit(0)).count() == 0


def test_annotator_errors(spark):
    def factory():
        def tag(text):
            if "rossz" in text:
                raise RuntimeError("no")
            return [{"text": w, "tag": "W"} for w in text.split()]
        return tag

    df = spark.createDataFrame([("a", "x y"), ("b", None), ("c", "rossz"), ("d", "")], "Hash string, Text string")
    out = {r["Hash"]: [a["text"] for a in r["annotations"]] for r in N.annotate(df, factory, "Text", "text:string,tag:string").collect()}
    assert out == {"a": ["x", "y"], "b": [], "c": [], "d": []}


def test_sentences_and_markup(spark):
    df = spark.createDataFrame([("k", "Egy, kettő. Három!\n\nNégy? öt")], "id string, t string")
    got = [r["sentence"] for r in N.split_sentences(df, "t", "id").orderBy("nr").collect()]
    assert got == ["Egy , kettő .", "Három !", "Négy ?", "öt"]
    wiki = ("{{Infobox\n| a = {{b|c}}\n}}\n'''Duna''' egy [[folyó|nagy folyó]] és [[víz]].<ref>x</ref> <!-- y -->\n== Cím ==\n"
            "{| class=x\n| cella\n|}\n* pont\n[[Fájl:a.jpg|thumb|[[Duna]] képe]][http://x leírás] a&nbsp;b")
    row = spark.createDataFrame([(wiki,)], "w string").select(N.strip_markup(F.col("w")).alias("v"), N.drop_table_rows(F.col("w")).alias("d")).first()
    assert row["v"] == "Duna egy nagy folyó és víz. \nCím\n\npont\nleírás a b"
    assert "cella" not in row["d"] and "Duna" in row["d"]


def test_hot_token_lookup(spark):
    """One token makes up most rows; every row keeps its lemma."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("tok"))
    lemmas = spark.createDataFrame([("hot", "h"), ("hot", "ho"), ("w1", "x")], "surface string, lemma string")
    got = {r["lemma"]: r["n"] for r in N.lemmatize_lookup(df, lemmas, spark.createDataFrame([("none",)], "word string"))
           .groupBy("lemma").agg(F.count("*").alias("n")).collect()}
    assert got["ho"] == 18_000 and sum(got.values()) == 20_000


def write_lines(path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")


def test_stream_equals_batch(spark, tmp_path):
    src, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()
    schema = "id string, seq int, term string, sitting_nr string"
    first = [{"id": f"40-{i}", "seq": 0, "term": "40", "sitting_nr": str(i % 3)} for i in range(10)]
    second = [{"id": "40-1", "seq": 2, "term": "40", "sitting_nr": "7"}, {"id": "40-1", "seq": 1, "term": "40", "sitting_nr": "6"},
              {"id": "40-x", "seq": 0, "term": "40", "sitting_nr": "8"}]
    for n, rows in enumerate((first, second)):
        write_lines(src / f"{n}.json", rows)
        ingest.stream_ingest(spark, str(src), target, check, schema, files_per_trigger=1).awaitTermination()
    ingest.stream_ingest(spark, str(src), target, check, schema).awaitTermination()  # nothing new
    got = sorted(tuple(r[c] for c in ("id", "seq", "sitting_nr")) for r in ingest.current(spark, target).collect())
    batch = J.upsert_by_id(spark.createDataFrame(first, schema), spark.createDataFrame(second, schema))
    assert got == sorted(tuple(r[c] for c in ("id", "seq", "sitting_nr")) for r in batch.collect())
    crawl = spark.createDataFrame([("40", str(i)) for i in range(9)] + [("39", "1")], "term string, sitting_nr string")
    assert sorted(r["sitting_nr"] for r in ingest.new_sittings(spark, crawl, target, 40).collect()) == ["3", "4", "5", "6"]
    ingest.compact(spark, target, str(tmp_path / "compact"))
    assert ingest.current(spark, str(tmp_path / "compact")).count() == 11


def test_checkpoint_is_reliable(spark):
    df = cut_lineage(spark.range(5).withColumn("x", F.rand()))
    assert "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
    assert df.collect() == df.collect()


def test_lemmatized_vocabulary(spark):
    df = spark.createDataFrame([("Kutya_NOUN  fut_VERB szép_nagy_ADJ x y_noun",)], "t string")
    assert df.select(FL.keep_pos(F.col("t")).alias("v")).first()["v"] == ["kutya", "szép_nagy", "y"]
    docs = spark.createDataFrame([(["a"] * 9 + ["b"] * 7 + ["c"] * 6 + ["adat"] * 8 + ["d"],)], "toks array<string>")
    from rostrum.functions.wordlists import TOPIC_STOP_WORDS

    vocab = A.build_vocabulary(docs, "toks", TOPIC_STOP_WORDS, min_count=5, skip_top=1)
    assert sorted((r["term"], r["freq"]) for r in vocab.collect()) == [("b", 7), ("c", 6)]
    tagged = spark.createDataFrame([("Kutya_NOUN fut_VERB kutya_NOUN fut_VERB szép_ADJ",)], "t string")
    assert [tuple(r) for r in A.build_vocabulary(tagged, "t", min_count=1, skip_top=0, pos=FL.GOOD_POS).collect()] == [("kutya", 2)]


def test_clean_speech(spark):
    rows = [("Elnök: ", "Ülés - Elnök: Szili Katalin - jegyzők", "A felszólalás szövege: Köszönöm.\r\n\r\nKezdjük! ", ["  T/1 ", "T/2\n"]),
            ("ELNÖK (Kövér László)", "Az elnöki széket Más Valaki foglalja el", "\u00a0", None), ("KISS PÁL", None, None, []), (None, "x", "y", ["z"])]
    df = spark.createDataFrame(rows, "speaker string, header string, text string, bill_title array<string>").withColumn("n", F.monotonically_increasing_id())
    got = [(r["speaker"], r["speaker_title"], r["speaker_party"], r["text"], r["bill_title"]) for r in P.clean_speech(df).orderBy("n").collect()]
    assert got == [("Szili Katalin", "Elnök", None, "Köszönöm.\nKezdjük!", ["T/1", "T/2"]), ("Kövér László", "Elnök", None, None, None),
                   ("Kiss Pál", None, None, None, None), (None, None, None, "y", ["z"])]


def test_alias_of_other_sessions(spark, tmp_path):
    path = str(tmp_path)
    for v in (1, 2):
        K.publish_version(spark, spark.range(v), path, v, "talks")
    other = spark.newSession()
    assert K.current_version(other, path, "talks").count() == 2
    K.point_alias(other, path, 1, "talks")
    assert K.current_version(spark, path, "talks").count() == 1
    with pytest.raises(ValueError):
        K.current_version(spark, path, "none")


def test_gazetteer_lengths(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "c"]), (2, None), (3, []), (4, ["c", None, "a"])], "doc int, toks array<string>")
    phrases = spark.createDataFrame([("a", "X"), ("a b c", "Y"), ("b c d", "Z"), ("c", "X"), ("c", "X")], "phrase string, tag string")
    got = sorted(tuple(r) for r in N.gazetteer_entities(docs, phrases, "toks", ["doc"]).collect())
    assert got == [(1, 0, "a", "X"), (1, 0, "a b c", "Y"), (1, 2, "c", "X"), (4, 0, "c", "X"), (4, 2, "a", "X")]


def test_words_are_counted_many_rows_at_a_time(monkeypatch):
    monkeypatch.setattr(A, "PIECE", 4)
    toks = pa.array([["a", "b", "a"], None, ["b", None, "c"], [], ["c"] * 9, ["a"], []], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), toks], names=["doc", "toks"]).slice(1)
    got = [list(p.column("doc").to_pylist()) for p in A.pieces(batch, "toks")]
    assert sum(got, []) == [1, 2, 3, 4, 5, 6] and len(got) > 1 and list(A.pieces(batch.slice(0, 0), "toks")) == []
    row, code, n, words = A.count_in_rows(batch.column("toks"))
    assert [(r, words[c].as_py(), x) for r, c, x in zip(row.tolist(), code.tolist(), n.tolist())] == [(1, "b", 1), (1, "c", 1), (3, "c", 9), (4, "a", 1)]
    assert [len(x) for x in A.count_in_rows(toks.slice(0, 0))] == [0, 0, 0, 0]


def test_vectors_look_up_each_word_once_a_piece(spark):
    """What meets the vocabulary are the different words of many rows, not the words of each row."""
    docs = spark.createDataFrame([(i % 40, ["x", f"w{i % 3}", "x", None]) for i in range(80)] + [(None, None), (99, []), (98, ["rare"])], "doc_id long, toks array<string>").coalesce(1)
    index = spark.createDataFrame([(0, "x"), (1, "w1"), (2, "w0")], "idx long, term string")
    kind, met = type(docs), []
    join = kind.join
    with pytest.MonkeyPatch.context() as m:
        m.setattr(kind, "join", lambda self, *a, **b: (met.append(self.count()), join(self, *a, **b))[1])
        rows = TM.index_vectors(docs, index).collect()
    assert met == [5]  # x, w0, w1, w2, rare
    want = {0: [(0, 2.0), (2, 1.0)], 1: [(0, 2.0), (1, 1.0)], 2: [(0, 2.0)]}
    held = sorted((r.doc_id, [tuple(e) for e in r.features]) for r in rows if r.doc_id is not None)
    assert held == sorted([(i % 40, want[i % 3]) for i in range(80)] + [(98, []), (99, [])]) and [r.features for r in rows if r.doc_id is None] == [None]


def test_model_queries_split_the_texts_once(spark, monkeypatch, tmp_path):
    from __spark_entry__ import queries

    from rostrum.plans import language, relational

    rows, calls = [(i, " ".join(f"w{(i * j) % 41}" for j in range(1, 41))) for i in range(80)], []
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for plans in (language, relational):
        monkeypatch.setattr(plans, "token_array", lambda *a, f=plans.token_array: (calls.append(a), f(*a))[1])
    language._words.cache_clear()
    language._model.cache_clear()
    for name in ("topic_relevance", "topic_relevance_facts", "topic_table_words"):
        assert queries()[name](spark, str(tmp_path)).count() > 0
    assert len(calls) == 1
