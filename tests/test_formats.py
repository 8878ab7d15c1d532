"""Readers and writers on hand-made files."""

import bz2
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from rostrum.operators import project as P
from rostrum.sources import archives as Z, files as R, sinks as K


def test_speech_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '[\n{"id": "36-1-1", "speaker": "A", "topic": "t", "plenary_sitting_details": {"term": 36, "day": "hétfő", "duration": "1:00"}},\n'
        '{"id": "36-1-2", "speaker": "B", "topic": ["t", "u"], "bill_title": ["' + "x" * 300 + '"]},\n'
        '{"id": "36-1-3", "speaker": \n{"id": "36-1-4", "text": "x"},\n{"id": "36-1-5", "speaker": "C"}\n]', encoding="utf-8")
    records, rejects = R.read_speech_lines(spark, str(tmp_path))
    rows = {r["id"]: r for r in records.collect()}
    assert sorted(rows) == ["36-1-1", "36-1-2", "36-1-5"]
    assert rows["36-1-1"]["topic"] == ["t"] and rows["36-1-2"]["topic"] == ["t", "u"] and rows["36-1-5"]["topic"] is None
    assert rows["36-1-1"]["plenary_sitting_details"]["term"] == "36"
    assert sorted(r["reason"] for r in rejects.collect()) == ["no JSON", "no speaker"]
    flat = {r["id"]: r for r in P.build_suggestions(P.flatten_speech(records)).collect()}
    assert flat["36-1-1"]["sitting_day"] == "hétfő" and flat["36-1-1"]["sitting_duration"] == "1:00"
    assert [(s["input"], s["weight"]) for s in flat["36-1-2"]["suggest"]] == [(["B"], 10), (["t", "u"], 5), (["x" * 300], 5)]
    assert R.read_speech_lines(spark, str(tmp_path), limit=1)[0].count() == 1


def test_json_array(spark, tmp_path):
    K.write_array_lines(spark.createDataFrame([("1", "a"), ("2", "b")], "id string, speaker string"), str(tmp_path / "x"))
    assert sorted(r["id"] for r in R.read_json_array(spark, str(tmp_path / "x")).collect()) == ["1", "2"]


def archive(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return buf.getvalue()


def test_zip_text(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(archive([
        ("d/h1.txt", "1\n2\nELNÖK: szöveg\nmég".encode()), ("d/h2.x.txt", b"1\n2\nabc"), ("d/h1.md", b"x"),
        ("d/h3.txt", b"\xff\xfe\xff"), ("d/h2.txt", b"1\n2\nlast"), ("top.txt", b"1\n2\n3")]))
    texts, bad = R.zip_texts(R.binary_files(spark, str(tmp_path)))
    assert {r["Hash"]: r["Text"] for r in texts.collect()} == {"h1": " szöveg\nmég", "h2": "last"}
    assert sorted(r["member"] for r in bad.collect()) == ["d/h3.txt", "top.txt"]


def test_zip_json(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(archive([(f"{i}.json", f'{{"title": "t{i}", "content": "c"}}') for i in range(5)]))
    ids = spark.createDataFrame([(1,), (3,), (9,)], "id bigint")
    assert sorted(r["title"] for r in R.read_zip_json(spark, str(tmp_path), ids).collect()) == ["t1", "t3"]


def test_archives_by_member_ranges(spark, tmp_path):
    """An archive behind three gigabytes of nothing, unpacked in several tasks; broken members and files are rows with errors."""
    with open(tmp_path / "big.zip", "wb") as f:
        f.truncate(3 << 30)
    with zipfile.ZipFile(tmp_path / "big.zip", "a") as z:
        for i in range(60):
            z.writestr(f"d/h{i}.txt", f"1\n2\nbody {i} " * 50, [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2][i % 3])
    small = bytearray(archive([("d/x.txt", b"1\n2\nabc"), ("d/y.txt", b"\xff\xfe"), ("n.json", b"{}")]))
    small[small.index(b"d/x.txt") + 7 + 1] ^= 0xff  # first data byte of the first member
    (tmp_path / "small.zip").write_bytes(bytes(small))
    (tmp_path / "none.zip").write_bytes(b"no archive")
    (tmp_path / "void.zip").write_bytes(archive([]))
    members = Z.archive_members(spark, str(tmp_path))
    assert members.count() == 60 + 3 + 1
    texts = Z.read_members(members.filter("member is null or member like '%.txt'"), task_bytes=4000)
    rows = texts.select("*", F.spark_partition_id().alias("task")).collect()
    good = {r.member: r for r in rows if r.error is None}
    assert {m: r.text for m, r in good.items()} == {f"d/h{i}.txt": f"1\n2\nbody {i} " * 50 for i in range(60)}
    assert len({r.task for r in good.values()}) > 3
    assert sorted(r.member or "" for r in rows if r.error) == ["", "d/x.txt", "d/y.txt"]
    assert R.read_zip_text(spark, str(tmp_path)).count() == 60
    assert Z.read_members(members.limit(0)).count() == 0


def test_metadata_tsv(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("a\tb\tc\td\te\tf\tg\th\n2001.01.01.\t?\tNév (P)\tp_azon=x1\tfelszólalás\tk\thttp://x\th1\n", encoding="utf-8")
    row = R.read_metadata_tsv(spark, str(tmp_path)).first()
    assert (row["NameAndParty"], row["Hash"], row["Date"]) == ("Név (P)", "h1", "2001.01.01.")


def test_wiki_dump(spark, tmp_path):
    xml = ('<mediawiki><page><title>Cím</title><id>7</id><revision><id>1</id><text xml:space="preserve">Egy &amp; kettő.</text></revision></page>'
           "<page><title>Sablon:X</title><id>8</id><revision><text>y</text></revision></page></mediawiki>")
    (tmp_path / "w.xml.bz2").write_bytes(bz2.compress(xml.encode()))
    got = sorted((r["id"], r["title"], r["content"]) for r in R.read_wiki_dump(spark, str(tmp_path / "w.xml.bz2")).collect())
    assert got == [(7, "Cím", "Egy & kettő."), (8, "Sablon:X", "y")]


def test_triples_and_lists(spark, tmp_path):
    (tmp_path / "t.ttl").write_text('# started\n<http://a> <http://p> <http://b> .\n<http://a> <http://id> "12"^^<http://int> .\nbroken\n')
    got = sorted((r["s"], r["o"]) for r in R.read_triples(spark, str(tmp_path / "t.ttl")).collect())
    assert got == [("http://a", "12"), ("http://a", "http://b")]
    (tmp_path / "w.txt").write_text("# source: x\nÁbel\nAba \nA nevek jegyzéke: férfinevek -- 2019.\n\nÁbel\n", encoding="utf-8")
    assert sorted(r["word"] for r in R.read_word_list(spark, str(tmp_path / "w.txt")).collect()) == ["Aba", "Ábel"]
    (tmp_path / "d.tsv").write_text("36-1-1\t3|12|1\n")
    assert R.read_topic_tsv(spark, str(tmp_path / "d.tsv")).first()["topics"] == ["3", "12", "1"]
    (tmp_path / "i.csv").write_text("12 http://a\n3 http://b\n")
    assert sorted(tuple(r) for r in R.read_inlinks_csv(spark, str(tmp_path / "i.csv")).collect()) == [(3, "http://b"), (12, "http://a")]


def test_normalize(spark):
    df = spark.createDataFrame([("  ", "\n a b ", [], (" ", "x"))], "a string, b string, c array<string>, d struct<e:string,f:string>")
    row = P.normalize_record(df).first()
    assert (row["a"], row["b"], row["c"], row["d"]["e"], row["d"]["f"]) == (None, "a b", None, None, "x")


def test_publish(spark, tmp_path):
    K.publish_version(spark, spark.range(3).toDF("id"), str(tmp_path), 1, "v_test")
    K.publish_version(spark, spark.range(5).toDF("id"), str(tmp_path), 2, "v_test")
    assert spark.table("v_test").count() == 5 and spark.read.parquet(f"{tmp_path}/v1").count() == 3
    with pytest.raises(Exception):
        K.publish_version(spark, spark.range(5).toDF("id"), str(tmp_path), 2, "v_test")
