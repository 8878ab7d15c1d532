"""The pipeline stage by stage, against brute force on its own input."""

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline as P
from rostrum.llm import importance, jaccard, toxicity
from rostrum.llm.fixed import binary_text

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for k, (name, stage) in enumerate(P.STAGES[:-1]):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == columns
        rows = docs.collect()
        kept = {r.doc_id: r for r in rows}
        assert len(rows) == len(kept) and all(before[i] == r for i, r in kept.items())
        if name == "n-gram Jaccard join":
            assert set(kept) == _first_of_groups(before)
        before = kept
    pieces = P.STAGES[-1][1](spark, docs, FOLDER).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total: dict[int, int] = {}
    for p in pieces:
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
    assert total == {i: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in before.items()}


def _first_of_groups(rows):
    sets = {}
    for i, r in rows.items():
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "").encode().split()
        sets[i] = {tuple(w[k: k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}
    group = {i: i for i in sets}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                group[y] = x
    return {i for i in ids if find(i) == i}


def test_near_copies_without_ids_and_odd_columns(spark):
    """Five words and 80 %: a changed word in a text of 60 links; rows without an id are compared like all others."""
    words = [f"w{i}" for i in range(60)]
    near, other = list(words), [f"v{i}" for i in range(60)]
    near[30] = "changed"
    far = [w if i % 7 else f"x{i}" for i, w in enumerate(words)]
    rows = [(5, " ".join(words)), (3, " ".join(near)), (None, " ".join(words)), (7, " ".join(far)), (None, " ".join(other)), (None, " ".join(other) + " end"),
            (None, " ".join(other)), (None, None), (8, None), (9, ""), (9, "again")]
    docs = spark.createDataFrame([r + ("n", 1, 2.0) for r in rows], "doc_id long, text string, _nth string, row int, score double")
    got = P.drop_near_copies(spark, docs, FOLDER)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(i for i, _ in kept if i is not None) == [3, 7, 8, 9] and (9, "") in kept
    loose = [t for i, t in kept if i is None]
    assert len(loose) == 2 and None in loose and {t for t in loose if t} <= {" ".join(other), " ".join(other) + " end"}
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    blank = spark.createDataFrame([(1, None), (2, None), (None, "")], "doc_id long, text string")
    for _, stage in P.STAGES[:-1]:
        blank = stage(spark, blank, FOLDER)
    assert blank.count() >= 2


def test_stages_hold_small_batches(spark):
    """A worker's arrays are many times the bytes of its batch, and several workers share an executor's memory."""
    def size_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    docs = spark.range(400).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), 2000) as text").coalesce(1)
    started = {"toxicity": lambda: toxicity.toxicity(docs, labels), "importance": lambda: importance.importance_sample(docs, labels),
               "jaccard": lambda: jaccard.jaccard_components(docs.limit(20)), "packing": lambda: P.pack(spark, docs, FOLDER)}
    for name, start in started.items():
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        start()
        sizes = binary_text(docs, "doc_id", "text").mapInArrow(size_of, "n long").collect()
        assert max(r.n for r in sizes) < 1.1 * (1 << 20), name


def test_classifier_without_unseen_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "c")], "doc_id long, text string")
    for rows in ([], [(1, 1)], [(77, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        assert importance.importance_sample(docs, labels).filter("kept").count() >= 1
