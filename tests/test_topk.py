"""First pages from blocks, and completions, against the plain search and the plain list."""

import numpy as np
from pyspark.sql import functions as F

from rostrum.operators import search as S, topk
from rostrum.session import scratch_path


def test_first_page_from_few_blocks(spark):
    rng = np.random.default_rng(6)
    words = [f"w{chr(97 + i)}" for i in range(26)]
    rows = []
    for i in range(400):
        n = int(rng.integers(1, 120))
        text = " ".join(rng.choice(words, n, p=np.arange(26, 0, -1) / 351))
        rows.append((f"d{i:03d}", text, f"{words[i % 5]} {words[i % 7]}", ["P", "Q", None][i % 3], f"2015.01.{i % 28 + 1:02d}."))
    rows += [("leer", None, None, None, None), ("kurz", "wa wb", "wa", "P", "2015.01.01.")]
    index = S.index_documents(spark.createDataFrame(rows, "id string, text string, speaker string, speaker_party string, date_filter string"))
    path = scratch_path(spark, "blocks")
    topk.write_blocks(index, path, size=20)
    reads = []
    for q, size, more in (("wa wb", 5, {}), ("wz", 3, {}), ("wy wz", 10, {"date_from": "2015.01.05.", "date_to": "2015.01.20."}), ("wa", 1000, {}), ("none", 5, {})):
        page, read = topk.search_top(spark, path, q, size, **more)
        want = S.page_results(S.search_hits(index, q, **more), size, 0)
        assert [(r["id"], round(r["score"], 9)) for r in page.collect()] == [(r["id"], round(r["score"], 9)) for r in want.collect()]
        reads.append(read)
    assert 4 * reads[1]["postings_read"] < reads[1]["postings"] and reads[1]["blocks_read"] == 4
    assert reads[3]["blocks_read"] == reads[3]["blocks"] and reads[4] == {"blocks": 0, "blocks_read": 0, "postings": 0, "postings_read": 0}


def test_completions(spark):
    rows = [(f"{a}{b}{c} {k}", (k * 7 + ord(c)) % 50) for a in "aáB" for b in "xy" for c in "pqr" for k in range(4)]
    rows += [("a", 99), ("ax", 98), ("a!", 97), ("12", 96), ("axp 0", 1), ("Axpert név", 50), ("", 3)]
    suggestions = spark.createDataFrame(rows, "input string, weight int")
    path = scratch_path(spark, "completions")
    topk.write_completions(suggestions, path, n=6)
    for q, n in (("a", 5), ("AX", 6), ("axp", 5), ("axp", 9), ("axpert", 5), ("á", 3), ("zz", 5), ("", 4)):
        assert topk.complete(spark, path, q, n).collect() == S.suggest_prefix(suggestions, q, n).collect(), q
    stored = spark.read.parquet(f"{path}/prefixes")
    assert stored.groupBy("prefix", "length").count().filter("count > 6").count() == 0


def test_blocks_count_the_borders_below_a_length(spark):
    lengths = [0, 1, 1, 1, 2, 2, 3, 5, 8, 8, 8, 9]
    index = spark.createDataFrame([(i, ["a"] * n if n else None) for i, n in enumerate(lengths)], "id long, t_text array<string>")
    borders = index.agg(F.percentile_approx(F.size(F.coalesce("t_text", F.array())), [i / 6 for i in range(1, 6)], 10_000)).first()[0]
    assert len(set(borders)) < len(borders)  # a border may come twice
    dealt = topk.with_blocks(index, size=2)
    assert {r.id: r.block for r in dealt.collect()} == {i: sum(n > b for b in borders) for i, n in enumerate(lengths)}
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_compact") + plan.count("isnotnull(lambda") <= 1 and "aggregate(" not in plan  # the length is not counted per border
