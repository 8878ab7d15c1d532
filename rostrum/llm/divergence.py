"""Operator 11: divergence of sources within a language, by exact sparse counts.

Spark's CountVectorizer, with the least number of documents and the largest possible vocabulary, is fitted once on terms that carry their
language, so that its document frequencies are those of each language. The sparse vectors of the documents over its vocabulary are added up per
source, entry by entry; as the model's own transform takes far longer than everything else, they are counted by the 64-bit hash of (language,
term), which is joined with the vocabulary. Pairs of sources are compared over the entries that either of them has: terms that neither has add one constant each.

For sources s and t with probabilities p, and p0 for a term without occurrences, the sum of f over the V terms of the language is

    V f(p0s, p0t) + sum over the terms of s of [f(ps, p0t) - f(p0s, p0t)] + sum over the terms of t of [f(p0s, pt) - f(p0s, p0t)]
    + sum over the terms of both of [f(ps, pt) - f(ps, p0t) - f(p0s, pt) + f(p0s, p0t)]

where the two middle sums go over counts of equal probabilities, and the last one over the sources that share a term. All numbers are integers.
The vocabulary lies on the driver, as the method's model keeps it there: terms in at least three documents, not texts or counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from rostrum.llm.fixed import bounded_batches, saved
from rostrum.llm.words import PAD, chain, distinct, hash_spans, ragged, runs, texts_of
from rostrum.session import scratch_path

SCALE = 1_000_000_000
LETTER = np.zeros(256, bool)  # bytes of [^\x00-\x40\x5B-\x60\x7B-\x7F]
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
MARK = b"\x1f"  # no term holds it, so the last one in an entry ends the language
STEP = 1 << 21
HELD = 1 << 21


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.DictionaryArray]:
    """Bytes, token spans and each row's first token: runs of letters A-Z in lower case and of bytes beyond ASCII; the rows' languages."""
    buf, offsets = texts_of(batch, lower=True)
    starts, ends, ptr = runs(LETTER[buf[: len(buf) - PAD]], offsets)
    return buf, starts, ends, ptr, batch.column("lang").dictionary_encode()


def _marked_hashes(lang: np.ndarray, langs: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """64-bit hashes of terms together with their language."""
    own = np.array([xxhash.xxh3_64_intdigest(v, seed=2) for v in langs] or [0], np.uint64)
    return chain(own[lang], hashes).view(np.int64)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each text, each behind its language; only document frequencies are learnt from them."""
    for batch in batches:
        buf, starts, ends, ptr, lang = _tokens(batch)
        h = hash_spans(buf, starts, ends)
        chosen = [a + distinct(h[a:b])[1] for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist())]
        size = [len(c) for c in chosen]
        chosen = np.concatenate(chosen) if chosen else np.empty(0, np.int64)
        marks = [v.encode() + MARK for v in lang.dictionary.to_pylist()]
        code = np.repeat(lang.indices.to_numpy(), size)
        lead = np.array([len(m) for m in marks] or [0], np.int64)[code]
        length = ends[chosen] - starts[chosen]
        stops = np.cumsum(lead + length)
        total = int(stops[-1]) if len(stops) else 0
        data, own = np.empty(total, np.uint8), np.ones(total, bool)
        for k, mark in enumerate(marks):
            at = (stops - lead - length)[code == k]
            for j, byte in enumerate(mark):
                data[at + j], own[at + j] = byte, False
        data[own] = ragged(buf, starts[chosen], length)
        strings = pa.StringArray.from_buffers(len(stops), pa.py_buffer(np.concatenate([[0], stops]).astype(np.int32)), pa.py_buffer(data))
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), strings)], names=["terms"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse vectors of the documents, entry by entry, added up per source while they come; at most HELD entries are held."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    n = 0

    def flush():
        for source, parts in held.items():
            key, count = (np.concatenate(v) for v in zip(*parts))
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            yield pa.RecordBatch.from_arrays([pa.array([source] * len(first), pa.string()), pa.array(key[first]), pa.array(np.add.reduceat(count[order], first))],
                                             names=["source", "key", "count"])
        held.clear()

    for batch in batches:
        buf, starts, ends, ptr, lang = _tokens(batch)
        row = np.repeat(np.arange(batch.num_rows), np.diff(ptr))
        key = _marked_hashes(lang.indices.to_numpy()[row], [v.encode() for v in lang.dictionary.to_pylist()], hash_spans(buf, starts, ends))
        source = batch.column("source").dictionary_encode()
        code = source.indices.to_numpy()[row]
        order = np.argsort(code, kind="stable")
        bounds = np.searchsorted(code[order], np.arange(len(source.dictionary) + 1))
        for k, name in enumerate(source.dictionary.to_pylist()):
            own = order[bounds[k]: bounds[k + 1]]
            if len(own):
                found = np.unique(key[own], return_counts=True)
                held.setdefault(name, []).append(found)
                n += len(found[0])
        if n > HELD:
            yield from flush()
            n = 0
    yield from flush()


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of every entry of the vocabulary."""
    for batch in batches:
        buf, offsets = texts_of(batch, "term")
        lang = batch.column("lang").dictionary_encode()
        key = _marked_hashes(lang.indices.to_numpy(), [v.encode() for v in lang.dictionary.to_pylist()], hash_spans(buf, offsets[:-1], offsets[1:]))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=["idx", "lang", "term", "key"])


def probability(count: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + size)), in decimals, as the product may pass a long."""
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(18,0)") * (count + 1), F.greatest(total + size, F.lit(1)))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def source_counts(docs: DataFrame, min_documents: int) -> DataFrame:
    """(idx, lang, source, term, count, total): occurrences of every kept term in a source that holds it, and in its language."""
    spark = bounded_batches(docs.sparkSession)
    texts = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    model = CountVectorizer(inputCol="terms", outputCol="v", minDF=min_documents, vocabSize=2**31 - 1).fit(texts.mapInArrow(_terms, "terms array<string>"))
    path = scratch_path(spark, "vocabulary")
    model.write().save(path)  # read back as a table: the terms never pass through Python
    entries = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("idx", "entry"))
    term = F.substring_index("entry", MARK.decode(), -1)
    entries = entries.select("idx", F.substring(F.col("entry"), F.lit(1), F.length("entry") - F.length(term) - 1).alias("lang"), term.alias("term"))
    entries = saved(entries.mapInArrow(_keys, "idx int, lang string, term string, key long"), "entries")
    found = texts.mapInArrow(_sums, "source string, key long, count long").groupBy("key", "source").agg(F.sum("count").alias("count"))
    sums = saved(found.join(entries.select("key", "idx"), "key").select("idx", "source", "count"), "sums")
    totals = sums.groupBy("idx").agg(F.sum("count").alias("total")).join(entries.drop("key"), "idx")
    return saved(sums.join(totals, "idx").select("idx", "lang", "source", "term", "count", "total"), "counted")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by term, with the probability in their source: the last sum of the formula per pair of sources, in parts."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        idx = held.column("idx").to_numpy()
        whole = int(np.searchsorted(idx, idx[-1])) if len(idx) else 0  # the last term may go on in the next batch
        if whole:
            yield from _pairs(held.slice(0, whole))
            held = held.slice(whole)
    if held is not None and held.num_rows:
        yield from _pairs(held)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    idx, p, p0 = (rows.column(c).to_numpy() for c in ("idx", "p", "p0"))
    lang, source = (rows.column(c).combine_chunks().dictionary_encode() for c in ("lang", "source"))
    l, s = lang.indices.to_numpy().astype(np.int64), source.indices.to_numpy().astype(np.int64)
    n = len(source.dictionary)
    start = np.searchsorted(idx, idx)
    size = np.searchsorted(idx, idx, side="right") - start
    ends = np.cumsum(size)
    a = 0
    while a < len(idx):  # as many rows as have STEP partners together
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + STEP, side="right")))
        x = np.repeat(np.arange(a, b), size[a:b])
        y = np.arange(len(x)) - np.repeat(ends[a:b] - size[a:b] - (ends[a - 1] if a else 0), size[a:b]) + start[x]
        x, y = x[x != y], y[x != y]
        a = b
        if not len(x):
            continue
        value = _f(p[x], p[y]) - _f(p[x], p0[y]) - _f(p0[x], p[y]) + _f(p0[x], p0[y])
        key = (l[x] * n + s[x]) * n + s[y]
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        key, value = key[order][first], np.add.reduceat(value[order], first)
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(key // (n * n))), source.dictionary.take(pa.array(key // n % n)), source.dictionary.take(pa.array(key % n)),
             pa.array(value)], names=["lang", "source", "other", "value"])


def source_divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_documents: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): for every source of every language its distances to the others, and the terms it favours.

    Part ``pair`` compares with each other source of the language, over all its kept terms (0 without any); part ``term`` holds the
    ``top`` kept terms of the source that are more probable there than in the language. Ranks go by value, ties by the item's bytes. Null texts,
    languages and sources are ''. Every row counts as a document, repeated ones too. A language without kept terms has pairs of value 0, and
    an empty table has no result. Columns with other names are not read.
    """
    empty = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = source_counts(rows, min_documents)
    terms = counted.select("lang", "idx", "total").distinct()
    langs = saved(terms.groupBy("lang").agg(F.count("*").alias("size"), F.sum("total").alias("total")), "langs")
    own = counted.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs.select("lang", "size"), "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("size", F.lit(0)).alias("size"))
    groups = saved(groups.withColumn("p0", probability(F.lit(0), F.col("n"), F.col("size"))), "groups")
    p, q = probability(F.col("count"), F.col("n"), F.col("size")), probability(F.col("total"), F.col("all"), F.col("size"))
    known = counted.join(groups, ["lang", "source"]).join(langs.select("lang", F.col("total").alias("all")), "lang")
    known = saved(known.select("idx", "lang", "source", "term", p.alias("p"), "p0", q.alias("q")), "known")

    # Terms that one source has: sources hold few different probabilities, each is compared with every other source once.
    steps = known.groupBy("lang", "source", "p0", "p").agg(F.count("*").alias("n"))
    others = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    met = steps.join(others, "lang").filter("source <> other")
    constant = divergence(F.col("p0"), F.col("q0"))
    there = met.select("lang", "source", "other", (F.col("n") * (divergence(F.col("p"), F.col("q0")) - constant)).alias("value"))
    back = divergence(F.col("q0"), F.col("p")) - divergence(F.col("q0"), F.col("p0"))
    back = met.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), (F.col("n") * back).alias("value"))
    base = groups.join(others, "lang").filter("source <> other")
    base = base.select("lang", "source", "other", (F.col("size") * constant).alias("value"))
    both = known.select("idx", "lang", "source", "p", "p0").repartition("idx").sortWithinPartitions("idx").mapInArrow(
        _shared, "lang string, source string, other string, value long")
    total = base.union(there).union(back).union(both).groupBy("lang", "source", "other").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = total.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), F.col("value").cast("long").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    favoured = known.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                            divergence(F.col("p"), F.col("q")).alias("value"))
    favoured = favoured.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    return pairs.union(favoured)
