"""Operator 1: exact Jaccard join on word n-grams with size-banded tiles and bitmap signatures.

Classes of equal shingle sets are formed first. Two classes above the threshold share a shingle in the rarest part of both sets (prefix
filter over one global order of shingles), so a class is placed under the shingles of its prefix only. Links are then found twice:

1. *Stars.* Every class is compared with one hub, the best connected class that it shares a prefix shingle with. This is linear and
   links nearly all members of a large group of near copies.
2. *Tiles.* Prefix shingles that still join several components are cut into tiles: a band of set sizes, with the next larger band as
   guests, in blocks of a bounded number of classes. In a tile, hashed bitmaps are compared first; their bit counts bound the overlap
   from above. Pairs that pass and lie in different components are confirmed by an exact intersection of the sorted sets.

Pairs inside one component need no comparison, as the result is the component. The common order of shingles comes from a counter
vector of fixed size, which moves frequent passages to the end of every prefix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rostrum.llm.components import components
from rostrum.llm.fixed import SMALL_BATCH_BYTES, IdFilter, binary_text, bounded_batches, saved, vector_sum
from rostrum.llm.words import chain, groups, hash_spans, rows, texts_of, words_of

COUNTERS = 1 << 20


def shingle_sets(batch: pa.RecordBatch, size: int = 3) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word n-grams; the whole sequence as one where there are fewer words."""
    buf, offsets = texts_of(batch, lower=True)
    starts, ends, ptr = words_of(buf, offsets)
    h = hash_spans(buf, starts, ends)
    grams = chain(*[h[i: len(h) - size + 1 + i] for i in range(size)]) if len(h) >= size else h[:0]
    for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist()):
        if b - a >= size:
            s = np.sort(grams[a: b - size + 1])
            keep = np.ones(len(s), bool)
            keep[1:] = s[1:] != s[:-1]
            yield s[keep]
        elif b > a:
            yield chain(*[h[i: i + 1] for i in range(a, b)])
        else:
            yield h[:0]


def _place(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(44)).astype(np.int64)


def shingle_counters(docs: DataFrame, size: int) -> np.ndarray:
    """How many sets hold a shingle of each counter; COUNTERS numbers whatever the input."""
    def kernel(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            sets = list(shingle_sets(batch, size))
            if sets:
                total += np.bincount(_place(np.concatenate(sets)), minlength=COUNTERS)
        return total

    return vector_sum(docs, kernel, COUNTERS)


EXTRA = 24


def prefix(s: np.ndarray, counters: np.ndarray, percent: int) -> np.ndarray:
    """The n - ceil(t n) + k rarest shingles, k = max(1, n // EXTRA).

    Two sets with a Jaccard index of t or more share at least the smaller k of both in these.
    """
    n = len(s)
    p = n - (percent * n + 99) // 100 + max(1, n // EXTRA)
    if p >= n:
        return s
    order = np.argsort(counters[_place(s)], kind="stable")  # ties in the order of the hashes
    return s[order[:p]]


SET = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("fp", pa.int64()), ("keys", pa.list_(pa.int64()))])


def _sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per document its set size, a hash of the set (null if empty) and the prefix."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(np.minimum(shingle_counters(docs, size), 2**31 - 1).astype(np.int32))

    def kernel(batches):
        import xxhash
        counters = shared.value
        for batch in batches:
            n, fp, keys = [], [], []
            for s in shingle_sets(batch, size):
                n.append(len(s))
                fp.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None)
                keys.append(prefix(s, counters, percent).view(np.int64))
            lens = np.fromiter(map(len, keys), np.int32, len(keys))
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(fp, pa.int64()), listed], schema=SET)

    return docs.mapInArrow(kernel, "doc_id long, n long, fp long, keys array<long>")


def _arrays(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, set) of the wanted documents. A bit filter in the scan leaves few others, which the join removes."""
    shared = docs.sparkSession.sparkContext.broadcast(IdFilter.of(wanted).bits)

    def kernel(batches):
        chosen = IdFilter(shared.value)
        for batch in batches:
            ids = batch.column("doc_id")
            mask = chosen.may_hold(ids.fill_null(0).to_numpy(zero_copy_only=False)) & ~ids.is_null().to_numpy(zero_copy_only=False)
            if mask.any():
                part = batch.filter(pa.array(mask))
                yield pa.RecordBatch.from_pydict({
                    "node": part.column("doc_id"), "set": pa.array([s.tobytes() for s in shingle_sets(part, size)], pa.binary())})

    return docs.mapInArrow(kernel, "node long, set binary").join(wanted, "node", "left_semi")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, by exact intersection of sorted sets."""
    if not len(a) or not len(b):
        return False
    at = np.searchsorted(b, a)
    both = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def verify(pairs: DataFrame, arrays: DataFrame, percent: int, block: int = 256) -> DataFrame:
    """The pairs (hub, node) that are similar. A hub with many partners is dealt out in blocks, with its set once in each."""
    blocks = pairs.groupBy("hub").agg(F.ceil(F.count("*") / block).alias("m"))
    dealt = saved(pairs.join(blocks, "hub").select("hub", F.expr("pmod(xxhash64(node), m)").alias("part"), "node"), "pairs")
    members = dealt.join(arrays, "node").select("hub", "part", F.lit(1).alias("role"), "node", "set")
    hubs = dealt.select("hub", "part").distinct().join(arrays.withColumnRenamed("node", "hub"), "hub")
    both = members.union(hubs.select("hub", "part", F.lit(0), F.col("hub"), "set"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def kernel(batches):
        key, own = None, []
        for batch in batches:
            a, b = [], []
            for hub, part, role, node, s in zip(*[c.to_pylist() for c in batch.columns]):
                if key != (hub, part):
                    key, own = (hub, part), []
                s = np.frombuffer(s, np.uint64)
                if role == 0:
                    own.append(s)
                elif any(similar(x, s, percent) for x in own):
                    a.append(hub)
                    b.append(node)
            if a:
                yield rows(out, a=a, b=b)

    return both.repartition("hub", "part").sortWithinPartitions("hub", "part", "role").mapInArrow(kernel, "a long, b long").distinct()


def shared_postings(postings: DataFrame, percent: int) -> DataFrame:
    """Postings whose shingle another class has too, of the classes that have enough of them.

    A partner has at least t n shingles, so the pair shares the k of that size or more; classes with fewer shared shingles have no partner.
    """
    joint = postings.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("key")
    found = saved(postings.join(joint, "key"), "postings")
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.max("n") * percent / 100) / EXTRA))
    enough = found.groupBy("node").agg(F.count("*").alias("found"), least.alias("least")).filter("found >= least").select("node")
    return found.join(enough, "node")


# ---- bitmaps


def bitmap(s: np.ndarray) -> bytes:
    """At least four bits per shingle, a power of two, so that a wider map folds onto a narrower one."""
    width = max(64, 1 << math.ceil(math.log2(4 * max(len(s), 1))))
    bits = np.zeros(width, bool)
    bits[(s & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def fold(maps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit numbers at the narrowest of their widths."""
    words = min(map(len, maps)) // 8
    return np.stack([np.bitwise_or.reduce(np.frombuffer(m, np.uint64).reshape(-1, words), axis=0) for m in maps])


def candidates(n: np.ndarray, comp: np.ndarray, maps: np.ndarray, home: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs in a tile with fitting sizes, in different components, whose bit counts allow the overlap that is needed.

    A bit that only one of two maps has set proves an own shingle: overlap <= n_a - popcount(a & ~b), and likewise for b.
    """
    for i in np.flatnonzero(home):
        j = np.flatnonzero((comp != comp[i]) & (~home | (np.arange(len(n)) > i)))
        j = j[100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])]
        if not len(j):
            continue
        other = maps[j]
        most = np.minimum(n[i] - np.bitwise_count(maps[i] & ~other).sum(axis=1, dtype=np.int64),
                          n[j] - np.bitwise_count(other & ~maps[i]).sum(axis=1, dtype=np.int64))
        for k in j[100 * most >= percent * (n[i] + n[j] - most)].tolist():
            yield int(i), k


def band_of(n: Column, percent: int) -> Column:
    """Sizes whose ratio reaches the threshold lie in one band or in neighbouring bands."""
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(100 / percent) * (1 + 1e-9))).cast("int")


def tile_pairs(postings: DataFrame, arrays: DataFrame, percent: int, block: int = 1024) -> DataFrame:
    """Candidate pairs (hub, node) from ``postings`` (key, node, n, comp), tile by tile."""
    keys = postings.groupBy("key").agg(
        F.count("*").alias("m"), F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("who"))
    keys = keys.filter("c0 <> c1").groupBy("m", "who").agg(F.min("key").alias("key"))  # keys over the same classes give the same pairs
    tiles = postings.join(keys, "key").select(
        "key", "node", "n", "comp", band_of(F.col("n"), percent).alias("band"), F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    tiles = tiles.withColumn("mine", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
    tiles = tiles.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("guest"))
    tiles = tiles.select(
        "key", (F.col("band") - F.col("guest")).alias("band"), "node", "n", "comp", (F.col("guest") == 0).alias("home"), "mine", "blocks")
    tiles = tiles.select("*", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    tiles = tiles.select("key", "band", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "n", "comp", "home")
    maps = arrays.mapInArrow(_bitmaps, "node long, map binary")
    out = pa.schema([("hub", pa.int64()), ("node", pa.int64())])

    def kernel(batches):
        for g in groups(batches, "key", "band", "i", "j"):
            home = np.array(g["home"])
            if len(home) < 2 or not home.any() or len(set(g["comp"])) < 2:
                continue
            node, n, comp, mine = (np.array(g[c]) for c in ("node", "n", "comp", "mine"))
            found = list(candidates(n, comp, fold(g["map"]), home, percent))
            if g["i"][0] != g["j"][0]:
                found = [(x, y) for x, y in found if mine[x] != mine[y]]  # pairs of one block are met in its own tile
            if found:
                x, y = node[[p[0] for p in found]], node[[p[1] for p in found]]
                yield rows(out, hub=np.minimum(x, y), node=np.maximum(x, y))

    tiled = tiles.join(maps, "node").select("key", "band", "i", "j", "mine", "node", "n", "comp", "home", "map")
    tiled = tiled.repartition("key", "band", "i", "j").sortWithinPartitions("key", "band", "i", "j")
    return tiled.mapInArrow(kernel, "hub long, node long").distinct()


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = [bitmap(np.frombuffer(s, np.uint64)) for s in batch.column("set").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(maps, pa.binary())], names=["node", "map"])


# ---- the operator


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row; two documents link when 100 * intersection >= percent * union.

    A null or empty text has an empty set and links with nothing. Rows that repeat an id are one document of the graph. A row
    without an id keeps a null one; it takes part only through a copy that has an id, else its component is null. Other columns are not read.
    """
    bounded_batches(docs.sparkSession, SMALL_BATCH_BYTES)
    docs = binary_text(docs, doc_id, text)
    sets = saved(_sets(docs, size, percent), "sets")
    some = sets.filter("fp is not null")
    classes = saved(some.groupBy("fp").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("keys").alias("keys")), "classes")
    postings = classes.filter("node is not null").select("node", "n", F.explode("keys").alias("key"))
    for _ in range(2):  # the second time among the classes left by the first
        postings = shared_postings(postings, percent)
    postings = saved(postings, "postings")

    arrays = saved(_arrays(docs, postings.select("node").distinct(), size), "arrays")
    degree = postings.groupBy("node").agg((F.count("*") / F.max("n")).alias("degree"))
    ranked = postings.join(degree, "node")
    best = F.struct(F.col("degree"), (-F.col("node")).alias("o"), F.col("n").alias("hub_n"))
    hubs = ranked.groupBy("key").agg(F.max(best).alias("h")).select("key", (-F.col("h.o")).alias("hub"), "h.hub_n", F.col("h.degree").alias("hub_degree"))
    near = postings.join(hubs, "key").filter((F.col("hub") != F.col("node")) & (100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")))
    met = near.groupBy("node", "hub").agg(F.count("*").alias("met"), F.first("hub_degree").alias("d"))
    star = met.groupBy("node").agg(F.max(F.struct("met", "d", (-F.col("hub")).alias("o"))).alias("s")).select((-F.col("s.o")).alias("hub"), "node")
    first = saved(components(verify(star, arrays, percent)), "first")

    left = postings.join(first, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("comp"))
    links = saved(verify(tile_pairs(left, arrays, percent), arrays, percent), "links")
    a, b = first.toDF("a", "ca"), first.toDF("b", "cb")
    links = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    second = components(links).toDF("component", "final")
    named = classes.select("fp", "node").join(first, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))
    named = named.join(second, "component", "left").select("fp", F.coalesce("final", "component").alias("component_id"))
    found = some.join(named, "fp").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return found.union(sets.filter("fp is null").select("doc_id", "n", "doc_id"))
