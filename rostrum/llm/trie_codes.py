"""Operator 12: product codes of vectors, with distances shared along a lexicographic trie.

Components become integers; a vector is cut into parts of equal length. The distinct parts of each position, with the number of vectors
that hold them, are sorted lexicographically: neighbours share a prefix, so the sorted rows are a trie walked depth first. Every node of the
trie holds the squared distances of its prefix to the prefixes of all codebook entries, computed once from its parent's by adding one
dimension; a leaf takes the nearest entry and adds its part, times its weight, to that entry's sums. A task walks one range of the sorted
parts and gives back one row per entry used. The codebooks, of fixed size, are all that comes to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rostrum.llm.fixed import bounded_batches, saved
from rostrum.operators.rows import unnest

MOST = float(1 << 62)
LEAVES = 512

Codebook = list[list[int]]


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) per component as doubles, which hold these integers exactly; null for a null or non-finite component."""
    def one(x: Column) -> Column:
        x = x.cast("double") * scale
        return F.when((F.abs(x) < MOST) & ~F.isnan(x), F.floor(x).cast("double"))
    return F.transform(vector, one)


def _integers(values: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Longs where all distances fit into a long, else Python's integers."""
    most = max((float(np.abs(v).max()) for v in (values, *others) if v.size), default=0.0)
    if 4 * most * most * values.shape[1] < MOST:
        return values.astype(np.int64)
    out = np.empty(values.shape, object)
    out[...] = [[int(x) for x in row] for row in values.tolist()]
    return out


def walk(parts: np.ndarray, codebook: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Nearest entry and squared distance of lexicographically sorted parts, LEAVES leaves at a time, each with the index of its first row.

    ``path`` keeps the distances along the last leaf's path, so that the next leaves start from the longest prefix they share with it.
    """
    n, dims = parts.shape
    path: list[np.ndarray] = []
    for a in range(0, n, LEAVES):
        rows = parts[a: a + LEAVES]
        before = parts[a - 1: a + len(rows) - 1] if a else np.concatenate([rows[:1], rows[:-1]])
        fresh = np.logical_or.accumulate(rows != before, axis=1)  # does a new node begin at this depth?
        if not a:
            fresh[0] = True
        above, node = None, np.zeros(len(rows), np.int64)
        for d in range(dims):
            first = np.flatnonzero(fresh[:, d])
            carried = not fresh[0, d]  # the first leaf is below the node that the last path went through
            step = rows[first, d][:, None] - codebook[:, d][None, :]
            step = step * step
            if above is not None and len(first):
                step = step + above[node[first]]
            here = np.concatenate([path[d][None, :], step]) if carried else step
            node = np.cumsum(fresh[:, d]) - (0 if carried else 1)
            above = here
            if len(path) <= d:
                path.append(here[-1])
            else:
                path[d] = here[-1]
        best = np.argmin(above, axis=1)
        distance = above[np.arange(len(above)), best]
        yield a, best[node], distance[node]


def _sorted_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, and the number of each row among them."""
    order = np.lexsort(parts.T[::-1])
    s = parts[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]).any(axis=1)
    inverse = np.empty(len(s), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return s[new], inverse


def _round(parts: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks after one round; each entry becomes the floor of its parts' mean, unused ones stay."""
    shared = parts.sparkSession.sparkContext.broadcast(books)
    dims = books[0].shape[1]

    def kernel(batches):
        sums = {}
        for batch in batches:
            position = batch.column("position").to_numpy()
            values = batch.column("part").flatten().to_numpy().reshape(len(position), dims)
            weight = batch.column("weight").to_numpy()
            for k in np.unique(position).tolist():
                own = position == k
                book = shared.value[k]
                rows, book = _integers(values[own], book), _integers(book, values[own])
                rows, w = (rows.astype(object) if book.dtype == object else rows), weight[own]
                big = rows.dtype == object or float(np.abs(rows).max()) * float(w.sum()) >= MOST
                for a, best, _ in walk(rows, book):
                    part, count = rows[a: a + len(best)], w[a: a + len(best)]
                    if big:
                        part, count = part.astype(object), count.astype(object)
                    if (k, big) not in sums:
                        sums[k, big] = np.zeros((len(book), dims + 1), object)
                    add = np.zeros((len(book), dims + 1), object if big else np.int64)
                    np.add.at(add, best, np.concatenate([count[:, None], part * count[:, None]], axis=1))
                    sums[k, big] = sums[k, big] + add
        for (k, _), total in sums.items():
            used = [i for i in range(len(total)) if total[i, 0]]
            yield pa.RecordBatch.from_pydict({
                "position": pa.array([k] * len(used), pa.int32()), "entry": pa.array(used, pa.int32()),
                "sums": pa.array([[str(v) for v in total[i]] for i in used], pa.list_(pa.string()))})

    found = parts.mapInArrow(kernel, "position int, entry int, sums array<string>")
    total = found.groupBy("position", "entry").agg(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims + 1)])
    books = [b.copy() for b in books]
    for r in total.collect():  # one row per entry at most
        books[r["position"]][r["entry"]] = [float(int(r[f"s{i + 1}"]) // int(r["s0"])) for i in range(dims)]
    shared.unpersist()
    return books


def trie_codes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", scale: int = 1024, parts: int = 4,
               entries: int = 256, rounds: int = 4) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per vector without null or non-finite components.

    A codebook starts as the parts of the ``entries`` vectors with the smallest ids, null ids last and equal ids by their components; with fewer
    vectors it has fewer entries. Equal distances go to the lower index. Rows that repeat an id are vectors of their own, null labels are
    one label. All arithmetic is in integers of any size, and an error beyond a long is null. Vectors that cannot be cut like the first one (another length, none, or components
    beyond 2**62) have no code: code and error are null, and they count for nothing. An empty table has no result.
    """
    spark = bounded_batches(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("x"))
    usable = F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.filter(usable).withColumn("x", whole_numbers(F.col("x"), scale))
    first = rows.filter((F.size("x") > 0) & (F.size("x") % parts == 0) & ~F.exists("x", lambda v: v.isNull()))
    first = [r["x"] for r in first.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()]  # a codebook's size
    size = len(first[0]) if first else parts
    dims = size // parts
    start = np.array([x for x in first if len(x) == size], np.float64).reshape(-1, size)
    books = [start[:, k * dims: (k + 1) * dims] for k in range(parts)]
    fits = (F.size("x") == size) & ~F.exists("x", lambda v: v.isNull())
    cells = unnest(rows.filter(fits), part=F.array(*[F.struct(F.lit(k).alias("position"), F.slice("x", k * dims + 1, dims).alias("part")) for k in range(parts)]))
    distinct = cells.groupBy("part.position", "part.part").agg(F.count("*").alias("weight"))
    distinct = saved(distinct.repartitionByRange("position", "part").sortWithinPartitions("position", "part"), "parts")
    for _ in range(rounds if len(start) else 0):
        books = _round(distinct, books)
    digest = hashlib.sha256(",".join(str(int(v)) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    shared = spark.sparkContext.broadcast(books)

    def encode(batches):
        for batch in batches:
            codes, errors = [None] * batch.num_rows, [None] * batch.num_rows
            lists = batch.column("x")
            own = np.flatnonzero(batch.column("fits").to_numpy(zero_copy_only=False))
            if len(own):
                x = lists.take(pa.array(own)).flatten().to_numpy().reshape(len(own), size)
                code, error = np.zeros((len(own), parts), np.int64), 0
                for k, book in enumerate(shared.value):
                    values, inverse = _sorted_parts(x[:, k * dims: (k + 1) * dims])
                    both = _integers(values, book), _integers(book, values)
                    best, far = (np.concatenate(v) for v in zip(*[w[1:] for w in walk(*both)]))
                    code[:, k] = best[inverse]
                    error = error + far[inverse].astype(object)
                for i, c, e in zip(own.tolist(), code.tolist(), error.tolist()):
                    codes[i], errors[i] = "".join(f"{v:02x}" for v in c), e if e < 1 << 63 else None
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                                             names=["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    coded = rows.withColumn("fits", fits).select("vec_id", "label", "x", "fits").mapInArrow(encode, f"vec_id long, label {kind}, code string, error long")
    coded = saved(coded, "codes")
    sums = coded.groupBy(F.col("label").alias("same")).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("same"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
