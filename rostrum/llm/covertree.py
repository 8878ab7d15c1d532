"""Operator 8: exact cosine near-duplicates by dual traversal of cover trees.

Equal vectors are one class. Classes are dealt to cells around centres, and cells to blocks of a bounded number of vectors. Every block
is a cover tree of nested levels with halving radii, each node with the true radius of what it covers. Two blocks are traversed together,
level by level: a pair of nodes goes on only if its centres are no farther apart than both radii and the distance of the threshold.
Distances of node pairs are matrix products, and leaves are compared by the cosine itself in double precision.

For unit vectors a cosine of t is a distance of sqrt(2 - 2t). Pairs of blocks are pruned by the cells' radii first. Vectors without
any structure have no radius that prunes, then every pair of blocks meets; that cost is quadratic, as for every exact method.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rostrum.llm.components import components
from rostrum.llm.fixed import bounded_batches, saved
from rostrum.llm.words import groups

SLACK = 1e-9
POINTS = 1 << 21  # so many point pairs are compared at once rather than by further levels


def unit_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, unit): bytes of the normalised vector, null where it is null, empty, zero or not finite."""
    def kernel(batches):
        for batch in batches:
            out = []
            for v in batch.column("v").to_pylist():
                x = None if not v or any(c is None for c in v) else np.array(v, np.float64)
                if x is not None:
                    top = np.abs(x).max()
                    x = x / top if 0 < top < np.inf else None  # scaled first, so that no square over- or underflows
                out.append(None if x is None else (x / math.sqrt(float(x @ x))).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "unit"])

    named = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    return named.mapInArrow(kernel, "vec_id long, unit binary")


def net(points: np.ndarray, radius: float, step: int = 256) -> np.ndarray:
    """Greedy net: points that lie farther than ``radius`` from all earlier ones of the net; for each point a net member that covers it.

    Points are taken in steps: one matrix product with the net so far, then a greedy choice among those left uncovered.
    """
    close = 1 - radius * radius / 2
    chosen, kept = np.empty(len(points), np.int64), np.empty_like(points)
    owner, n = np.empty(len(points), np.int64), 0
    for a in range(0, len(points), step):
        part = points[a: a + step]
        best, who = np.full(len(part), -2.0), np.zeros(len(part), np.int64)
        if n:
            g = part @ kept[:n].T
            at = np.argmax(g, axis=1)
            best, who = g[np.arange(len(part)), at], chosen[at]
        inner = part @ part.T
        for i in range(len(part)):
            if best[i] < close:
                chosen[n], kept[n] = a + i, part[i]
                n += 1
                better = inner[i] > best
                better[:i] &= best[:i] < close
                best[better], who[better] = inner[i][better], a + i
                best[i], who[i] = 2.0, a + i
        owner[a: a + step] = who
    return owner


def levels(points: np.ndarray, radii: list[float]) -> list[np.ndarray]:
    """Nested levels, coarsest first: per level the owner of each point, every owner of a level being a point of the next."""
    out: list[np.ndarray] = []
    member = np.arange(len(points))
    owner = np.arange(len(points))
    for r in sorted(radii):  # from the finest up
        step = net(points[member], r)
        parent = np.empty(len(points), np.int64)
        parent[member] = member[step]
        owner = parent[owner]
        out.append(owner.copy())
        member = np.unique(owner)
    return out[::-1]


class Tree:
    """Levels of one block: the nodes of each with centre, children at the next level, and covering radius; the last level is the points."""

    def __init__(self, points: np.ndarray, owners: list[np.ndarray]):
        self.points = points
        self.nodes, self.radius, self.count, self.children = [], [], [], []
        for owner in owners:
            far = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", points, points[owner])))
            far[owner == np.arange(len(points))] = 0
            radius = np.zeros(len(points))
            np.maximum.at(radius, owner, far)
            node = np.unique(owner)
            self.nodes.append(node)
            self.radius.append(radius[node])
            self.count.append(np.bincount(owner, minlength=len(points))[node])
        self.nodes.append(np.arange(len(points)))
        self.radius.append(np.zeros(len(points)))
        self.count.append(np.ones(len(points), np.int64))
        self.owners = owners
        self.under = [np.argsort(o, kind="stable") for o in owners]  # the points by their node of a level
        self.start = [np.cumsum(c) - c for c in self.count]
        for k, owner in enumerate(owners):
            below = owner[self.nodes[k + 1]]
            order = np.argsort(below, kind="stable")
            cut = np.searchsorted(below[order], self.nodes[k])
            self.children.append((order, np.append(cut, len(order))))

    def child(self, k: int, node: int) -> np.ndarray:
        """The nodes of the next level under one node."""
        order, cut = self.children[k]
        return order[cut[node]: cut[node + 1]]

    def below(self, k: int, nodes: np.ndarray) -> np.ndarray:
        """The points under some nodes of a level."""
        return np.concatenate([self.under[k][self.start[k][v]: self.start[k][v] + self.count[k][v]] for v in nodes])


def _near(g: np.ndarray, own: np.ndarray, radius: np.ndarray, loss: float) -> tuple[np.ndarray, np.ndarray]:
    """Node pairs that may hold a pair, by their cosines and radii, which ascend; nodes of radius 0 share one bound per row."""
    own, points = own.astype(np.float32)[:, None], int(np.searchsorted(radius, 0, side="right"))
    found = []
    for part, first, more in ((g[:, :points], 0, None), (g[:, points:], points, radius[points:])):
        if part.size:
            most = own if more is None else own + more.astype(np.float32)[None, :]
            at = np.flatnonzero(part >= np.float32(1 - loss) - most * most / 2)
            found.append((at // part.shape[1], at % part.shape[1] + first))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _close(a: Tree, b: Tree, p: np.ndarray, q: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of some point pairs whose cosine in double precision reaches the threshold."""
    sure = np.zeros(len(p), bool)
    for c in range(0, len(p), 65536):
        sure[c: c + 65536] = np.einsum("ij,ij->i", a.points[p[c: c + 65536]], b.points[q[c: c + 65536]]) >= threshold
    return p[sure], q[sure]


def _cross(a: Tree, b: Tree, k: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of points under some pairs of nodes of level k."""
    n, m = a.count[k][x], b.count[k][y]
    size = n * m
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    x, y, m = np.repeat(a.start[k][x], size), np.repeat(b.start[k][y], size), np.repeat(m, size)
    return a.under[k][x + at // m], b.under[k][y + at % m]


def pairs(a: Tree, b: Tree, threshold: float, chunk: int = 512):
    """Index pairs (of a's and b's points) with a cosine of at least ``threshold``, in pieces of at most ``chunk`` points of a.

    Node pairs are first compared in single precision, with its rounding error added to the bound. What is left of a chunk goes down to its points
    at once if these are not many more than the nodes compared so far; else the nodes go down a level, together where most of them meet.
    """
    reach = math.sqrt(2 - 2 * threshold) + SLACK
    loss = (a.points.shape[1] + 8) * 2.0**-22
    x32, y32 = (t.points.astype(np.float32) for t in (a, b))
    todo = [(np.arange(len(a.nodes[0])), np.arange(len(b.nodes[0])), 0)]
    last = len(a.nodes) - 1
    while todo:
        x, y, k = todo.pop()
        y = y[np.argsort(b.radius[k][y], kind="stable")]
        others, radius = y32[b.nodes[k][y]].T, b.radius[k][y]
        for s in range(0, len(x), chunk):
            i = x[s: s + chunk]
            g = x32[a.nodes[k][i]] @ others
            if k == last:
                hit = np.flatnonzero(g >= np.float32(threshold - loss))
                yield _close(a, b, i[hit // len(y)], y[hit % len(y)], threshold)
                continue
            p, q = _near(g, a.radius[k][i] + reach, radius, loss)
            p, q = i[p], y[q]
            work = a.count[k][p] * b.count[k][q]
            light = work <= 64
            if 32 * int(work[light].sum()) <= g.size:  # few point pairs: taken at once
                yield _close(a, b, *_cross(a, b, k, p[light], q[light]), threshold)
                p, q = p[~light], q[~light]
            if not len(p):
                continue
            some, met = np.unique(p), np.unique(q)
            if int(a.count[k][some].sum()) * int(b.count[k][met].sum()) <= 8 * g.size:
                todo.append((a.below(k, some), b.below(k, met), last))
                continue
            wide = a.radius[k][p] > 0  # such nodes meet many others, points mostly such nodes
            for u, v in ((p[wide], q[wide]), (p[~wide], q[~wide])):
                some, met = np.unique(u), np.unique(v)
                dense = 2 * len(u) > len(some) * len(met)
                for nodes, partners in [(some, met)] if dense and len(u) else [(np.array([j]), m) for j, m in _grouped(u, v)]:
                    if int(a.count[k][nodes].sum()) * int(b.count[k][partners].sum()) <= max(POINTS, 4 * len(nodes) * len(partners)):
                        todo.append((a.below(k, nodes), b.below(k, partners), last))
                    else:
                        todo.append((np.concatenate([a.child(k, j) for j in nodes]), np.concatenate([b.child(k, j) for j in partners]), k + 1))


def _grouped(key: np.ndarray, other: np.ndarray):
    """Each distinct key with its partners."""
    order = np.argsort(key, kind="stable")
    names, first = np.unique(key[order], return_index=True)
    yield from zip(names, np.split(other[order], first[1:]))


def _centres(classes: DataFrame, cells: int, sample: int) -> np.ndarray:
    """At most ``cells`` centres, the farthest from each other in a bounded sample chosen by hash."""
    rows = classes.orderBy(F.xxhash64("unit")).limit(sample).collect()
    size = max((len(r["unit"]) for r in rows), default=8)
    x = np.array([np.frombuffer(r["unit"], np.float64) for r in rows if len(r["unit"]) == size]).reshape(-1, size // 8)
    chosen = [0] if len(x) else []
    near = x @ x[0] if len(x) else x
    while len(x) and len(chosen) < min(cells, len(x)):
        c = int(np.argmin(near))
        chosen.append(c)
        near = np.maximum(near, x @ x[c])
    return x[chosen]


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95, block: int = 8192,
                    sample: int = 2048, radii: tuple[float, ...] = (1.0, 0.5, 0.25, 0.125)) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row; vectors of one length are compared whatever their labels.

    Null, empty, zero or non-finite vectors and null components link with nothing. Equal vectors link with each other and share their other
    links, without their pairs being listed. The centres come from a bounded sample and only steer the work; every vector is compared.
    Rows that repeat an id are vectors of their own with that id.
    """
    spark = bounded_batches(vectors.sparkSession)
    units = saved(unit_vectors(vectors, vec_id, embedding), "units")
    classes = units.filter("unit is not null").groupBy("unit").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    classes = saved(classes.withColumn("class", F.monotonically_increasing_id()), "vectors")
    total = classes.count()
    cells = max(1, total // block)
    centres = _centres(classes, cells, max(sample, 4 * cells))
    shared = spark.sparkContext.broadcast(centres)

    def cell(batches):
        for batch in batches:
            units = batch.column("unit").to_pylist()
            where, far = np.zeros(len(units), np.int32), np.full(len(units), 2.0)  # vectors of another length lie in the first cell
            own = [i for i, u in enumerate(units) if len(u) == 8 * shared.value.shape[1]]
            for s in range(0, len(own), 1024):
                part = own[s: s + 1024]
                g = np.stack([np.frombuffer(units[i], np.float64) for i in part]) @ shared.value.T
                where[part] = np.argmax(g, axis=1)
                far[part] = np.sqrt(np.maximum(0.0, 2 - 2 * g.max(axis=1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(where, pa.int32()), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    placed = saved(classes.select("class", "unit", "weight").mapInArrow(cell, "class long, unit binary, weight long, cell int, far double"), "placed")
    # One row per cell, that is per block of vectors: sizes and radii, and which cells may hold a pair.
    stats = {r["cell"]: (r["n"], r["far"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    reach = math.sqrt(2 - 2 * threshold) + SLACK
    blocks = {c: -(-n // block) for c, (n, _) in stats.items()}
    meets = []
    for c, (_, far) in stats.items():
        for d, (_, other) in stats.items():
            apart = float(np.linalg.norm(centres[c] - centres[d])) if len(centres) else 0.0
            if apart <= far + other + reach:
                meets.append((c, blocks[c], d, blocks[d]))
    plan = spark.createDataFrame([(c, d, n) for c, _, d, n in meets], "cell int, other int, others int")
    # A block is (cell, part). Its tree is built once; the rows carry the class of their node at each level.
    radii, parts = sorted(radii, reverse=True), spark.createDataFrame([(c, k) for c, k in blocks.items()], "cell int, own int")

    def grow(batches):
        for g in groups(batches, "cell", "part"):
            for size in {len(u) for u in g["unit"]}:
                own = [i for i, u in enumerate(g["unit"]) if len(u) == size]
                name = np.array([g["class"][i] for i in own])
                over = levels(np.stack([np.frombuffer(g["unit"][i], np.float64) for i in own]), radii)
                cols = {c: [g[c][i] for i in own] for c in ("class", "unit", "weight", "cell", "part")}
                yield pa.RecordBatch.from_pydict({
                    "class": pa.array(name), "unit": pa.array(cols["unit"], pa.binary()), "weight": pa.array(cols["weight"], pa.int64()),
                    "cell": pa.array(cols["cell"], pa.int32()), "part": pa.array(cols["part"], pa.int32()),
                    "over": pa.array(np.stack([name[o] for o in over], axis=1).tolist(), pa.list_(pa.int64()))})

    block_of = placed.join(F.broadcast(parts), "cell").withColumn("part", F.expr("cast(pmod(xxhash64(class), own) as int)"))
    grown = block_of.select("class", "unit", "weight", "cell", "part").repartition("cell", "part").sortWithinPartitions("cell", "part", "class")
    grown = saved(grown.mapInArrow(grow, "class long, unit binary, weight long, cell int, part int, over array<long>"), "trees")
    # A tile is a pair of blocks, the smaller first. Each row goes to the tiles of its block.
    dealt = grown.join(F.broadcast(plan), "cell").select(
        "class", "unit", "weight", "over", "cell", "part", "other", F.explode(F.expr("sequence(0, others - 1)")).alias("other_part"))
    mine, theirs = F.struct("cell", "part"), F.struct(F.col("other"), F.col("other_part"))
    tiles = dealt.select(
        F.when(mine <= theirs, F.concat_ws(".", "cell", "part", "other", "other_part")).otherwise(F.concat_ws(".", "other", "other_part", "cell", "part")).alias("tile"),
        (mine <= theirs).alias("first"), (mine == theirs).alias("same"), "class", "unit", "weight", "over")

    def kernel(batches):
        for tile in _runs(batches, "tile"):
            sizes = pc.binary_length(tile.column("unit"))
            for size in pc.unique(sizes):
                rows = tile.filter(pc.equal(sizes, size))
                left = rows.filter(rows.column("first"))
                right = left if rows.column("same")[0].as_py() else rows.filter(pc.invert(rows.column("first")))
                if left.num_rows and right.num_rows:
                    a = _side(left)
                    yield from _tile(a, a if right is left else _side(right), right is left, threshold)

    links = tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(kernel, "class long, n long, mate long")
    links = saved(links, "mates")
    extra = links.groupBy("class").agg(F.sum("n").alias("n"))
    ids = classes.select("class", "unit", "weight", "node")
    joined = components(links.filter("mate is not null").select(F.col("class").alias("a"), F.col("mate").alias("b")))
    named = ids.join(extra, "class", "left").join(joined.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("node").alias("component_id"))
    named = saved(named.join(least, "component").select("unit", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"), "named")
    found = units.join(named, "unit", "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                        F.col("vec_id").eqNullSafe(component).alias("kept"))


def _runs(batches, key: str):
    """Tables of the rows with one key, from batches sorted by it; one table is held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        names = batch.column(key).to_pylist()
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[0].column(key)[0].as_py() != names[a]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _side(rows: pa.Table) -> tuple[Tree, np.ndarray, np.ndarray]:
    """Tree, classes and weights of one block from its rows, whose vectors have one length."""
    name, weight = rows.column("class").to_numpy(), rows.column("weight").to_numpy()
    points = np.frombuffer(b"".join(rows.column("unit").to_pylist()), np.float64).reshape(len(name), -1)
    over = pc.list_flatten(rows.column("over")).to_numpy().reshape(len(name), -1)
    order = np.argsort(name)
    owners = [order[np.searchsorted(name, over[:, k], sorter=order)] for k in range(over.shape[1])]
    return Tree(points, owners), name, weight


def _tile(left, right, same: bool, threshold: float):
    """Links of one tile: per class the weight of its partners and one class of the same group, the first of its rows."""
    (a, cx, wx), (b, cy, wy) = left, right
    x, y = a.points, b.points
    if same:
        b = a
    n = len(x) if same else len(x) + len(y)
    shift = 0 if same else len(x)
    count, group = np.zeros(n, np.int64), np.arange(n)
    weight = wx if same else np.concatenate([wx, wy])
    name = cx if same else np.concatenate([cx, cy])
    for i, j in pairs(a, b, threshold):
        j = j + shift
        if same:
            i, j = i[i < j], j[i < j]
        count += np.bincount(i, weight[j], n).astype(np.int64) + np.bincount(j, weight[i], n).astype(np.int64)
        while len(i):  # the smallest index of the group becomes its root; no pair is kept
            p, q = group[i], group[j]
            i, j = i[p != q], j[p != q]
            np.minimum.at(group, np.maximum(p, q), np.minimum(p, q))
            while not np.array_equal(root := group[group], group):
                group = root
    some = np.flatnonzero(count)
    if len(some):
        mate = [int(name[group[k]]) if group[k] != k else None for k in some]
        yield pa.RecordBatch.from_arrays([pa.array(name[some]), pa.array(count[some]), pa.array(mate, pa.int64())], names=["class", "n", "mate"])
