"""Pairs of embeddings within a cosine threshold, by dual traversal of cover trees.

On unit vectors, cosine >= c is distance <= t = sqrt(2 - 2c). Farthest-first pivots
of a bounded sample, nested by halving radii, deal the vectors into cells; cells are
cut into blocks of bounded size, and each block's vectors form a tree of nested nets
with halving radii. Node pairs whose centres are further apart than t and both
covering radii are pruned; node pairs that lie within t as a whole are counted
without a look at their points; the rest is descended, down to exact products of
points. The sample only shapes the cells: radii are measured on all vectors, so the
result is exact for any sample. Block pairs are the tasks; they return link counts
and a spanning forest of their links, never the pairs.

A block is a file of the shared folder, written once and mapped by the tasks of all
its pairs, so vectors are shuffled once, however many pairs of blocks there are. They
are kept in the element type they came in; lengths of one are made where needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from vigil.llm.common import connected_components, map_file, put_file, written
from vigil.session import shared_dir

#: Vectors in a block, about; pivots at most; vectors sampled for pivots at most.
BLOCK, PIVOTS, SAMPLE = 4096, 1024, 4096
#: Block pairs of a task, and tasks at most, if there are so many of either.
PAIRS, TASKS = 64, 10_000
TOP, BOTTOM, LEAF = 1.0, 1 / 8, 8
EPS = 1e-9


def units_of(rows: np.ndarray) -> np.ndarray:
    """Rows at length one in double precision, each by itself."""
    x = rows.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def usable_rows(embeddings) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, vectors) for each length of the vectors: those that are not null, empty,
    zero, or with a null or non-finite component."""
    there = np.flatnonzero(np.asarray(embeddings.is_valid()))
    sizes = np.asarray(embeddings.value_lengths().take(pa.array(there)), np.int64)
    cells, starts, out = embeddings.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes, []
    for size in np.unique(sizes[sizes > 0]):
        some = np.flatnonzero(sizes == size)
        x = cells[starts[some][:, None] + np.arange(size)]
        fine = np.isfinite(x).all(axis=1) & x.any(axis=1)
        out.append((there[some[fine]], x[fine]))
    return out


def _usable(batches):
    for batch in batches:
        for at, x in usable_rows(batch["embedding"]):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), x.shape[1], np.int64)), pa.array([v.tobytes() for v in units_of(x)], pa.binary())],
                                             names=["dim", "unit"])


def matrix(units) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1) if units else np.empty((0, 0))


def farthest_first(x: np.ndarray, k: int) -> list[int]:
    """k rows, each the one farthest from those before it: any prefix covers the sample
    with the radius at which the next row joins."""
    chosen, far = [0], 2 - 2 * (x @ x[0])
    while len(chosen) < min(k, len(x)) and far.max() > EPS:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, 2 - 2 * (x @ x[chosen[-1]]))
    return chosen


def nearest_pivot(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest pivot, distance) of each unit row. Pivots that rounding cannot tell apart
    are told apart by sums in a fixed order, so that equal rows go to the same pivot
    wherever they stand."""
    dots = x @ pivots.T
    best = dots.argmax(axis=1)
    close = dots >= dots.max(axis=1, keepdims=True) - EPS
    doubt = np.flatnonzero(close.sum(axis=1) > 1)
    for lo in range(0, len(doubt), 64):
        rows = doubt[lo: lo + 64]
        exact = np.zeros((len(rows), len(pivots)))
        for i in range(x.shape[1]):
            exact += x[rows, i, None] * pivots[None, :, i]
        best[rows] = exact.argmax(axis=1)
    return best, np.sqrt(np.maximum(2 - 2 * dots[np.arange(len(x)), best], 0))


def _cells(pivots: dict[int, np.ndarray]):
    """Usable vectors with the nearest pivot of the same dimension, and the distance to it."""
    def run(batches):
        for batch in batches:
            for at, x in usable_rows(batch["embedding"]):
                for lo in range(0, len(at), 1024):
                    part = x[lo: lo + 1024]
                    cell, dist = nearest_pivot(units_of(part), pivots[x.shape[1]])
                    yield pa.RecordBatch.from_arrays(
                        [batch["vec_id"].take(pa.array(at[lo: lo + 1024])), pa.array([v.tobytes() for v in part], pa.binary()),
                         pa.array(np.full(len(part), x.shape[1], np.int64)), pa.array(cell.astype(np.int64)), pa.array(dist)],
                        names=["vec_id", "raw", "dim", "cell", "dist"])
    return run


class Tree:
    """Nested nets over the rows of a block. Points are in tree order, so a node is a
    range; columns of ``nodes``: start, end, centre, first child, children."""

    def __init__(self, x: np.ndarray, top: float = TOP):
        order, nodes, radii = [], [], []

        def net(idx, r):
            alive, out = np.ones(len(idx), bool), []
            y = x[idx]
            for k in range(len(idx)):
                if alive[k]:
                    d = 2 - 2 * (y @ y[k])
                    d[k] = 0
                    mine = alive & (d <= r * r)
                    alive &= ~mine
                    members = np.flatnonzero(mine)
                    out.append((idx[k], idx[members], float(np.sqrt(max(0.0, d[members].max())))))
            return out

        def grow(at, centre, idx, radius, r):
            start, first, kids = len(order), 0, []
            while len(idx) > LEAF and r > BOTTOM and len(kids) < 2:
                r /= 2
                kids = net(idx, r)
            if len(kids) > 1:
                first = len(nodes)
                nodes.extend([None] * len(kids))
                radii.extend([0.0] * len(kids))
                for k, (c, members, rad) in enumerate(kids):
                    grow(first + k, c, members, rad, r)
            else:
                kids = []
                order.extend(idx.tolist())
            nodes[at], radii[at] = (start, len(order), centre, first, len(kids)), radius

        roots = net(np.arange(len(x)), top)
        nodes.extend([None] * len(roots))
        radii.extend([0.0] * len(roots))
        for k, (c, members, rad) in enumerate(roots):
            grow(k, c, members, rad, top)
        self.order = np.asarray(order, np.int64)
        place = np.empty(len(x), np.int64)
        place[self.order] = np.arange(len(x))
        self.nodes = np.asarray(nodes, np.int64).reshape(-1, 5)
        self.nodes[:, 2] = place[self.nodes[:, 2]]
        self.radii, self.roots, self.x = np.asarray(radii) + EPS, len(roots), x[self.order]


def _plant(t: float):
    """One row a block: its tree, points in tree order. Roots cover no more than the link
    distance: wider ones reach half of all other roots where vectors have no structure."""
    def run(key, table):
        tree = Tree(matrix(table["unit"].to_pylist()), min(TOP, t))
        ids = np.asarray(table["vec_id"])[tree.order]
        return pa.table({"block": [table["block"][0].as_py()], "ids": [ids.tobytes()], "points": [tree.x.tobytes()],
                         "nodes": [tree.nodes.tobytes()], "radii": [tree.radii.tobytes()], "roots": [tree.roots], "order": [tree.order.tobytes()]},
                        schema=pa.schema([("block", pa.string()), ("ids", pa.binary()), ("points", pa.binary()), ("nodes", pa.binary()),
                                          ("radii", pa.binary()), ("roots", pa.int64()), ("order", pa.binary())]))
    return run


def _store(folder: str, kind: type, t: float):
    """A block's vectors and tree as a file; rows that repeat id and unit vector are one."""
    plant = _plant(t)

    def run(key, table):
        dim, block = table["dim"][0].as_py(), table["block"][0].as_py()
        raw = np.frombuffer(b"".join(table["raw"].to_pylist()), kind).reshape(-1, dim)
        ids, units = np.asarray(table["vec_id"]), [v.tobytes() for v in units_of(raw)]
        once = sorted({(i, u): n for n, (i, u) in enumerate(zip(ids.tolist(), units))}.values())
        row, = plant(key, pa.table({"vec_id": ids[once], "block": [block] * len(once), "unit": pa.array([units[n] for n in once], pa.binary())})).to_pylist()
        nodes = np.frombuffer(row["nodes"], np.int64)
        head = np.array([len(once), dim, len(nodes) // 5, row["roots"]], np.int64)
        order = np.asarray(once)[np.frombuffer(row["order"], np.int64)]
        put_file(folder, block, lambda f: [f.write(x) for x in (
            head.tobytes(), row["ids"], row["radii"], nodes.astype(np.int32).tobytes(), raw[order].tobytes())])
        return pa.table({"dim": [dim], "cell": [table["cell"][0].as_py()], "block": [block]},
                        schema=pa.schema([("dim", pa.int64()), ("cell", pa.int64()), ("block", pa.string())]))
    return run


def _load(folder: str, block: str, kind: type) -> _Block:
    data = map_file(folder, block)
    n, dim, nodes, roots = np.frombuffer(data, np.int64, 4).tolist()
    ids = np.frombuffer(data, np.int64, n, 32)
    radii = np.frombuffer(data, np.float64, nodes, 32 + 8 * n)
    tree = np.frombuffer(data, np.int32, 5 * nodes, 32 + 8 * (n + nodes)).astype(np.int64)
    raw = np.frombuffer(data, kind, n * dim, 32 + 8 * n + 28 * nodes).reshape(n, dim)
    return _Block({"ids": ids, "points": units_of(raw), "nodes": tree, "radii": radii, "roots": roots})


class _Block:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.x = np.frombuffer(row["points"], np.float64).reshape(len(self.ids), -1)
        self.nodes = np.frombuffer(row["nodes"], np.int64).reshape(-1, 5)
        self.radii, self.roots = np.frombuffer(row["radii"], np.float64), row["roots"]
        self.start, self.end, centre, self.first, self.kids = self.nodes.T
        self.centres = self.x[centre]


def _expand(a, b, first, kids):
    """Pairs with a's children in place of a."""
    n = kids[a]
    child = np.arange(n.sum()) + np.repeat(first[a] - np.cumsum(n) + n, n)
    return child, np.repeat(b, n)


def _root_pairs(a: _Block, b: _Block, t: float):
    """(roots of a, roots of b) that may hold a link, and a few more: products in single
    precision, against bounds lowered by more than its rounding. Roots that are a single
    point, most of them where vectors have no structure, share one bound a row."""
    slack = np.float32(np.finfo(np.float32).eps * (a.x.shape[1] + 16))
    x, ra = a.centres[: a.roots].astype(np.float32), a.radii[: a.roots]
    rb = b.radii[: b.roots]
    lone = rb <= 2 * EPS
    for columns, alike in ((np.flatnonzero(lone), True), (np.flatnonzero(~lone), False)):
        y = np.ascontiguousarray(b.centres[columns].astype(np.float32).T)
        for lo in range(0, a.roots, 512):
            if not len(columns):
                break
            reach = (t + 3 * EPS + ra[lo: lo + 512])[:, None] + (0.0 if alike else rb[None, columns])
            bound = np.where(reach < 2, 1 - reach * reach / 2, -2.0).astype(np.float32) - slack
            i, j = np.divmod(np.flatnonzero(x[lo: lo + 512] @ y >= bound), len(columns))
            yield i + lo, columns[j]


def block_links(a: _Block, b: _Block, same: bool, cosine: float):
    """Dual traversal: (links of each point of a, of b, component label of each point)."""
    t = np.sqrt(2 - 2 * cosine)
    na, nb = len(a.ids), 0 if same else len(b.ids)
    count_a, count_b = np.zeros(na + 1, np.int64), np.zeros(len(b.ids) + 1, np.int64)
    whole_a, whole_b, us, vs = set(), set(), [], []

    def near(pa_, pb_, dots):
        d = np.sqrt(np.maximum(2 - 2 * dots, 0))
        if same:
            d[pa_ == pb_] = 0
        r = a.radii[pa_] + b.radii[pb_]
        keep = d <= t + r + EPS
        inside = d + r <= t - EPS
        i, j = pa_[inside], pb_[inside]
        if len(i):  # every point of one links with every point of the other
            twin = same & (i == j)
            sa, sb = a.end[i] - a.start[i], b.end[j] - b.start[j]
            np.add.at(count_a, a.start[i], sb - twin)
            np.add.at(count_a, a.end[i], -(sb - twin))
            other, target = ~twin, (count_a if same else count_b)
            np.add.at(target, b.start[j][other], sa[other])
            np.add.at(target, b.end[j][other], -sa[other])
            big = (sa + sb - twin) > 1
            whole_a.update(i[big & (~twin | (sa > 1))].tolist())
            (whole_a if same else whole_b).update(j[big & other].tolist())
            us.append(a.start[i][other])
            vs.append(b.start[j][other] + (0 if same else na))
        rest = keep & ~inside
        return pa_[rest], pb_[rest]

    todo = []
    for i, j in _root_pairs(a, b, t):
        if same:
            i, j = i[i <= j], j[i <= j]
        for lo in range(0, len(i), 1 << 16):
            k, m = i[lo: lo + (1 << 16)], j[lo: lo + (1 << 16)]
            todo.append(near(k, m, np.einsum("ij,ij->i", a.centres[k], b.centres[m])))
    pa_, pb_ = (np.concatenate(x) for x in zip(*todo)) if todo else (np.empty(0, np.int64),) * 2
    while len(pa_):
        leaf_a, leaf_b = a.kids[pa_] == 0, b.kids[pb_] == 0
        both = leaf_a & leaf_b
        _points(a, b, pa_[both], pb_[both], same, cosine, na, count_a, count_b, us, vs)
        pa_, pb_, leaf_a, leaf_b = pa_[~both], pb_[~both], leaf_a[~both], leaf_b[~both]
        if not len(pa_):
            break
        twin = (pa_ == pb_) & same
        down_a = ~twin & ~leaf_a & (leaf_b | (a.radii[pa_] >= b.radii[pb_]))
        x1, y1 = _expand(pa_[down_a], pb_[down_a], a.first, a.kids)
        down_b = ~twin & ~down_a
        y2, x2 = _expand(pb_[down_b], pa_[down_b], b.first, b.kids)
        x3, y3 = _expand(pa_[twin], pb_[twin], a.first, a.kids)  # a node with itself: its children's pairs
        y4, x4 = _expand(y3, x3, b.first, b.kids)
        upper = x4 <= y4
        nx, ny = np.concatenate((x1, x2, x4[upper])), np.concatenate((y1, y2, y4[upper]))
        out = []
        for lo in range(0, len(nx), 1 << 16):
            i, j = nx[lo: lo + (1 << 16)], ny[lo: lo + (1 << 16)]
            out.append(near(i, j, np.einsum("ij,ij->i", a.centres[i], b.centres[j])))
        pa_, pb_ = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 2

    for block, nodes, shift in ((a, whole_a, 0), (b, whole_b, na)):
        for k in nodes:
            us.append(np.full(block.end[k] - block.start[k], block.start[k] + shift))
            vs.append(np.arange(block.start[k], block.end[k]) + shift)
    labels = np.arange(na + nb)
    if us:
        u, v = np.concatenate(us), np.concatenate(vs)
        while True:
            least = np.minimum(labels[u], labels[v])
            new = labels.copy()
            np.minimum.at(new, labels[u], least)
            np.minimum.at(new, labels[v], least)
            while True:
                jump = new[new]
                if (jump == new).all():
                    break
                new = jump
            if (new == labels).all():
                break
            labels = new
    return np.cumsum(count_a)[:-1], np.cumsum(count_b)[:-1], labels


def _points(a, b, i, j, same, cosine, na, count_a, count_b, us, vs):
    """Exact products of the points of leaf pairs, a bounded number at a time."""
    size = (a.end[i] - a.start[i]) * (b.end[j] - b.start[j])
    cuts = np.searchsorted(np.cumsum(size), np.arange(0, size.sum(), 1 << 16), side="left") if len(i) else []
    for lo, hi in zip(cuts, [*cuts[1:], len(i)]):
        k, m = i[lo:hi], j[lo:hi]
        n = a.end[k] - a.start[k]
        p = np.arange(n.sum()) + np.repeat(a.start[k] - np.cumsum(n) + n, n)
        m = np.repeat(m, n)
        n = b.end[m] - b.start[m]
        q = np.arange(n.sum()) + np.repeat(b.start[m] - np.cumsum(n) + n, n)
        p = np.repeat(p, n)
        if same:  # leaves are disjoint, so only a leaf with itself holds a pair both ways
            one = (p < q) | (np.repeat(np.repeat(i[lo:hi] != j[lo:hi], a.end[k] - a.start[k]), n))
            p, q = p[one], q[one]
        hit = np.einsum("ij,ij->i", a.x[p], b.x[q]) >= cosine
        p, q = p[hit], q[hit]
        for out, points in ((count_a, p), (count_a if same else count_b, q)):
            np.add.at(out, points, 1)
            np.add.at(out, points + 1, -1)
        us.append(p)
        vs.append(q + (0 if same else na))


def _pair_links(folder: str, kind: type, cosine: float):
    """Links of block pairs; a block stays in memory while it is the left one of the next."""
    def run(batches):
        name, a = None, None
        for batch in batches:
            for left, right in zip(batch["left"].to_pylist(), batch["right"].to_pylist()):
                if left != name:
                    name, a = left, _load(folder, left, kind)
                same = left == right
                b = a if same else _load(folder, right, kind)
                count_a, count_b, labels = block_links(a, b, same, cosine)
                ids = a.ids if same else np.concatenate((a.ids, b.ids))
                count = count_a if same else np.concatenate((count_a, count_b))
                some = count > 0
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(count[some]), pa.array(ids[labels[some]])], names=["vec_id", "links", "root"])
    return run


def _kept_cells(pivots: np.ndarray, radius: np.ndarray, t: float) -> list[tuple[int, int]]:
    """Cell pairs that may hold a link, by a dual traversal of the nested pivots: the
    first pivots, at halving numbers, stand for the cells whose chain of nearest
    pivots leads to them, and reach as far as those cells do."""
    n, levels = len(pivots), [1]
    while levels[-1] < n:
        levels.append(min(n, levels[-1] * 2))
    ups = []  # for each level but the last: the parents of the next level's pivots
    for level, below in zip(levels, levels[1:]):
        up = (pivots[:below] @ pivots[:level].T).argmax(axis=1)
        up[:level] = np.arange(level)
        ups.append(up)
    owners = [np.arange(n)]
    for up in reversed(ups):
        owners.append(up[owners[-1]])
    pairs = np.zeros((1, 2), np.int64)
    for at, (level, owner) in enumerate(zip(levels, reversed(owners))):
        gap = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", pivots, pivots[owner]), 0))
        gap[owner == np.arange(n)] = 0
        reach = np.full(level, -np.inf)
        np.maximum.at(reach, owner, np.where(radius >= 0, gap + radius, -np.inf))
        i, j = pairs.T
        d = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", pivots[i], pivots[j]), 0))
        pairs = pairs[(i == j) | (d <= t + reach[i] + reach[j] + EPS)]
        if level < n:
            kids = [np.flatnonzero(ups[at] == k) for k in range(level)]
            new = {(min(x, y), max(x, y)) for a, b in pairs for x in kids[a] for y in kids[b]}
            pairs = np.asarray(sorted(new), np.int64).reshape(-1, 2)
    return [(int(a), int(b)) for a, b in pairs]


def near_vectors(vectors: DataFrame, *, cosine: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id,
    embedding): the other vectors at cosine >= ``cosine`` (0 < cosine < 1), the smallest
    vec_id reachable by links, and whether that is the row's own.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, as do rows without an id (their component is null, they are kept) and
    vectors of different lengths with each other. Rows that repeat id and vector count
    once and get the same result; different vectors under one id add their links up.
    An empty table gives an empty result. Other columns are not read.
    """
    t = float(np.sqrt(2 - 2 * cosine))
    spark, kind = vectors.sparkSession, vectors.schema["embedding"].dataType
    short = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    kind, element = (np.float32, "float") if short else (np.float64, "double")
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{element}>").alias("embedding"))
    known = base.filter("vec_id is not null")
    pivots: dict[int, np.ndarray] = {}
    for r in known.mapInArrow(_usable, "dim long, unit binary").groupBy("dim").count().collect():  # a row a dimension
        share = int(min(1.0, SAMPLE / r["count"]) * (1 << 20))
        some = known.filter(F.size("embedding") == r["dim"])
        picked = some.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < share).select("embedding")
        x = matrix([u[0] for u in picked.mapInArrow(_usable, "dim long, unit binary").select("unit").limit(2 * SAMPLE).collect()]
                   or [some.select("embedding").mapInArrow(_usable, "dim long, unit binary").first()["unit"]])
        pivots[int(r["dim"])] = x[farthest_first(x, min(PIVOTS, -(-r["count"] // BLOCK)))]
    dealt = written(known.mapInArrow(_cells(pivots), "vec_id long, raw binary, dim long, cell long, dist double"), "cells")
    cells = dealt.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("dist").alias("radius")).collect()  # PIVOTS rows a dimension
    kept = []
    for d, p in pivots.items():
        radius = np.full(len(p), -1.0)
        for r in cells:
            if r["dim"] == d:
                radius[r["cell"]] = r["radius"]
        kept += [(d, a, b) for a, b in _kept_cells(p, radius, t) if radius[a] >= 0 and radius[b] >= 0]
    sizes = spark.createDataFrame([(r["dim"], r["cell"], -(-r["n"] // BLOCK)) for r in cells], "dim long, cell long, parts long")
    part = F.pmod(F.xxhash64(F.lit(7), "vec_id"), F.col("parts"))
    folder = shared_dir(spark, "blocks")
    placed = (dealt.join(F.broadcast(sizes), ["dim", "cell"])
              .select("vec_id", "raw", "dim", "cell", F.concat_ws("-", "dim", "cell", part).alias("block"))
              .repartition("block").distinct())  # one shuffle for both
    blocks = written(placed.groupBy("block").applyInArrow(_store(folder, kind, t), "dim long, cell long, block string"), "names")
    pairs = spark.createDataFrame(kept, "dim long, a long, b long")
    pairs = (pairs.join(blocks.select("dim", F.col("cell").alias("a"), F.col("block").alias("left")), ["dim", "a"])
             .join(blocks.select("dim", F.col("cell").alias("b"), F.col("block").alias("right")), ["dim", "b"])
             .filter((F.col("a") != F.col("b")) | (F.col("left") <= F.col("right"))).select("left", "right"))
    tasks = max(1, min(TASKS, max(4 * spark.sparkContext.defaultParallelism, pairs.count() // PAIRS)))
    found = written(pairs.repartitionByRange(tasks, "left", "right").sortWithinPartitions("left", "right")
                    .mapInArrow(_pair_links(folder, kind, cosine), "vec_id long, links long, root long"), "links")
    links = found.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    labels = connected_components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    return (base.select("vec_id").join(links, "vec_id", "left")
            .join(labels.withColumnRenamed("node", "vec_id"), "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
