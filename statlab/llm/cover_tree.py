"""Near-duplicate vectors by a cover tree and a dual traversal of it.

The upper levels are tables: nodes with a centre and the covering radius measured over all of their vectors. Node
pairs descend level by level and are dropped when their centres are farther apart than both radii and the threshold
allow. Leaves hold a bounded number of vectors; a pair of leaves is one group, in which the traversal goes on over
levels of halving radii in memory, down to single vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statlab.llm.components import components
from statlab.session import stage

#: Vectors in a leaf, children of a node, and vectors of a node that are assigned to its children in one run.
LEAF, FAN, RUN = 2048, 64, 4096
LEVELS = 40
SLACK = 1e-9


def units(rows: np.ndarray) -> np.ndarray:
    """Vectors of length one in double precision; scaled first, so that no square overflows."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def chord(cosine: float) -> float:
    """The distance of unit vectors at this cosine: pairs within it link."""
    return math.sqrt(2.0 - 2.0 * cosine)


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


# --- the traversal within a pair of leaves


class Node:
    """Members of a leaf within ``radius`` of a centre; children have at most half the nominal radius."""

    def __init__(self, points: np.ndarray, members: np.ndarray, centre: int, nominal: float):
        self.members, self.centre, self.nominal = members, centre, nominal
        self.radius = float(_distances(points[members], points[centre:centre + 1]).max())
        self._children: list[Node] | None = None

    def children(self, points: np.ndarray) -> list[Node]:
        """Greedy centres, nested (the node's own comes first); none where half the radius covers too little."""
        if self._children is not None:
            return self._children
        self._children, half = [], min(self.nominal, self.radius) / 2.0
        if len(self.members) > 16 and half > 1e-12:
            left, found, centre = self.members, [], self.centre
            while len(left) and len(found) < 24:
                near = _distances(points[left], points[centre:centre + 1])[:, 0] <= half
                found.append((centre, left[near]))
                left = left[~near]
                centre = int(left[0]) if len(left) else -1
            if len(left) <= len(self.members) // 2:
                self._children = [Node(points, m, c, half) for c, m in found if len(m)]
                self._children += [Node(points, left, int(left[0]), self.nominal)] if len(left) else []
        return self._children


def linked_pairs(a: np.ndarray, b: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The index pairs with cosine >= ``cosine`` between unit vectors ``a`` and ``b``, or within ``a`` (i < j)."""
    limit = chord(cosine) + SLACK
    same = b is None
    b = a if same else b
    one = Node(a, np.arange(len(a)), 0, 2.0)
    two = one if same else Node(b, np.arange(len(b)), 0, 2.0)
    stack, left, right = [(one, two)], [], []
    while stack:
        x, y = stack.pop()
        if x is not y and _distances(a[x.centre:x.centre + 1], b[y.centre:y.centre + 1])[0, 0] > limit + x.radius + y.radius:
            continue
        xs, ys = x.children(a), y.children(b)
        if not xs and not ys:
            i, j = np.nonzero(a[x.members] @ b[y.members].T >= cosine)
            i, j = x.members[i], y.members[j]
            if x is y and same:
                i, j = i[i < j], j[i < j]
            left.append(i)
            right.append(j)
        elif x is y and same:
            stack += [(xs[i], xs[j]) for i in range(len(xs)) for j in range(i, len(xs))]
        elif xs and (not ys or x.radius >= y.radius):
            stack += [(c, y) for c in xs]
        else:
            stack += [(x, c) for c in ys]
    i, j = np.concatenate([*left, np.zeros(0, int)]), np.concatenate([*right, np.zeros(0, int)])
    return (np.minimum(i, j), np.maximum(i, j)) if same else (i, j)


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` points the smallest index reachable over the pairs."""
    label = np.arange(n)
    while len(i):
        least = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, least)
        np.minimum.at(after, j, least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    return label


def _leaf_pair(cosine: float):
    schema = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def joined(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        order = np.argsort(side, kind="stable")
        cids, weight = group.column("cid").to_numpy()[order], group.column("copies").to_numpy()[order]
        points = units(_matrix(group.column("vector").combine_chunks())[order])
        first = int((side == 0).sum())
        if first == len(points):
            i, j = linked_pairs(points, None, cosine)
        else:
            i, j = linked_pairs(points[:first], points[first:], cosine)
            j = j + first
        links = np.bincount(i, weight[j], len(points)) + np.bincount(j, weight[i], len(points))
        root = cids[spanning(i, j, len(points))]
        some = links > 0
        return pa.table([cids[some], links[some].astype(np.int64), root[some]], schema=schema)

    return joined


# --- the upper levels


def _one_of_nearest(away: np.ndarray, cids: np.ndarray) -> np.ndarray:
    """The nearest centre; among equally near ones a turn decides, so that vectors of one direction part as well."""
    near = away <= away.min(axis=1, keepdims=True) + SLACK
    turn = cids.view(np.uint64) % near.sum(axis=1).astype(np.uint64)
    return (np.cumsum(near, axis=1) > turn[:, None].astype(np.int64)).argmax(axis=1)


def _assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of cell and run, centres before vectors: each vector's nearest centre and its distance."""
    cell, centres, numbers = None, [], []
    ready = None
    for batch in batches:
        cells = list(zip(batch.column("cell").to_pylist(), batch.column("run").to_pylist()))
        kind, seed = batch.column("kind").to_numpy(), batch.column("seed").to_numpy()
        dims = batch.column("vector")
        breaks = [0, *[k for k in range(1, len(cells)) if cells[k] != cells[k - 1] or kind[k] != kind[k - 1]], len(cells)]
        for s, e in zip(breaks, breaks[1:]):
            if s == e:
                continue
            points = units(_matrix(dims.slice(s, e - s)))
            if kind[s] == 0:
                if cells[s] != cell:
                    cell, centres, numbers = cells[s], [], []
                centres.append(points)
                numbers.append(seed[s:e])
                ready = None
                continue
            if ready is None:
                ready = np.concatenate(centres), np.concatenate(numbers)
            away = _distances(points, ready[0])
            best = _one_of_nearest(away, batch.column("cid").to_numpy()[s:e])
            yield pa.RecordBatch.from_arrays(
                [batch.column("cell").slice(s, e - s), pa.array(ready[1][best]), batch.column("cid").slice(s, e - s),
                 batch.column("copies").slice(s, e - s), dims.slice(s, e - s), pa.array(away[np.arange(e - s), best])],
                ["parent", "seed", "cid", "copies", "vector", "away"])


def _centre_distance(a: str, b: str) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def _unit(column: str) -> Column:
    most = F.array_max(F.transform(column, lambda x: F.abs(x.cast("double"))))
    scaled = F.transform(column, lambda x: x.cast("double") / most)
    norm = F.sqrt(F.aggregate(scaled, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(scaled, lambda x: x / norm)


def cover_tree(vectors: DataFrame, leaf: int = LEAF) -> tuple[DataFrame, list[DataFrame]]:
    """The leaves (``cell, cid, copies, vector``) and the nodes of each level (``parent, cell, centre, radius``).

    ``vectors`` has ``cell`` (the roots' names), ``cid, copies, vector``. A level halves its parents' radii: each
    cell with more than ``leaf`` vectors takes up to 64 vectors, smallest hash first, as centres of its children, and
    each vector goes to the nearest. Radii are measured over all vectors, so the bounds hold however well the centres
    cover. Cells are assigned in runs of a bounded number of vectors, so a hot cell is many tasks' work.
    """
    points = stage(vectors.select("cell", "cid", "copies", "vector"), "vectors")
    roots = points.groupBy("cell").agg(F.min_by("vector", "cid").alias("first"))
    levels = [stage(roots.select(F.lit(None).cast("long").alias("parent"), "cell", _unit("first").alias("centre"), F.lit(2.0).alias("radius")), "nodes")]
    done = []
    for level in range(LEVELS):
        counts = points.groupBy("cell").agg(F.count("*").alias("n"))
        large = stage(counts.where(F.col("n") > leaf), "large")
        if not large.head(1):
            break
        done.append(points.join(large, "cell", "left_anti"))
        mine = stage(points.join(large, "cell"), "split")
        chance = F.xxhash64("cid", F.lit(level))
        ranked = mine.withColumn("seed", F.row_number().over(_by_cell(chance))).where(F.col("seed") <= FAN)
        seeds = stage(ranked.where(F.col("seed") <= F.ceil(F.col("n") * 2 / leaf)).select("cell", "seed", "n", "vector"), "seeds")
        runs = F.ceil(F.col("n") / RUN).cast("int")
        central = seeds.select(
            "cell", F.explode(F.sequence(F.lit(0), runs - 1)).alias("run"), F.lit(0).alias("kind"), "seed",
            F.lit(0).cast("long").alias("cid"), F.lit(0).cast("long").alias("copies"), "vector")
        others = mine.select(
            "cell", F.pmod(F.xxhash64("cid", F.lit("run")), runs).cast("int").alias("run"), F.lit(1).alias("kind"),
            F.lit(0).alias("seed"), "cid", "copies", "vector")
        together = central.unionByName(others).repartition("cell", "run").sortWithinPartitions("cell", "run", "kind")
        schema = "parent long, seed int, cid long, copies long, vector array<float>, away double"
        if dict(vectors.dtypes)["vector"] == "array<double>":
            schema = schema.replace("float", "double")
        assigned = stage(together.mapInArrow(_assigned, schema).withColumn("cell", F.xxhash64("parent", "seed")), "assigned")
        nodes = assigned.groupBy("parent", "seed", "cell").agg(F.max("away").alias("radius"))
        centres = seeds.select(F.col("cell").alias("parent"), "seed", _unit("vector").alias("centre"))
        levels.append(stage(nodes.join(centres, ["parent", "seed"]).select("parent", "cell", "centre", "radius"), "nodes"))
        points = assigned.select("cell", "cid", "copies", "vector")
    leaves = points
    for some in done:
        leaves = leaves.unionByName(some)
    return stage(leaves.select("cell", "cid", "copies", "vector"), "leaves"), levels


def _by_cell(order: Column):
    return Window.partitionBy("cell").orderBy(order, "cid")


def _leaf_pairs(levels: list[DataFrame], limit: float) -> DataFrame:
    """The leaf pairs ``a <= b`` the traversal reaches; a leaf of an upper level stays until the last."""
    nodes = levels[0]
    pairs = nodes.select(F.col("cell").alias("a"), F.col("cell").alias("b"))
    for below in levels[1:]:
        inner = below.select("parent").distinct()
        stay = nodes.join(inner, nodes["cell"] == inner["parent"], "left_anti").select(F.col("cell").alias("parent"), "cell", "centre", "radius")
        nodes = stage(below.select("parent", "cell", "centre", "radius").unionByName(stay), "level")
        left = nodes.select(F.col("parent").alias("a"), F.col("cell").alias("c"), F.col("centre").alias("x"), F.col("radius").alias("rx"))
        right = nodes.select(F.col("parent").alias("b"), F.col("cell").alias("d"), F.col("centre").alias("y"), F.col("radius").alias("ry"))
        met = pairs.join(left, "a").join(right, "b").where((F.col("a") != F.col("b")) | (F.col("c") <= F.col("d")))
        near = met.where((F.col("c") == F.col("d")) | (_centre_distance("x", "y") <= limit + F.col("rx") + F.col("ry") + SLACK))
        pairs = stage(near.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")), "pairs")
    return pairs


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    leaf: int = LEAF,
) -> DataFrame:
    """``key, n_links, component_id, kept``: vectors of one label whose cosine is at least ``cosine`` link.

    Equal vectors of a label are one class from the start, with a count. Vectors that are null, empty or zero, or
    that hold null or non-finite components, and vectors with a null label, link with nothing; so do vectors of
    different lengths. A null key has a null component and is not kept; rows that share a key are counted one by one.
    """
    known = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vector").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    known = known.withColumn("cid", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", "vector")))
    known = known.withColumn("cell", F.xxhash64("label", F.size("vector")))
    grouped = known.where("cid IS NOT NULL").groupBy("cell", "cid", "vector").agg(F.count("*").alias("copies"), F.min("key").alias("rep"))
    classes = stage(grouped, "classes")
    leaves, levels = cover_tree(classes, leaf)
    pairs = _leaf_pairs(levels, chord(cosine))
    one = leaves.join(pairs, leaves["cell"] == pairs["a"]).withColumn("side", F.lit(0))
    two = leaves.join(pairs.where("a <> b"), leaves["cell"] == F.col("b")).withColumn("side", F.lit(1))
    grouped = one.unionByName(two).select("a", "b", "side", "cid", "copies", "vector").groupBy("a", "b")
    found = stage(grouped.applyInArrow(_leaf_pair(cosine), "cid long, links long, root long"), "found")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    spread = classes.select("cid", "rep", "copies").join(stage(links, "counts"), "cid", "left").join(
        stage(roots.withColumnRenamed("id", "cid"), "roots"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    spread = stage(spread, "spread")
    lowest = spread.groupBy("root").agg(F.min("rep").alias("component"))
    digest = stage(spread.join(lowest, "root").select("cid", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n")), "digest")
    placed = known.select("key", "cid").join(digest, "cid", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return placed.select(
        F.col("key").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"), F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"))


def embedding_near_dedup(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors)
