"""Clusters by density with outliers, over the rows of a neighbour graph (after Campello, Moulavi & Sander 2013).

The distance of two neighbours is raised to what both need to reach their own neighbourhood (mutual reachability). A minimum
spanning forest of these edges is grown by Boruvka rounds: every tree takes its lightest edge outwards, trees are joined and
edges within a tree are dropped. The forest's edges, lightest first, are then replayed as merges: a tree that reaches the
least size is born as a cluster, smaller ones fall to the cluster that takes them in, and where two clusters meet, both end
and a larger one begins. A cluster stays if it lasts longer, over its members, than the best of what it is made of.

The replay works through the edges in ranges of bounded length, one after the other, each in one task that holds no more than
its range; what is left of a range are the trees that its edges joined. Rows of the graph, labels and trees are tables all along.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.config import NO_TOPIC
from ratelens.session import materialise

#: Edges that one task replays.
RANGE_EDGES = 1_000_000
#: Distances below this count as this, so that copies have a finite density.
LEAST_DISTANCE = 1e-6


def mutual_reachability(neighbours: DataFrame, min_samples: int) -> DataFrame:
    """Rows (id, neighbour, distance) to edges (a, b, w), a below b, each once.

    The core distance of a row is that to its neighbour number `min_samples`, or to its last one if it has fewer.
    """
    near = F.slice(F.array_sort(F.collect_list("distance")), F.lit(1), F.lit(min_samples))
    core = neighbours.groupBy("id").agg(F.array_max(near).alias("core"))
    a, b = core.select(F.col("id").alias("id"), F.col("core").alias("ca")), core.select(F.col("id").alias("neighbour"), F.col("core").alias("cb"))
    both = neighbours.filter("id <> neighbour").join(a, "id").join(b, "neighbour", "left")
    weight = F.greatest("distance", "ca", "cb", F.lit(LEAST_DISTANCE))
    return both.groupBy(F.least("id", "neighbour").alias("a"), F.greatest("id", "neighbour").alias("b")).agg(F.min(weight).alias("w"))


def _roots(steps: DataFrame) -> DataFrame:
    """Rows (c, to), one for every tree, each to the tree it joins, to rows (c, root): pointers are doubled until they rest.

    Trees choose the lightest edge under one order of all edges, so the only circles are pairs that choose each other; the
    smaller of a pair is the root.
    """
    back = steps.select(F.col("c").alias("to"), F.col("to").alias("again"))
    at = steps.join(back, "to", "left").select("c", F.when((F.col("again") == F.col("c")) & (F.col("c") < F.col("to")), F.col("c")).otherwise(F.col("to")).alias("root"))
    at = materialise(at, "roots")
    while True:
        on = at.select(F.col("c").alias("root"), F.col("root").alias("next"))
        moved = materialise(at.join(on, "root", "left").select("c", F.coalesce("next", "root").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
        at = moved.select("c", "root")
        if moved.filter("moved").isEmpty():
            return at


def spanning_forest(edges: DataFrame) -> DataFrame:
    """Minimum spanning forest (a, b, w) of edges (a, b, w), ties by a and b."""
    left = materialise(edges.select(F.col("a").alias("ca"), F.col("b").alias("cb"), F.struct("w", "a", "b").alias("e")), "forest-edges")
    forest: DataFrame | None = None
    while not left.isEmpty():
        ends = left.select(F.col("ca").alias("c"), F.col("cb").alias("to"), "e").unionByName(left.select(F.col("cb").alias("c"), F.col("ca").alias("to"), "e"))
        best = materialise(ends.groupBy("c").agg(F.min(F.struct("e", "to")).alias("m")).select("c", "m.to", "m.e"), "lightest-edges")
        taken = best.select("e.a", "e.b", "e.w").distinct()
        forest = taken if forest is None else forest.unionByName(taken)
        roots = _roots(best.select("c", "to"))
        moved = left.join(roots.select(F.col("c").alias("ca"), F.col("root").alias("ra")), "ca").join(roots.select(F.col("c").alias("cb"), F.col("root").alias("rb")), "cb")
        moved = moved.filter("ra <> rb").groupBy(F.least("ra", "rb").alias("ca"), F.greatest("ra", "rb").alias("cb")).agg(F.min("e").alias("e"))
        left = materialise(moved, "forest-edges")
    return edges.select("a", "b", "w").limit(0) if forest is None else materialise(forest, "forest")


_STATE = "tree long, size long, cluster long, mass double, best double"
_OUT = "kind string, x long, y long, size long, mass double, best double, density double, wins boolean"


class _Replay:
    """Trees of a range of edges. A cluster has an id, the sum of its members' densities and the best of what it was made of."""

    def __init__(self, first_id: int, min_size: int):
        self.next_id, self.min_size = first_id, min_size
        self.up: dict[int, int] = {}
        self.size: dict[int, int] = {}
        self.cluster: dict[int, int | None] = {}
        self.mass: dict[int, float] = {}
        self.best: dict[int, float] = {}
        self.parts: dict[int, list[int]] = {}  # the trees, as they were before, of one that is no cluster yet
        self.rows: list[tuple] = []

    def find(self, t: int) -> int:
        while self.up[t] != t:
            self.up[t] = self.up[self.up[t]]
            t = self.up[t]
        return t

    def add(self, tree: int, size: int, cluster: int | None, mass: float, best: float) -> None:
        if tree not in self.up:
            self.up[tree], self.size[tree], self.cluster[tree], self.mass[tree], self.best[tree] = tree, size, cluster, mass, best
            self.parts[tree] = [tree] if cluster is None else []

    def born(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def fall(self, tree: int, cluster: int, density: float) -> None:
        for t in self.parts[tree]:
            self.rows.append(("fall", t, cluster, 0, 0.0, 0.0, density, False))
        self.parts[tree] = []

    def end(self, tree: int, parent: int | None, density: float) -> float:
        stable = self.mass[tree] - self.size[tree] * density
        self.rows.append(("cluster", self.cluster[tree], parent, self.size[tree], stable, self.best[tree], density, stable >= self.best[tree]))
        return max(stable, self.best[tree])

    def join(self, a: int, b: int, w: float) -> None:
        a, b = self.find(a), self.find(b)
        if a == b:
            return
        if self.size[a] < self.size[b]:
            a, b = b, a
        density, size = 1.0 / w, self.size[a] + self.size[b]
        big = [t for t in (a, b) if self.cluster[t] is not None]
        if len(big) == 2:
            parent = self.born()
            best = self.end(a, parent, density) + self.end(b, parent, density)
            self.cluster[a], self.mass[a], self.best[a] = parent, size * density, best
        elif big:
            keep = big[0]
            small = b if keep == a else a
            self.fall(small, self.cluster[keep], density)
            self.cluster[a], self.best[a], mass = self.cluster[keep], self.best[keep], self.mass[keep]
            self.mass[a], self.parts[a] = mass + self.size[small] * density, []
        elif size >= self.min_size:
            self.cluster[a] = self.born()
            self.fall(a, self.cluster[a], density)
            self.fall(b, self.cluster[a], density)
            self.mass[a], self.best[a] = size * density, 0.0
        else:
            self.parts[a] += self.parts[b]
        self.up[b], self.size[a] = a, size

    def result(self) -> list[tuple]:
        out = self.rows
        for t in self.up:
            root = self.find(t)
            out.append(("tree", t, root, 0, 0.0, 0.0, 0.0, False))
            if root == t:
                out.append(("state", t, self.cluster[t], self.size[t], self.mass[t], self.best[t], 0.0, False))
        return out


def _replayed(edges: DataFrame, first_id: int, min_size: int) -> DataFrame:
    """One range of edges (w, a, b and the state of the trees at both ends) as merges, in one task."""
    names = [x.split()[0] for x in _OUT.split(", ")]

    def run(batches):
        done = _Replay(first_id, min_size)
        for batch in batches:
            for r in batch.to_pylist():
                for e in "ab":
                    done.add(r[f"{e}tree"], r[f"{e}size"], r[f"{e}cluster"], r[f"{e}mass"], r[f"{e}best"])
                done.join(r["atree"], r["btree"], r["w"])
        rows = done.result()
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
        for low in range(0, len(rows), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[low : low + 65536]), kinds)], names)

    return edges.repartition(1).sortWithinPartitions("w", "a", "b").mapInArrow(run, _OUT)  # a range of bounded length


def _ranges(forest: DataFrame, length: int) -> tuple[DataFrame, list[int]]:
    """The forest's edges with `range`, ascending in weight, and the ranges there are. Ties are cut by the edges' ids."""
    n = forest.count()
    parts = max(1, math.ceil(2 * n / length)) if n > length else 1
    cut = materialise(forest.repartitionByRange(parts, "w", "a", "b").withColumn("range", F.spark_partition_id()), "forest-ranges")
    return cut, sorted(r[0] for r in cut.select("range").distinct().collect())  # one number a range


def _highest(clusters: DataFrame) -> DataFrame:
    """Rows (cluster, parent, wins) to rows (cluster, top): the highest cluster that wins among it and those above it."""
    at = clusters.select("cluster", F.col("parent").alias("up"), F.when(F.col("wins"), F.col("cluster")).alias("top"))
    while True:
        at = materialise(at, "highest-clusters")
        if at.filter("up is not null").isEmpty():
            return at.select("cluster", "top")
        above = at.select(F.col("cluster").alias("up"), F.col("up").alias("up2"), F.col("top").alias("top2"))
        at = at.join(above, "up", "left").select("cluster", F.col("up2").alias("up"), F.coalesce("top2", "top").alias("top"))


def density_clusters(neighbours: DataFrame, min_size: int = 15, min_samples: int | None = None, single: bool = False, range_edges: int = RANGE_EDGES) -> DataFrame:
    """Rows (id, neighbour, distance) to rows (id, cluster, density), one for every id in either column.

    cluster is the smallest id of its members, or NO_TOPIC for outliers; density is 1 / distance at which the row joined a
    cluster (null if it never did). `single` lets all rows be one cluster, when there is nothing to tell it from.
    """
    plain = materialise(neighbours.select(F.col("id").cast("long").alias("id"), F.col("neighbour").cast("long").alias("neighbour"), F.col("distance").cast("double").alias("distance")), "neighbours")
    ids = plain.select("id").union(plain.select(F.col("neighbour").alias("id"))).distinct()
    forest, numbers = _ranges(spanning_forest(mutual_reachability(plain, min_samples or min_size)), range_edges)
    spark = neighbours.sparkSession
    labels = ids.select("id", F.col("id").alias("tree"), F.lit(None).cast("long").alias("cluster"), F.lit(None).cast("double").alias("density"))
    state, clusters = spark.createDataFrame([], _STATE), spark.createDataFrame([], "cluster long, parent long, wins boolean")
    for k, number in enumerate(numbers):
        edges = forest.filter(F.col("range") == number).select("w", "a", "b")
        for e in "ab":
            end = labels.select(F.col("id").alias(e), F.col("tree").alias(f"{e}tree"))
            held = state.select(F.col("tree").alias(f"{e}tree"), *[F.col(c).alias(f"{e}{c}") for c in ("size", "cluster", "mass", "best")])
            edges = edges.join(end, e).join(held, f"{e}tree", "left").withColumn(f"{e}size", F.coalesce(f"{e}size", F.lit(1)))
            edges = edges.withColumns({f"{e}{c}": F.coalesce(f"{e}{c}", F.lit(0.0)) for c in ("mass", "best")})
        done = materialise(_replayed(edges, k << 40, min_size), "replayed")
        trees, falls = done.filter("kind = 'tree'").select(F.col("x").alias("tree"), F.col("y").alias("root")), done.filter("kind = 'fall'")
        falls = falls.select(F.col("x").alias("tree"), F.col("y").alias("into"), F.col("density").alias("at"))
        moved = labels.join(trees, "tree", "left").join(falls, "tree", "left")
        labels = materialise(moved.select("id", F.coalesce("root", "tree").alias("tree"), F.coalesce("cluster", "into").alias("cluster"), F.coalesce("density", "at").alias("density")), "cluster-labels")
        new = done.filter("kind = 'state'").select(F.col("x").alias("tree"), "size", F.col("y").alias("cluster"), "mass", "best")
        state = materialise(state.join(trees, "tree", "left_anti").unionByName(new), "tree-state")
        clusters = clusters.unionByName(done.filter("kind = 'cluster'").select(F.col("x").alias("cluster"), F.col("y").alias("parent"), "wins"))
    # Clusters that nothing joined to another end where there is no density left.
    last = state.filter("cluster is not null")
    alone = last.limit(2).count() < 2
    wins = F.lit(single) & (F.col("mass") >= F.col("best")) if alone else F.col("mass") >= F.col("best")
    clusters = clusters.unionByName(last.select("cluster", F.lit(None).cast("long").alias("parent"), wins.alias("wins")))
    found = labels.join(_highest(clusters), "cluster", "left")
    names = found.filter("top is not null").groupBy("top").agg(F.min("id").alias("name"))
    return found.join(names, "top", "left").select("id", F.coalesce("name", F.lit(NO_TOPIC).cast("long")).alias("cluster"), "density")
