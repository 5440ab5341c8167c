"""k nearest neighbours by cosine: exact as a partitioned block join, and approximate by neighbour descent.

Exact: vectors are grouped around pivots; the k-th distance found inside a vector's own block bounds its
search, and the triangle inequality rules out whole blocks (after Lu et al. 2012). Blocks are bounded in
size and hot cells are split. A block is one row of a stored table; tasks read the blocks that they compare, so vectors cross
one exchange, and of a comparison only the k best per query are rows. Its work grows faster than the table.

Descent (after Dong, Moses & Li 2011): a first graph comes from leaves of random trees; leaves grow with the root of the rows. Then, round by round,
the neighbours of a vector and the vectors it is a neighbour of are compared with each other, if one of the two is new
on the list, and whoever finds a better neighbour keeps it. A vector's lists have a fixed width, so the work of a round does
not depend on the number of rows. Which share of the true neighbours is found depends on the data, so it is measured on some
rows against their exact products: trees are added until the share is reached, since a tree moves a vector once and a round
moves it to all its lists. Rounds follow if the trees were not enough, and more trees after them, until it is reached.
"""

from __future__ import annotations

import math

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.operators.sampling import hash_sample
from ratelens.session import materialise

MAX_PIVOTS = 256


def has_direction(v: Column) -> Column:
    """Whether a vector has a cosine: it is there, all its components are finite numbers, and one is not zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit_rows(vectors) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype="float64") for v in vectors])
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


#: Vectors of a block at most, if `block_rows` is not larger; queries of a block that are compared with another one at a time.
BLOCK_ROWS, QUERY_ROWS = 4096, 512
#: Pairs whose products are taken in double precision at a time.
PAIRS = 65_536


def _own_limits(ids: np.ndarray, u: np.ndarray, k: int) -> np.ndarray:
    """The similarity of every vector's k-th best neighbour within its block; none (-2) if there are fewer."""
    limit = np.full(len(ids), -2.0)
    for low in range(0, len(ids), QUERY_ROWS):
        sim = u[low : low + QUERY_ROWS] @ u.T
        sim[ids[low : low + QUERY_ROWS, None] == ids] = -2.0
        if len(ids) > k:
            limit[low : low + QUERY_ROWS] = np.partition(sim, -k, axis=1)[:, -k]
    return limit


def _reached(ids: np.ndarray, u: np.ndarray, c_ids: np.ndarray, c_u: np.ndarray, k: int) -> np.ndarray:
    """What the k-th best similarity of every query with the rows of a block reaches at least; -2 without k rows of other ids."""
    limit, off = np.full(len(ids), -2.0), (u.shape[1] + 8) * 2.0**-24
    order = np.argsort(c_ids, kind="stable")
    first, last = (np.searchsorted(c_ids, ids, side, sorter=order) for side in ("left", "right"))
    columns = np.ascontiguousarray(c_u.astype(np.float32).T)
    for low in range(0, len(ids), QUERY_ROWS):
        sim = u[low : low + QUERY_ROWS].astype(np.float32) @ columns
        for i in np.flatnonzero(first[low : low + QUERY_ROWS] < last[low : low + QUERY_ROWS]):
            sim[i, order[first[low + i] : last[low + i]]] = -np.inf
        limit[low : low + QUERY_ROWS] = np.maximum(_bound(_maxima(sim, k), k) - off, -2.0)
    return limit


class _Best:
    """The k best neighbours of the queries of a block, kept while the block meets others.

    Products in single precision, less the most that they can be off, tell who may be near; these get products in double precision.
    """

    def __init__(self, ids: np.ndarray, u: np.ndarray, limit: np.ndarray, k: int):
        self.ids, self.u, self.limit, self.k = ids, u, limit.copy(), k
        self.short, self.off = u.astype(np.float32), (u.shape[1] + 8) * 2.0**-24
        self.row, self.near, self.sim = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.waiting: list[tuple] = []

    def meet(self, ids: np.ndarray, u: np.ndarray) -> None:
        short = np.ascontiguousarray(u.astype(np.float32).T)
        for low in range(0, len(self.ids), QUERY_ROWS):
            may = self.short[low : low + QUERY_ROWS] @ short >= (self.limit[low : low + QUERY_ROWS, None] - self.off).astype(np.float32)
            i, j = np.divmod(np.flatnonzero(may), len(ids))
            i += low
            other = self.ids[i] != ids[j]
            i, j = i[other], j[other]
            sim = np.zeros(len(i))
            for at in range(0, len(i), PAIRS):
                sim[at : at + PAIRS] = np.einsum("ij,ij->i", self.u[i[at : at + PAIRS]], u[j[at : at + PAIRS]])
            keep = sim >= self.limit[i] - 1e-12
            self.waiting.append((i[keep], ids[j[keep]], sim[keep]))
            if sum(len(w[0]) for w in self.waiting) > self.k * len(self.ids):
                self.settle()

    def settle(self) -> None:
        row, near, sim = (np.concatenate(x) for x in zip((self.row, self.near, self.sim), *self.waiting))
        order = np.lexsort((near, -sim, row))
        row, near, sim = row[order], near[order], sim[order]
        place = np.arange(len(row)) - np.searchsorted(row, row, "left")
        keep, last = place < self.k, place == self.k - 1
        self.limit[row[last]] = np.maximum(self.limit[row[last]], sim[last])
        self.row, self.near, self.sim, self.waiting = row[keep], near[keep], sim[keep], []

    def result(self) -> pa.RecordBatch:
        self.settle()
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.row]), pa.array(self.near), pa.array(self.sim)], ["id", "neighbour", "similarity"])


def knn_cosine(df: DataFrame, key: str, vec: str, k: int = 15, block_rows: int = 4096, pivots: int | None = None) -> DataFrame:
    """The k most similar other vectors of every vector, ranked; ties by neighbour id.

    Vectors without a direction (null, all zero, or with a component that is null or not finite) take no part. `block_rows` vectors
    have a pivot, up to MAX_PIVOTS pivots; with more vectors blocks grow to BLOCK_ROWS.
    """
    base = df.select(F.col(key).cast("long").alias("id"), F.col(vec).alias("v")).filter(has_direction(F.col("v")))
    n = base.count()
    n_pivots = max(1, min(MAX_PIVOTS, pivots or math.ceil(n / block_rows)))
    centre = _unit_rows([r["v"] for r in hash_sample(base, "id", n_pivots).collect()])  # at most MAX_PIVOTS vectors
    most = max(block_rows, min(BLOCK_ROWS, math.ceil(n / MAX_PIVOTS)))

    def place(batches):
        for pdf in batches:
            u = _unit_rows(pdf["v"])
            yield pd.DataFrame({"id": pdf["id"], "u": list(u), "cell": (u @ centre.T).argmax(axis=1)})

    placed = materialise(base.mapInPandas(place, "id long, u array<double>, cell int"), "placed-vectors")
    chunks = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).cast("int").alias("chunks"))
    dealt = placed.join(F.broadcast(chunks), "cell").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))  # at most MAX_PIVOTS rows

    def pack(rows: pa.Table) -> pa.Table:
        ids, u, cell = rows.column("id").to_numpy(), _rows_of(rows, "u"), rows.column("cell")[0].as_py()
        limit = _own_limits(ids, u, k)
        away = np.sqrt(np.maximum(2.0 - 2.0 * (u @ centre.T), 0.0))
        reach = (away - np.sqrt(np.maximum(2.0 - 2.0 * limit, 0.0))[:, None]).min(axis=0)
        return pa.table({
            "cell": pa.array([cell], pa.int32()), "chunk": rows.column("chunk")[:1].combine_chunks(), "radius": [float(away[:, cell].max())], "reach": [reach.tolist()],
            "ids": [ids.tobytes()], "u": [u.tobytes()], "limits": [limit.tobytes()],
        })

    blocks = dealt.select("id", "u", "cell", "chunk").groupBy("cell", "chunk").applyInArrow(
        pack, "cell int, chunk int, radius double, reach array<double>, ids binary, u binary, limits binary")
    blocks = materialise(blocks, "vector-blocks")
    asked = blocks.select(F.struct("cell", "chunk").alias("block"), "reach", "ids", "u", "limits")
    others = blocks.select(F.col("cell").alias("c_cell"), "radius", F.col("ids").alias("c_ids"), F.col("u").alias("c_u"))
    # Blocks are read by the tasks that compare them and are not shuffled.
    met = asked.join(others.hint("shuffle_replicate_nl"), F.element_at("reach", F.col("c_cell") + 1) <= F.col("radius") + 1e-6)

    def compare(batches):
        best, block = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["block"] != block:
                    if best is not None:
                        yield best.result()
                    block, ids = r["block"], np.frombuffer(r["ids"], np.int64)
                    best = _Best(ids, np.frombuffer(r["u"]).reshape(len(ids), -1), np.frombuffer(r["limits"]), k)
                ids = np.frombuffer(r["c_ids"], np.int64)
                best.meet(ids, np.frombuffer(r["c_u"]).reshape(len(ids), -1))
        if best is not None:
            yield best.result()

    found = met.select("block", "ids", "u", "limits", "c_ids", "c_u").mapInArrow(compare, "id long, neighbour long, similarity double")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


#: Vectors of a leaf of the trees, up to LEAVES of them; trees that are grown first and at most before the lists descend, rounds at most, and the
#: share of new entries below which the lists have settled.
LEAF, LEAVES, TREES, MOST_TREES, ROUNDS, SETTLED = 4096, 25, 4, 48, 12, 0.001
#: Share of the nearest neighbours that is to be found, measured on so many rows; rows from which the splits of trees are taken, at most.
TARGET, ASKED, SPLIT_SAMPLE = 0.93, 256, 65_536
#: Better neighbours that one list proposes to each of its members in a round, the best ones. A vector is in many lists.
OFFERS = 8
#: Columns of a group whose best entry stands for it at first; bytes of vectors that a task packs at a time.
COLUMNS, PACKED = 32, 16 << 20


def _rows_of(batch, name: str) -> np.ndarray:
    col = batch.column(name)
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.asarray(col.flatten()).reshape(len(col), -1)


def _tasks(df: DataFrame) -> int:
    """Tasks for work that is long by the row: some for every core, so that none waits for the last."""
    return 4 * df.sparkSession.sparkContext.defaultParallelism


def _held(batches: Iterator[pa.RecordBatch], key: str, vec: str, dims: int, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of batches, up to PACKED bytes at a time."""
    most, ids, u = max(1, PACKED // (max(1, dims) * np.dtype(kind).itemsize)), [], []
    for b in batches:
        if b.num_rows:
            ids.append(b.column(key).to_numpy())
            u.append(_rows_of(b, vec).astype(kind, copy=False))
        if sum(map(len, ids)) >= most:
            yield np.concatenate(ids), np.concatenate(u)
            ids, u = [], []
    if ids:
        yield np.concatenate(ids), np.concatenate(u)


def _maxima(sim: np.ndarray, k: int) -> np.ndarray:
    """The maxima of groups of COLUMNS columns, which lie apart; the entries themselves if there are fewer than k groups."""
    parts = sim.shape[1] // COLUMNS
    return sim if parts < k else sim[:, : parts * COLUMNS].reshape(len(sim), COLUMNS, parts).max(axis=1)


def _bound(most: np.ndarray, k: int) -> np.ndarray:
    """What the k-th best entry of every row reaches, by its maxima; -inf without k of them."""
    return np.partition(most, -k, axis=1)[:, -k] if most.shape[1] >= k else np.full(len(most), -np.inf, most.dtype)


def _may_be_best(sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns, in order of rows, of the k best entries of every row and few more. Entries of -inf are none.

    Only groups of columns whose maximum reaches the bound are looked at.
    """
    most = _maxima(sim, k)
    least = _bound(most, k)[:, None]
    if most is sim:
        return np.nonzero((sim >= least) & (sim > -np.inf))
    parts = most.shape[1]
    r, p = np.nonzero((most >= least) & (most > -np.inf))
    found = sim[:, : parts * COLUMNS].reshape(len(sim), COLUMNS, parts)[r, :, p]
    i, c = np.nonzero((found >= least[r]) & (found > -np.inf))
    rest = sim[:, parts * COLUMNS :]
    row, col = np.nonzero((rest >= least) & (rest > -np.inf))
    row, col = np.append(r[i], row), np.append(c * parts + p[i], col + parts * COLUMNS)
    order = np.argsort(row, kind="stable")
    return row[order], col[order]


def _dense(at: np.ndarray, rows: int, near: np.ndarray, sims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries in order of their rows as matrices; what a row lacks to the longest one has similarity -inf."""
    starts = np.searchsorted(at, np.arange(rows + 1))
    shape, place = (rows, int(np.diff(starts).max(initial=0))), np.arange(len(at)) - starts[at]
    wide_near, wide_sims = np.full(shape, -1, np.int64), np.full(shape, -np.inf, np.float32)
    wide_near[at, place], wide_sims[at, place] = near, sims
    return wide_near, wide_sims


def _lists(ids: np.ndarray, near: np.ndarray, sims: np.ndarray) -> pa.RecordBatch:
    """Matrices as lists; entries of similarity -inf are none."""
    there = np.isfinite(sims)
    ends = pa.array(np.append(0, np.cumsum(there.sum(axis=1))), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.ListArray.from_arrays(ends, pa.array(near[there])), pa.ListArray.from_arrays(ends, pa.array(sims[there]))], ["id", "near", "sims"])


def _leaf_neighbours(ids: np.ndarray, u: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """The best neighbours of every vector of a leaf within it, as lists."""
    columns, odd = np.ascontiguousarray(u.T), ~np.isfinite(u).all(axis=1)
    for low in range(0, len(ids), QUERY_ROWS):
        sim = u[low : low + QUERY_ROWS] @ columns
        at = np.arange(low, low + len(sim))
        sim[at - low, at] = -np.inf
        if odd.any():
            sim[:, odd] = -np.inf
        row, col = _may_be_best(sim, width)
        near, best = _dense(row, len(sim), ids[col], sim[row, col])
        if near.shape[1] > width:
            order = np.argpartition(-best, width - 1, axis=1)[:, :width]
            near, best = np.take_along_axis(near, order, axis=1), np.take_along_axis(best, order, axis=1)
        yield _lists(ids[at], near, best)


def _splits(sample: np.ndarray, leaves: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Planes and cuts of a tree, from the root in order of levels: between two rows of a node, at the node's median."""
    depth = max(0, math.ceil(math.log2(max(1, leaves))))
    planes, cuts = np.zeros(((1 << depth) - 1, sample.shape[1]), np.float32), np.zeros((1 << depth) - 1, np.float32)
    nodes = [np.arange(len(sample))]
    for k in range(len(planes)):
        rows = nodes[k]
        plane = np.subtract(*sample[rng.choice(rows, 2, replace=False)]) if len(rows) > 1 else np.zeros(sample.shape[1], np.float32)
        if not plane.any():  # copies are parted at random from the others
            plane = rng.standard_normal(sample.shape[1]).astype(np.float32)
        along = sample[rows] @ plane
        planes[k], cuts[k] = plane, np.median(along) if len(rows) else 0.0
        right = along > cuts[k]
        nodes += [rows[~right], rows[right]]
    return planes, cuts


def _leaves(u: np.ndarray, planes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The leaf of every row, counted from 0."""
    node = np.zeros(len(u), np.int64)
    while len(planes) and node.size and node[0] < len(planes):
        node = 2 * node + 1 + (np.einsum("ij,ij->i", u, planes[node]) > cuts[node])
    return node - len(planes)


def _tree_lists(base: DataFrame, n: int, sample: np.ndarray, width: int, trees: range, leaf: int, seed: int) -> DataFrame:
    """Lists (id, near, sims) of neighbours within the leaves of random trees.

    A leaf that is crowded, as its share of the sample tells, is dealt over several by a hash of the id. The vectors of a leaf cross the
    exchange packed, so that of a tree only rows of leaves and lists are handled one by one.
    """
    dims = sample.shape[1]
    grown = []
    for t in trees:
        planes, cuts = _splits(sample, min(math.ceil(n / leaf), SPLIT_SAMPLE // 16), np.random.default_rng([seed, t]))
        held = np.bincount(_leaves(sample, planes, cuts), minlength=len(planes) + 1) * (n / max(1, len(sample)))
        grown.append((t, planes, cuts, np.maximum(1, np.ceil(held / (2 * leaf))).astype(np.int64)))

    def packed(ids: np.ndarray, u: np.ndarray) -> Iterator[pa.RecordBatch]:
        for t, planes, cuts, parts in grown:
            code = _leaves(u, planes, cuts)
            mixed = (ids.astype(np.uint64) + np.uint64(t)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            part = ((mixed >> np.uint64(33)).astype(np.int64)) % parts[code]
            order = np.lexsort((part, code))
            code, part = code[order], part[order]
            starts = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (part[1:] != part[:-1])))
            ends = np.append(starts[1:], len(code))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(starts), t), pa.int32()), pa.array(code[starts]), pa.array(part[starts]),
                pa.array([ids[order[a:b]].tobytes() for a, b in zip(starts, ends)], pa.binary()), pa.array([u[order[a:b]].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            ], ["tree", "code", "part", "ids", "u"])

    def place(batches):
        for ids, u in _held(batches, "id", "u", dims, np.float32):
            yield from packed(ids, u)

    def compare(rows: pa.Table) -> pa.Table:
        ids, u = (b"".join(rows.column(c).to_pylist()) for c in ("ids", "u"))
        return pa.Table.from_batches(_leaf_neighbours(np.frombuffer(ids, np.int64), np.frombuffer(u, np.float32).reshape(-1, dims), width))

    placed = base.mapInArrow(place, "tree int, code long, part long, ids binary, u binary").repartition(_tasks(base), "tree", "code", "part")
    return placed.groupBy("tree", "code", "part").applyInArrow(compare, "id long, near array<long>, sims array<float>")


def _merged_lists(lists: DataFrame, width: int) -> DataFrame:
    """One list of the best neighbours for every id."""

    def run(batches):
        for batch in _whole_groups(batches, "id"):
            ids, at = np.unique(batch.column("id").to_numpy(), return_inverse=True)
            at = np.repeat(at, np.diff(batch.column("near").offsets.to_numpy()))
            near, sims = _dense(at, len(ids), batch.column("near").flatten().to_numpy(), batch.column("sims").flatten().to_numpy())
            order = np.argsort(-sims, axis=1, kind="stable")
            near, sims = np.take_along_axis(near, order, axis=1), np.take_along_axis(sims, order, axis=1)
            order = np.argsort(near, axis=1, kind="stable")  # copies of an entry, the best one first
            near, sims = np.take_along_axis(near, order, axis=1), np.take_along_axis(sims, order, axis=1)
            sims[:, 1:][near[:, 1:] == near[:, :-1]] = -np.inf
            order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
            yield _lists(ids, np.take_along_axis(near, order, axis=1), np.take_along_axis(sims, order, axis=1))

    return lists.select("id", "near", "sims").repartition("id").sortWithinPartitions("id").mapInArrow(run, "id long, near array<long>, sims array<float>")


def _edges_of(lists: DataFrame) -> DataFrame:
    """Lists as rows (id, neighbour, similarity, rank)."""
    return lists.select("id", F.posexplode(F.arrays_zip("near", "sims")).alias("p", "e")).select(
        "id", F.col("e.near").alias("neighbour"), F.col("e.sims").alias("similarity"), (F.col("p") + 1).alias("rank"))


class _Probe:
    """Some rows with the similarity of their k-th nearest among all, to measure lists with."""

    def __init__(self, base: DataFrame, k: int, asked: int):
        rows = hash_sample(base, "id", asked).select("id", "u").collect()  # at most `asked` vectors
        ids, u, self.k = np.array([r["id"] for r in rows]), np.array([r["u"] for r in rows], np.float32), k
        self.off = max(1e-6, u.shape[1] * 2.0**-24)  # what products in single precision can be off

        def meet(batches):
            best = np.full((len(ids), k), -np.inf, np.float32)
            for b in batches:
                if b.num_rows:
                    sim = u @ _rows_of(b, "u").T
                    sim[ids[:, None] == b.column("id").to_numpy()] = -np.inf
                    best = -np.partition(-np.concatenate([best, sim], axis=1), k - 1, axis=1)[:, :k]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, k)), pa.array(best.ravel())], ["id", "s"])

        found = base.mapInArrow(meet, "id long, s float").filter(F.col("s") >= -1.5).groupBy("id").agg(F.slice(F.sort_array(F.collect_list("s"), False), 1, k).alias("s"))
        self.truth = {r["id"]: (len(r["s"]), r["s"][-1]) for r in found.collect()}  # one row for each that is asked
        self.ids = base.sparkSession.createDataFrame([(i,) for i in self.truth], "id long")

    def share(self, edges: DataFrame) -> float:
        hits: dict = {}
        for r in edges.join(F.broadcast(self.ids), "id").filter(F.col("rank") <= self.k).select("id", "similarity").collect():
            hits[r["id"]] = hits.get(r["id"], 0) + (r["similarity"] >= self.truth[r["id"]][1] - self.off)
        return sum(min(n, hits.get(i, 0)) for i, (n, _) in self.truth.items()) / max(1, sum(n for n, _ in self.truth.values()))


def _nearest_of(edges: DataFrame, width: int) -> DataFrame:
    """The best entries of every list; an entry that was there before is not new."""
    one = edges.repartition("id").groupBy("id", "neighbour").agg(F.max("similarity").alias("similarity"), F.max("old").alias("old"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour"))
    return one.withColumn("rank", rank).filter(F.col("rank") <= width)


def _whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows, cut so that the rows of a key are never in two of them."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if held is not None and held.num_rows:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0] if batch.num_rows else held
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1], "left"))
        if last:
            yield batch.slice(0, last)
        held = batch.slice(last)
    if held is not None and held.num_rows:
        yield held


def _local_joins(members: DataFrame, dims: int) -> DataFrame:
    """Better neighbours (id, neighbour, similarity) found by comparing the members of every list with each other.

    members: rows (list, id, old, worst, u); worst is the similarity that a new neighbour of id has to pass.
    """

    def run(batches):
        for batch in _whole_groups(batches, "list"):
            at = batch.column("list").to_numpy()
            starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            sizes = np.diff(np.append(starts, len(at)))
            ids, old, worst, u = (batch.column("id").to_numpy(), batch.column("old").to_numpy(), batch.column("worst").to_numpy(), _rows_of(batch, "u"))
            for size in np.unique(sizes):  # lists of one size are one stack of matrix products
                where = starts[sizes == size]
                for low in range(0, len(where), max(1, 1_000_000 // int(size * size))):
                    rows = where[low : low + max(1, 1_000_000 // int(size * size))][:, None] + np.arange(size)
                    x = u[rows]
                    sim = x @ x.transpose(0, 2, 1)
                    fresh = (old[rows][:, :, None] == 0) | (old[rows][:, None, :] == 0)
                    better = fresh & (sim > worst[rows][:, :, None]) & (ids[rows][:, :, None] != ids[rows][:, None, :])
                    sim[~better] = -np.inf
                    take = min(OFFERS, size)
                    best = np.argpartition(-sim, take - 1, axis=2)[:, :, :take]
                    offered = np.take_along_axis(sim, best, axis=2)
                    g, i, j = np.nonzero(np.isfinite(offered))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[rows][g, i]), pa.array(ids[rows][g, best[g, i, j]]), pa.array(offered[g, i, j].astype(np.float32)),
                    ], ["id", "neighbour", "similarity"])

    ordered = members.select("list", "id", "old", "worst", "u").repartition("list").sortWithinPartitions("list")
    return ordered.mapInArrow(run, "id long, neighbour long, similarity float")


def _members(graph: DataFrame, width: int) -> DataFrame:
    """Rows (list, id, old) of every vector's list: itself, its neighbours, and the nearest of those whose neighbour it is."""
    back = graph.select(F.col("neighbour").alias("list"), "id", "similarity", "old")
    rank = F.row_number().over(Window.partitionBy("list").orderBy(F.desc("similarity"), "id"))
    back = back.withColumn("_r", rank).filter(F.col("_r") <= width)
    both = graph.select(F.col("id").alias("list"), F.col("neighbour").alias("id"), "old").unionByName(back.select("list", "id", "old"))
    own = graph.select(F.col("id").alias("list"), "id", F.lit(1).alias("old")).distinct()
    return both.unionByName(own).groupBy("list", "id").agg(F.min("old").alias("old"))


def knn_descent(
    df: DataFrame, key: str, vec: str, k: int = 15, width: int | None = None, trees: int = TREES, leaf: int | None = None, rounds: int = ROUNDS,
    settled: float = SETTLED, seed: int = 0, target: float = TARGET, most_trees: int = MOST_TREES,
) -> DataFrame:
    """k similar other vectors of every vector: id, neighbour, similarity (single precision), rank; ties by neighbour id.

    `width` is the length of the lists that descend (three times k by default): longer ones find more. `target` is the share of the
    nearest neighbours to be found, as measured on some rows. `leaf` is LEAF by default, and from LEAVES of them on
    grows with the root of the rows: every level of a tree parts neighbours, so deep trees find few of them. Vectors without a direction take
    no part; rows that repeat an id count once.
    """
    width = max(k, width or 3 * k)
    plain = df.select(F.col(key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & has_direction(F.col("v")))
    first = plain.select(F.size("v")).first()
    if first is None:
        return df.sparkSession.createDataFrame([], "id long, neighbour long, similarity float, rank int")
    dims = first[0]

    def scale(batches):
        for b in batches:
            u = _rows_of(b, "v") if b.num_rows else np.zeros((0, dims))
            u = (u / np.sqrt((u * u).sum(axis=1, keepdims=True))).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.FixedSizeListArray.from_arrays(pa.array(u.ravel()), dims).cast(pa.list_(pa.float32()))], ["id", "u"])

    one = plain.filter(F.size("v") == dims).repartition(_tasks(df), "id").groupBy("id").agg(F.min("v").alias("v"))
    base = materialise(one.mapInArrow(scale, "id long, u array<float>"), "unit-vectors")
    n = base.count()
    leaf = leaf or max(LEAF, math.ceil(math.sqrt(LEAF * n / LEAVES)))
    probe = _Probe(base, k, ASKED)
    sample = np.array([r["u"] for r in hash_sample(base, "id", min(SPLIT_SAMPLE, 64 * math.ceil(n / leaf))).collect()], np.float32).reshape(-1, dims)

    def planted(lists: DataFrame | None, low: int) -> tuple[DataFrame, bool]:
        """Lists after further trees, at most `most_trees`, and whether the target is met. A single leaf holds all neighbours there are."""
        met, end, more = False, low + max(1, most_trees) if n > leaf else low + 1, trees
        missed = 1.0 if lists is None else max(1e-9, 1 - probe.share(_edges_of(lists)))
        while low < end and not met:
            high = min(end, low + more)
            grown = _tree_lists(base, n, sample, k, range(low, high), leaf, seed)
            lists = materialise(_merged_lists(grown if lists is None else grown.unionByName(lists), k), "tree-lists")
            share = 1.0 if n <= leaf else probe.share(_edges_of(lists))
            pace, missed, low, met = math.log(max(1e-9, 1 - share) / missed) / (high - low), max(1e-9, 1 - share), high, n <= leaf or share >= target
            # Each tree finds a share of what is missing, so that tells how many are needed yet.
            more = min(4 * trees, max(1, math.ceil(math.log((1 - target) / missed) / pace))) if pace < 0 and target < 1 else trees
        return lists, met

    lists, met = planted(None, 0)
    if met:
        return _edges_of(lists)
    graph = _edges_of(lists).withColumn("old", F.lit(0))
    for _ in range(rounds):
        worst = graph.groupBy("id").agg(F.when(F.count(F.lit(1)) >= width, F.min("similarity")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
        members = _members(graph, width).join(worst, "id", "left").join(base, "id").withColumn("worst", F.coalesce("worst", F.lit(-2.0).cast("float")))
        found = _local_joins(members, dims).withColumn("old", F.lit(0))
        kept = graph.select("id", "neighbour", "similarity", F.lit(1).alias("old"))
        graph = materialise(_nearest_of(kept.unionByName(found), width), "descent-graph")
        new = graph.agg(F.sum(1 - F.col("old"))).first()[0] or 0
        if new <= settled * n * width or probe.share(graph) >= target:
            break
    done, met = most_trees, probe.share(graph) >= target
    while not met:  # what settled too early gets more trees; each finds a share of what is missing
        ordered = F.array_sort(F.collect_list(F.struct("rank", "neighbour", "similarity")))
        lists = graph.groupBy("id").agg(ordered.alias("e")).select("id", F.col("e.neighbour").alias("near"), F.col("e.similarity").alias("sims"))
        lists, met = planted(lists, done)
        graph, done = _edges_of(lists), done + most_trees
    return graph.filter(F.col("rank") <= k).select("id", "neighbour", "similarity", "rank")


def recall(found: DataFrame, df: DataFrame, key: str, vec: str, asked: Column, k: int = 15) -> DataFrame:
    """One row (queries, recall): the share of the k nearest vectors of the rows marked by `asked` that `found` has for them.

    The truth comes from products with all rows, for a stated set of queries, so its work grows with their product; a neighbour as near as
    the k-th counts. Blocks of queries and of all rows are stored tables that the tasks which compare them read, and a task keeps the k
    best of a block's queries while it meets blocks.
    """
    usable = df.select(F.col(key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v"), asked.alias("asked")).filter(has_direction(F.col("v")))
    usable = materialise(usable.repartition(_tasks(df), "id"), "recall-vectors")
    first = usable.select(F.size("v")).first()
    dims = first[0] if first else 1

    def pack(batches):
        for ids, v in _held(batches, "id", "v", dims, np.float64):
            for low in range(0, len(ids), BLOCK_ROWS):
                u = v[low : low + BLOCK_ROWS]
                u = u / np.sqrt((u * u).sum(axis=1, keepdims=True))
                fine = np.isfinite(u).all(axis=1)  # squares of tiny numbers are zero
                yield pa.RecordBatch.from_arrays([pa.array([ids[low : low + BLOCK_ROWS][fine].tobytes()]), pa.array([u[fine].tobytes()])], ["ids", "u"])

    def blocks(rows: DataFrame, without: int, name: str) -> DataFrame:
        same_size = F.when(F.size("v") == dims, F.col("v")).otherwise(F.raise_error(F.lit("vectors of several sizes")))
        whole = rows.select(F.coalesce("id", F.lit(without)).alias("id"), same_size.alias("v"))
        return materialise(whole.mapInArrow(pack, "ids binary, u binary"), name)

    # Rows without an id are unlike all others, so they have other ids as queries than as neighbours.
    no_query, no_other = -(2**63), -(2**63) + 1
    queries = blocks(usable.filter("asked"), no_query, "recall-queries").withColumn("block", F.monotonically_increasing_id())
    others = blocks(usable.select("id", "v"), no_other, "recall-blocks").select(F.col("ids").alias("c_ids"), F.col("u").alias("c_u"))

    def compare(batches):
        best, block = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                ids, u, at, c_ids, c_u = (batch.column(c)[i].as_py() for c in ("ids", "u", "block", "c_ids", "c_u"))
                c_ids, c_u = np.frombuffer(c_ids, np.int64), np.frombuffer(c_u).reshape(-1, dims)
                if at != block:
                    if best is not None:
                        yield best.result()
                    ids, block = np.frombuffer(ids, np.int64), at
                    best = _Best(ids, np.frombuffer(u).reshape(-1, dims), np.full(len(ids), -2.0), k)
                if (best.limit <= -2.0).any():
                    best.limit = np.maximum(best.limit, _reached(ids, best.u, c_ids, c_u, k))
                best.meet(c_ids, c_u)
        if best is not None:
            yield best.result()

    met = queries.join(others.hint("shuffle_replicate_nl")).select("ids", "u", "block", "c_ids", "c_u")
    best = met.mapInArrow(compare, "id long, neighbour long, similarity double").withColumn("id", F.nullif("id", F.lit(no_query)))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour"))
    truth = best.withColumn("rank", rank).filter(F.col("rank") <= k).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("similarity").alias("least"))
    truth = materialise(truth, "recall-truth")
    near = found.join(truth, "id").groupBy("id", "n").agg(F.count_if(F.col("similarity") >= F.col("least") - 1e-6).alias("hits"))
    hits = truth.select("id", "n").join(near.select("id", "hits"), "id", "left")
    return hits.agg(F.count(F.lit(1)).alias("queries"), (F.sum(F.least("n", F.coalesce("hits", F.lit(0)))) / F.sum("n")).alias("recall"))
