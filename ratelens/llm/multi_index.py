"""Nearest neighbours by inner product with an inverted multi-index.

Vectors are cut into two halves, and each half has a codebook of centroids (fitted on a bounded sample; every vector is
indexed). A vector's cell is the pair of its nearest centroids. A query walks the pairs of centroids from the most promising
sum of two inner products downwards with a heap until the cells passed hold its share of the index, and the vectors of those
cells are ranked again by the exact product in double precision.

Cells are gathered into blocks of bounded size, and a cell larger than a block is split; queries meet a block in batches,
as one matrix product of which only each query's best rows leave the task. So there is no row for a pair of vectors.

Vectors that are null, zero, of another length than the sample's, or hold a null or non-finite component take no part. Ties
go to the smaller id; equal vectors are candidates of each other, rows with the query's own id are not. Fewer candidates
than k are all returned. Rows that repeat a query's id are one query, with the first of their vectors in order. Other columns
are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.llm.common import slice_of
from ratelens.session import materialise

#: Vectors that the codebooks are fitted on, about; centroids of each half.
SAMPLE, CENTROIDS = 20_000, 64
#: Share of the index that a query looks at. Directions spread evenly over a sphere need this much for 0.95 recall.
SHARE = 0.6
#: Vectors per block and queries per batch.
BLOCK, BATCH = 4096, 2048


@dataclass(frozen=True)
class Codebooks:
    first: np.ndarray
    second: np.ndarray

    @property
    def width(self) -> int:
        return self.first.shape[1] + self.second.shape[1]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (_nearest(h, c) for h, c in zip((x[:, : self.first.shape[1]], x[:, self.first.shape[1] :]), (self.first, self.second)))
        return a * len(self.second) + b

    def walk(self, q: np.ndarray, sizes: np.ndarray, wanted: float) -> np.ndarray:
        """Cells passed by the query's walk, as marks: pairs of centroids by falling sum until they hold `wanted` vectors."""
        a, b = self.first @ q[: self.first.shape[1]], self.second @ q[self.first.shape[1] :]
        up, vp = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        a, b = a[up], b[vp]
        passed, held = np.zeros(len(a) * len(b), bool), 0
        heap = [(-(a[0] + b[0]), 0, 0)]
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            cell = up[i] * len(b) + vp[j]
            passed[cell] = True
            held += sizes[cell]
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
        return passed


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids * centroids).sum(1) - 2 * (x @ centroids.T)).argmin(1)


def _k_means(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centroids = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        at = _nearest(x, centroids)
        n = np.bincount(at, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, at, x)
        centroids[n > 0] = total[n > 0] / n[n > 0, None]
    return centroids


def usable(v: Column) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def fit(rows: DataFrame, n: int, sample: int = SAMPLE, centroids: int = CENTROIDS, seed: int = 0) -> Codebooks | None:
    """Codebooks from about `sample` of the n rows (id, v), picked by a hash of the id."""
    cut = F.lit(max(1, min(2**20, -(-(2**20) * sample // max(n, 1)))))
    picked = [r["v"] for r in rows.filter(slice_of(F.xxhash64(F.lit(seed), "id"), 2**20) < cut).select("v").collect()]  # bounded by `sample`
    if not picked:
        return None
    width = Counter(map(len, picked)).most_common(1)[0][0]
    x = np.array([v for v in picked if len(v) == width], np.float64)
    half = max(1, width // 2)
    return Codebooks(_k_means(x[:, :half], centroids, seed), _k_means(x[:, half:], centroids, seed + 1) if width > half else np.zeros((1, 0)))


def _matrix(batch, width: int) -> np.ndarray:
    v = batch.column("v")
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    return np.asarray(v.flatten(), np.float64).reshape(-1, width)


def best_rows(q: np.ndarray, passed: np.ndarray, own: np.ndarray, x: np.ndarray, cells: np.ndarray, ids: np.ndarray, k: int):
    """For each query (index, id, score) of its k best rows in a block; ids ascend, so that ties keep the smaller ones."""
    for low in range(0, len(q), 256):
        part = slice(low, low + 256)
        score = q[part] @ x.T
        score[~passed[part][:, cells]] = -np.inf
        score[own[part][:, None] == ids[None, :]] = -np.inf
        least = np.partition(score, max(0, score.shape[1] - k), axis=1)[:, max(0, score.shape[1] - k)]
        for r in range(len(score)):
            low_score = least[r] - 1e-9 * (1 + abs(least[r])) if np.isfinite(least[r]) else -1e300
            at = np.flatnonzero(score[r] >= low_score)
            exact = (x[at] * q[low + r]).sum(1)  # the same order of sums for equal vectors
            top = np.lexsort((ids[at], -exact))[:k]
            yield low + r, ids[at[top]], exact[top]


def search(vectors: DataFrame, key: str, vec: str, is_query: Column, k: int = 20, share: float = SHARE, block: int = BLOCK, batch: int = BATCH) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows found for every row that `is_query` marks."""
    base = vectors.select(F.col(key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v"), is_query.alias("q"))
    base = base.filter(usable(F.col("v")) & F.col("id").isNotNull())
    n = base.count()
    books = fit(base, n)
    spark = vectors.sparkSession
    if books is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    base = base.filter(F.size("v") == books.width)

    def assign(batches):
        for b in batches:
            cell = books.cells(_matrix(b, books.width)) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32))], [*b.schema.names, "cell"])

    index = materialise(base.mapInArrow(assign, "id long, v array<double>, q boolean, cell int"), "multi-index")
    counts = np.zeros(len(books.first) * len(books.second), np.int64)
    for r in index.groupBy("cell").count().collect():  # at most one row for each pair of centroids
        counts[r["cell"]] = r["count"]
    # Cells in order fill blocks; a cell that is larger than a block has some of its own.
    firsts, parts, number, filled = [], [], 0, 0
    for size in counts.tolist():
        own = max(1, -(-size // block))
        if filled and (own > 1 or filled + size > block):
            number, filled = number + 1, 0
        firsts.append(number)
        parts.append(own)
        if own > 1:
            number += own
        else:
            filled += size
    plan = spark.createDataFrame([(c, f, p) for c, (f, p) in enumerate(zip(firsts, parts))], "c int, first int, parts int")
    placed = index.join(F.broadcast(plan), F.col("cell") == F.col("c"))  # one row for each pair of centroids
    corpus = placed.select("id", "v", "cell", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("block"))
    wanted = max(share * int(counts.sum()), k + 1)  # the query's own vector is one of them
    block_of = [np.arange(f, f + p) for f, p in zip(firsts, parts)]

    def walk(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, 64):  # a query goes to many blocks
                b = whole.slice(low, 64)
                q, at, marks, owner = _matrix(b, books.width), [], [], []
                for r in range(len(q)):
                    passed = books.walk(q[r], counts, wanted)
                    bits = np.packbits(passed).tobytes()
                    for t in np.unique(np.concatenate([block_of[c] for c in np.flatnonzero(passed & (counts > 0))])):
                        owner.append(r)
                        at.append(int(t))
                        marks.append(bits)
                kept = b.take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([kept.column("id"), kept.column("v"), pa.array(at, pa.int32()), pa.array(marks, pa.binary())], ["id", "v", "block", "marks"])

    asked = index.filter("q").groupBy("id").agg(F.min("v").alias("v"))
    batches_of = max(1, -(-asked.count() // batch))
    asked = asked.mapInArrow(walk, "id long, v array<double>, block int, marks binary").withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches_of)).cast("int"))
    spread = corpus.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches_of - 1)))) if batches_of > 1 else corpus.withColumn("batch", F.lit(0))

    def compare(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if queries.num_rows and rows.num_rows:
            rows = rows.sort_by("id")
            x, q = _matrix(rows, books.width), _matrix(queries, books.width)
            ids, own = rows.column("id").to_numpy(), queries.column("id").to_numpy()
            marks = np.unpackbits(np.frombuffer(b"".join(queries.column("marks").to_pylist()), np.uint8).reshape(len(q), -1), axis=1).astype(bool)
            for r, found, score in best_rows(q, marks, own, x, rows.column("cell").to_numpy(), ids, k):
                out[0].append(np.full(len(found), own[r]))
                out[1].append(found)
                out[2].append(score)
        cols = [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(out, (np.int64, np.int64, np.float64))]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), cols)))

    near = asked.groupBy("block", "batch").cogroup(spread.groupBy("block", "batch")).applyInArrow(compare, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
