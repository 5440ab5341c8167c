"""Neighbour descent and density clusters against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.operators import density, neighbours

SF = "/root/testdata/sf0.01"


def vectors(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "id long, v array<double>")


def test_descent_finds_the_neighbours(spark):
    """Recall is above 0.9 on evenly spread vectors, and the lists it works on are of one width however many rows there are."""
    rng = np.random.default_rng(1)
    for n in (600, 1200):
        df = vectors(spark, rng.standard_normal((n, 16)))
        got = neighbours.knn_descent(df, "id", "v", k=10, leaf=64)
        row = neighbours.recall(got, df, "id", "v", F.col("id") % 10 == 0, k=10).first()
        assert row["queries"] == n // 10 and row["recall"] >= 0.9
        per = got.groupBy("id").agg(F.count("*").alias("c"), F.max("rank").alias("r")).collect()
        assert len(per) == n and all(r["c"] == r["r"] == 10 for r in per)
        assert neighbours._members(got.withColumn("old", F.lit(0)), 30).groupBy("list").count().agg(F.max("count")).first()[0] <= 61


def test_lists_reach_the_recall_where_descent_alone_does_not(spark):
    """Evenly spread vectors of many dimensions: lists settle short of the target, so more trees are grown, with or without rounds."""
    rng = np.random.default_rng(3)
    df = vectors(spark, rng.standard_normal((3000, 48)))
    for most, rounds in ((64, 0), (2, 1)):
        got = neighbours.knn_descent(df, "id", "v", k=5, width=5, trees=2, leaf=256, rounds=rounds, most_trees=most)
        assert neighbours.recall(got, df, "id", "v", F.col("id") % 10 == 0, k=5).first()["recall"] >= 0.9
        assert got.groupBy("id").count().filter("count = 5").count() == 3000


def test_trees_part_rows_evenly_and_merge_lists(spark):
    """A tree's leaves stay near their size when all vectors lie in one narrow cone; a vector crosses one exchange a tree, as one list does."""
    rng = np.random.default_rng(4)
    x = (10 + rng.standard_normal((2000, 12))).astype(np.float32)
    planes, cuts = neighbours._splits(x[:500], 8, rng)
    node = np.zeros(len(x), np.int64)
    for _ in range(3):
        node = 2 * node + 1 + (np.einsum("ij,ij->i", x, planes[node]) > cuts[node])
    assert np.bincount(node, minlength=15)[7:].min() > 150
    lists = spark.createDataFrame([(1, [2, 3], [0.5, 0.4]), (1, [4, 2], [0.9, 0.5]), (7, [], [])], "id long, near array<long>, sims array<float>")
    assert {r["id"]: r["near"] for r in neighbours._merged_lists(lists, 2).collect()} == {1: [4, 2], 7: []}


def test_descent_equals_exact_on_a_small_table(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((40, 5))
    x[7] = x[3]  # a copy is a neighbour like any other
    df = vectors(spark, x).union(spark.createDataFrame([(100, [0.0] * 5), (101, None), (102, [float("nan")] * 5)], "id long, v array<double>")).union(vectors(spark, x[:1]))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sim = u @ u.T
    np.fill_diagonal(sim, -9)
    got = defaultdict(dict)
    for r in neighbours.knn_descent(df, "id", "v", k=4).collect():
        got[r["id"]][r["rank"]] = (r["neighbour"], r["similarity"])
    assert sorted(got) == list(range(40))
    for i, found in got.items():
        assert [found[r][1] for r in range(1, 5)] == pytest.approx(sorted(sim[i], reverse=True)[:4], abs=1e-6)
    exact = neighbours.knn_cosine(df.dropDuplicates(["id"]), "id", "v", 4)
    assert {r["id"] for r in exact.select("id").collect()} == set(range(40))
    assert neighbours.knn_descent(df.limit(0), "id", "v").collect() == []


def test_recall_counts_what_is_missed(spark):
    df = vectors(spark, [[1, 0], [1, 0.1], [0, 1], [0.1, 1]])
    exact = neighbours.knn_cosine(df, "id", "v", 1)
    assert neighbours.recall(exact, df, "id", "v", F.lit(True), 1).first()["recall"] == 1.0
    assert neighbours.recall(exact.filter("id < 1"), df, "id", "v", F.lit(True), 1).first()["recall"] == 0.25


@pytest.mark.parametrize("n", [1, 3, 100, 700, 2011])
def test_leaves_give_the_best_of_every_row(n):
    """Whole lists with any number of columns, also where many vectors are copies; ids are not places."""
    rng = np.random.default_rng(n)
    u = rng.standard_normal((n, 8)).astype(np.float32)
    u[5:40] = u[min(5, n - 1)]
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    sim = u @ u.T
    np.fill_diagonal(sim, -9)
    got = [r for b in neighbours._leaf_neighbours(np.arange(n) * 3, u, 15) for r in b.to_pylist()]
    assert [r["id"] for r in got] == [3 * i for i in range(n)]
    for i, r in enumerate(got):
        assert r["id"] not in r["near"] and len(set(r["near"])) == len(r["near"]) == min(15, n - 1)
        assert sorted(r["sims"], reverse=True) == pytest.approx(sorted(sim[i], reverse=True)[: min(15, n - 1)], abs=1e-6)


def test_recall_makes_products_once_and_counts_every_row(spark):
    """What is read of the result afterwards holds no products; rows that repeat an id or have none are neighbours as before."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((900, 6))
    ids = [None if i % 90 == 7 else i - i % 50 % 2 for i in range(len(x))]
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in zip(ids, x)], "id long, v array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    truth = defaultdict(list)
    for i, row in zip(ids, u @ u.T):
        if i is not None and i % 3 == 0:
            truth[i] += [s for j, s in zip(ids, row) if i != j]
    found = neighbours.knn_descent(df, "id", "v", k=4)
    near = defaultdict(list)
    for r in found.collect():
        near[r["id"]].append(r["similarity"])
    want = sum(min(4, sum(s >= sorted(t)[-4] - 1e-6 for s in near[i])) for i, t in truth.items()) / (4 * len(truth))
    row = neighbours.recall(found, df, "id", "v", F.col("id") % 3 == 0, 4)
    assert tuple(row.first()) == (len(truth), pytest.approx(want))
    stored = neighbours.recall(neighbours.materialise(found, "found"), df, "id", "v", F.col("id") % 3 == 0, 4)
    assert not any(word in stored._jdf.queryExecution().toString() for word in ("Python", "Arrow", "Pandas", "Cartesian"))


def test_trees_follow_the_pace_and_leaves_the_rows(spark, monkeypatch):
    """Trees come in as many groups as their pace asks for, and with small leaves the table's size sets the leaf."""
    calls, lists = [], neighbours._tree_lists

    def noted(base, n, sample, width, trees, leaf, seed):
        calls.append((len(trees), leaf))
        return lists(base, n, sample, width, trees, leaf, seed)

    monkeypatch.setattr(neighbours, "_tree_lists", noted)
    monkeypatch.setattr(neighbours, "LEAF", 64)
    df = vectors(spark, np.random.default_rng(6).standard_normal((6400, 32)))
    got = neighbours.knn_descent(df, "id", "v", k=5, trees=2)
    assert neighbours.recall(got, df, "id", "v", F.col("id") % 10 == 0, k=5).first()["recall"] >= 0.9
    assert {leaf for _, leaf in calls} == {128} and len(calls) <= 1 + sum(c for c, _ in calls) // 4


def test_crowded_leaves_are_dealt(spark):
    """Most rows are one vector: they share leaves, which are dealt by the sample; all lists are full and hold copies."""
    x = np.random.default_rng(7).standard_normal((2000, 8))
    x[500:] = x[500]
    got = neighbours.knn_descent(vectors(spark, x), "id", "v", k=5, leaf=64).collect()
    per = defaultdict(list)
    for r in got:
        per[r["id"]].append(r["similarity"])
    assert len(per) == 2000 and all(len(s) == 5 for s in per.values())
    assert all(min(per[i]) > 0.9999 for i in range(500, 2000))


def graph(spark, x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :k]
    rows = [(i, int(j), float(d[i, j])) for i in range(len(x)) for j in order[i]]
    return rows, spark.createDataFrame(rows, "id long, neighbour long, distance double")


def slow_clusters(rows, n, min_size, min_samples):
    """The same definition on one machine: Kruskal merges as a tree of sets, clusters chosen from the top."""
    by = defaultdict(list)
    for i, _, d in rows:
        by[i].append(d)
    core = {i: sorted(ds)[:min_samples][-1] for i, ds in by.items()}
    edges = sorted({(max(d, core[i], core.get(j, 0), 1e-6), min(i, j), max(i, j)) for i, j, d in rows})
    best_of = {}
    for w, a, b in edges:
        best_of[(a, b)] = min(w, best_of.get((a, b), math.inf))
    comp = {i: frozenset([i]) for i in range(n)}
    info = {}  # cluster set at its birth -> [points and the density they joined at, children]
    live = {}  # component -> cluster record
    for w, a, b in sorted((w, a, b) for (a, b), w in best_of.items()):
        x, y = comp[a], comp[b]
        if x == y:
            continue
        z, lam = x | y, 1 / w
        big = [s for s in (x, y) if s in live]
        if len(big) == 2:
            rec = {"joined": {}, "children": [live[x], live[y]], "mass": len(z) * lam, "size": len(z)}
            for s in (x, y):
                live[s]["stable"] = live[s]["mass"] - len(s) * lam
                live.pop(s)
            live[z] = rec
        elif big:
            rec = live.pop(big[0])
            small = y if big[0] == x else x
            rec["joined"].update(dict.fromkeys(small, lam))
            rec["mass"] += len(small) * lam
            live[z] = rec
        elif len(z) >= min_size:
            live[z] = {"joined": dict.fromkeys(z, lam), "children": [], "mass": len(z) * lam}
        for p in z:
            comp[p] = z
    labels = {i: -1 for i in range(n)}

    def members(rec):
        return set(rec["joined"]).union(*[members(c) for c in rec["children"]]) if rec["children"] else set(rec["joined"])

    def best(rec):
        return max(rec["stable"], sum(best(c) for c in rec["children"])) if rec["children"] else max(rec["stable"], 0.0)

    def choose(rec, allowed=True):
        if allowed and rec["stable"] >= sum(best(c) for c in rec["children"]):
            whole = members(rec)
            for p in whole:
                labels[p] = min(whole)
        else:
            for c in rec["children"]:
                choose(c)

    for rec in live.values():
        rec["stable"] = rec["mass"]
        choose(rec, len(live) > 1)
    return labels


def moons_and_ring():
    rng = np.random.default_rng(4)
    t = rng.uniform(0, math.pi, 120)
    one = np.c_[np.cos(t), np.sin(t)]
    two = np.c_[1 - np.cos(t), 0.4 - np.sin(t)]
    a = rng.uniform(0, 2 * math.pi, 200)
    ring = 4 * np.c_[np.cos(a), np.sin(a)]
    noise = rng.uniform(-9, 9, (12, 2)) + np.array([30.0, 0])
    return np.concatenate([one + rng.normal(0, 0.04, one.shape), two + rng.normal(0, 0.04, two.shape), ring + rng.normal(0, 0.05, ring.shape), noise])


@pytest.mark.parametrize("range_edges", [density.RANGE_EDGES, 100])
def test_two_moons_and_a_ring(spark, range_edges):
    x = moons_and_ring()
    rows, df = graph(spark, x, 8)
    got = {r["id"]: r["cluster"] for r in density.density_clusters(df, 20, 5, range_edges=range_edges).collect()}
    assert got == slow_clusters(rows, len(x), 20, 5)
    shapes = [range(120), range(120, 240), range(240, 440)]
    names = [{got[i] for i in s if got[i] != -1} for s in shapes]
    assert all(len(n) == 1 for n in names) and len(set.union(*names)) == 3
    assert all(sum(got[i] == -1 for i in s) <= 0.1 * len(s) for s in shapes) and all(got[i] == -1 for i in range(440, 452))


@pytest.mark.parametrize("seed", range(3))
def test_clusters_equal_brute_force(spark, seed):
    """Blobs of several densities, ties of a grid, copies, and parts of the graph that are not linked."""
    rng = np.random.default_rng(seed)
    blobs = [rng.normal(c, s, (rng.integers(8, 40), 2)) for c, s in (((0, 0), 0.3), ((3, 0), 0.6), ((3, 3), 0.1), ((9, 9), 1.5))]
    grid = np.array([(20 + i, j) for i in range(6) for j in range(6)], float)
    x = np.concatenate([*blobs, grid, np.zeros((9, 2)) + 50])
    rows, df = graph(spark, x, 6)
    got = {r["id"]: r["cluster"] for r in density.density_clusters(df, 8, 4).collect()}
    assert got == slow_clusters(rows, len(x), 8, 4)


def test_clusters_of_little(spark):
    empty = spark.createDataFrame([], "id long, neighbour long, distance double")
    assert density.density_clusters(empty).collect() == []
    pair = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.5)], empty.schema)
    assert sorted(tuple(r) for r in density.density_clusters(pair, 3).collect()) == [(1, -1, None), (2, -1, None)]
    assert sorted(tuple(r) for r in density.density_clusters(pair, 2, 1, single=True).collect()) == [(1, 1, 2.0), (2, 1, 2.0)]
