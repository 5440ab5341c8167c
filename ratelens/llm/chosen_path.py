"""Near-duplicates by a chosen-path set similarity join.

A document is the set of its word shingles and has a sketch of minwise tokens. In each of several independent trees, a node
of documents branches by tokens that the node's own hash selects: documents with the same value go to the same child. On
average 1 / threshold tokens are selected, so a pair at the threshold is expected to stay together on one path at any
depth, while documents that are less alike part. A node that is small is compared exhaustively in one task, one of up to
sixteen times as many in blocks; a larger one first meets its most central member and branches on, up to the depth at which
pairs that agree on half of their tokens have parted.

Only the components are wanted, so whatever is in one component already is not compared again: documents with equal sets
are one from the start, a large group of near copies is linked to its centre, and a node whose members are all in one
component is done. So is a large node once all but a few of its members are one component, and any node at the last depth:
its rest is compared with all its members in blocks of bounded size. A node that was compared in blocks is remembered by its
members: later trees compare them with others, but not with each other once more.

A node is visited twice. First, sketches propose for every member its best partner outside its component, which is confirmed
on the full sets, and members without any such partner leave. If components are left apart, the full sets of those
that stayed are compared in the same blocks. No pair is a row unless it is proposed or linked.

A null or empty text has no shingle and is linked with nothing. `doc_id` identifies documents; rows that repeat one are
returned each. Rows with a null id come back unlinked. Other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.components import components
from ratelens.llm.tokens import forget
from ratelens.session import materialise

WORDS = 5
#: Minwise tokens of a sketch, and independent trees at least. Documents of nodes that descend get more (see trees_for).
TOKENS, TREES = 128, 8
#: Share of the pairs at the threshold that are to meet in a node that is compared.
RECALL = 0.99
#: Nodes of at most so many documents are compared exhaustively, in one task; those of at most so many times as many in blocks.
SMALL, IN_BLOCKS = 256, 16
#: Members of a block of a large node; levels that large nodes descend between two looks at their components.
BLOCK, LEVELS = 1024, 4
#: Likeness at which pairs have parted at the last depth.
FAR = 0.5
#: At most so many ids are sent to the rows they select, which then stay where they are.
FEW_IDS = 1_000_000
#: Sketches propose a pair if they agree on the threshold less this share: four standard errors of 128 tokens.
SLACK = 0.14

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_A = (np.random.default_rng(11).integers(0, 2**63, TOKENS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def loss(threshold: float, level: int, trees: int) -> float:
    """Share of the pairs at the threshold that part in all trees before `level` branches, by sketch spread and selection."""
    k = np.arange(TOKENS + 1)
    chance = np.array([math.comb(TOKENS, int(i)) for i in k], float) * threshold**k * (1 - threshold) ** (TOKENS - k)
    two, together = 1 / threshold - 1, np.ones(TOKENS + 1)
    for _ in range(level):
        parted = 1 - k / TOKENS * together
        together = 1 - ((1 - two) * parted + two * parted**2)
    return float((chance * (1 - together) ** trees).sum())


def trees_for(threshold: float, level: int, recall: float) -> int:
    """Trees that nodes of a depth need for the recall."""
    trees = 1
    while loss(threshold, level, trees) > 1 - recall:
        trees += 1
    return trees


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of every text."""
    words, ends = [], [0]
    for t in texts:
        words += t.encode("utf-8", "surrogatepass").lower().split() if t else []  # ASCII capitals, ASCII white space
        ends.append(len(words))
    hashed = pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(ends, ends[1:]):
        w = hashed[a:b]
        if len(w) >= WORDS:
            n = len(w) - WORDS + 1
            h = w[:n] * _M[0]
            for k in range(1, WORDS):
                h = _mix(h) + w[k : k + n] * _M[k]
            out.append(np.unique(_mix(h)))
        elif len(w):
            h = np.array([len(w)], np.uint64)
            for k in range(len(w)):
                h = _mix(h) + w[k : k + 1] * _M[k]
            out.append(_mix(h))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Minwise tokens of a set, one for each multiplier."""
    out = np.empty(TOKENS, np.uint64)
    for i, a in enumerate(_A):
        out[i] = (shingles * a).min()
    return (_mix(out) >> np.uint64(33)).astype(np.int32)


def _groups(texts: pa.Array, size: int = 2_000_000):
    """Texts of a batch in groups of about so many bytes: where a group starts, and its texts."""
    low, total = 0, 0
    for i, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        total += n
        if total >= size:
            yield low, texts.slice(low, i + 1 - low).to_pylist()
            low, total = i + 1, 0
    if low < len(texts):
        yield low, texts.slice(low).to_pylist()


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a digest of the set (two numbers) and its sketch (null for an empty set)."""

    def run(batches):
        forget()
        for batch in batches:
            for low, texts in _groups(batch.column("text")):
                sets = shingle_sets(texts)
                ones = [(len(s), *((_mix(s).sum(), _mix(s * _M[1]).sum()) if len(s) else (0, 0))) for s in sets]
                n, x, y = zip(*ones)
                sketches = [sketch(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(low, len(texts)), pa.array(n, pa.int64()), pa.array(np.array(x, np.uint64).view(np.int64)),
                    pa.array(np.array(y, np.uint64).view(np.int64)), pa.array(sketches, pa.list_(pa.int32())),
                ], ["doc_id", "n_shingles", "x", "y", "sketch"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_shingles long, x long, y long, sketch array<int>")


def only(rows: DataFrame, ids: DataFrame, key: str = "id", how: str = "left_semi") -> DataFrame:
    """Rows with one of the ids, or without (`left_anti`). Few ids are sent to the rows, so that texts and sketches are not moved."""
    ids = materialise(ids.select(key).distinct(), "wanted-ids")
    few = ids.count() <= FEW_IDS
    return rows.join(F.broadcast(ids) if few else ids, key, how)


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Full sets (id, items) of some documents."""

    def run(batches):
        for batch in batches:
            for low, texts in _groups(batch.column("text")):
                sets = [s.view(np.int64) for s in shingle_sets(texts)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(low, len(texts)), pa.array(sets, pa.list_(pa.int64()))], ["id", "items"])

    plain = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return only(plain, ids).mapInArrow(run, "id long, items array<long>")


def _chosen(node: Column, level: int, threshold: float) -> Column:
    """Tokens that a node selects: one, and a second one in so many nodes that 1 / threshold are selected on average."""
    one = F.pmod(F.xxhash64(node, F.lit(2 * level)), F.lit(TOKENS)).cast("int")
    more = F.pmod(F.xxhash64(node, F.lit(2 * level + 1)), F.lit(TOKENS - 1)).cast("int")
    second = F.pmod(one + 1 + more, F.lit(TOKENS)).cast("int")
    both = F.pmod(F.xxhash64(node, F.lit(-1 - level)), F.lit(1_000_000)) < F.lit(round((1 / threshold - 1) * 1_000_000))
    return F.when(both, F.array(one, second)).otherwise(F.array(one))


def _branch(rows: DataFrame, level: int, threshold: float, levels: int) -> DataFrame:
    """Children of nodes: rows (node, id, sketch, ...) with node replaced."""
    for step in range(levels):
        at = level + step
        child = F.transform(_chosen(F.col("node"), at, threshold), lambda i: F.xxhash64("node", i, F.get("sketch", i)))
        rows = rows.withColumn("node", F.explode(child))
    return rows


def depth_for(n: int, rest: int, levels: int = LEVELS) -> int:
    """Levels after which all but `rest` of n documents that are alike by FAR have parted, in whole descents."""
    return levels * math.ceil(math.log(max(1.0, n / rest)) / math.log(1 / FAR) / levels)


def _groups_of(rows: DataFrame, small: int) -> DataFrame:
    """Rows of open nodes dealt into groups (node, part): those that ask, and those they are compared with if these are others.

    A small node is one group in which all ask each other. In a large one, members outside its largest settled part ask, in
    pieces of at most about four times `small`, and meet all members in blocks.
    """
    few = rows.filter(F.col("members") <= small).withColumns({"part": F.lit(0).cast("long"), "asks": F.lit(True)})
    many = rows.filter(F.col("members") > small)
    blocks, pieces = F.ceil(F.col("members") / BLOCK).cast("int"), F.ceil((F.col("members") - F.col("largest")) / (4 * small)).cast("int")
    block, piece = F.pmod(F.xxhash64("id"), blocks), F.pmod(F.xxhash64("id", F.lit(1)), pieces)
    asked = many.withColumn("part", F.explode(F.transform(F.sequence(F.lit(0), pieces - 1), lambda p: block.cast("long") * pieces + p))).withColumn("asks", F.lit(False))
    asking = many.filter("part_of <> top").withColumn("part", F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: b.cast("long") * pieces + piece)))
    return few.unionByName(asked).unionByName(asking.withColumn("asks", F.lit(True)))


def _by_group(batches, work):
    """Results of `work` on the rows of each group (node, part); rows are sorted by them and come in batches."""
    held: list[pa.RecordBatch] = []

    def key(batch, i):
        return batch.column("node")[i].as_py(), batch.column("part")[i].as_py()

    for batch in batches:
        if not batch.num_rows:
            continue
        node, part = batch.column("node").to_numpy(), batch.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero((node[1:] != node[:-1]) | (part[1:] != part[:-1])) + 1), len(node)]
        if held and key(held[0], 0) != key(batch, 0):
            yield work(pa.Table.from_batches(held))
            held = []
        for a, b in zip(cuts, cuts[1:-1]):
            yield work(pa.Table.from_batches([*held, batch.slice(a, b - a)]))
            held = []
        held.append(batch.slice(cuts[-2]))
    if held:
        yield work(pa.Table.from_batches(held))


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Tokens on which each sketch of x agrees with each of y."""
    if len(x) * len(y) <= 1024:
        return (x[:, None] == y).sum(2, dtype=np.int16)
    same, x, y = np.zeros((len(x), len(y)), np.int16), np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    for t in range(TOKENS):
        same += x[t][:, None] == y[t]
    return same


def _alike(rows: pa.Table, threshold: float) -> tuple[np.ndarray, ...]:
    """Rows that ask, rows they are compared with, tokens they agree on, and whether the pair may be a link between components."""
    asks = rows.column("asks").to_numpy(zero_copy_only=False)
    a = np.flatnonzero(asks)
    b = a if asks.all() else np.flatnonzero(~asks)
    ids, n, comp = (rows.column(c).to_numpy() for c in ("id", "n", "comp"))
    s = np.array(rows.column("sketch").combine_chunks().flatten()).reshape(-1, TOKENS)
    same = _agreement(s[a], s[b])
    near = (same >= (threshold - SLACK) * TOKENS) & (np.minimum(n[a, None], n[b]) >= threshold * np.maximum(n[a, None], n[b]))
    return a, b, same, near & (comp[a, None] != comp[b]) & (ids[a, None] != ids[b])


def _propose(groups: DataFrame, threshold: float) -> DataFrame:
    """Rows (node, a, b): pairs to confirm, and with b null the members that have partners outside their component.

    A small node links each group of alike members to its most central one, which is a; in a block, everyone that asks
    proposes its best partner.
    """

    def work(rows: pa.Table) -> pa.RecordBatch:
        a, b, same, alike = _alike(rows, threshold)
        ids, got = rows.column("id").to_numpy(), []
        if a is b:
            weight, open_ = (same * alike).sum(1), alike.any(axis=1)
            stay = a[open_]
            while open_.any():
                centre = int(np.lexsort((ids[a], -weight * open_, ~open_))[0])
                open_[centre] = False
                others = np.flatnonzero(alike[centre] & open_)
                open_[others] = False
                got += [(ids[a[centre]], ids[a[o]]) for o in others]
        else:
            stay = np.concatenate([a[alike.any(axis=1)], b[alike.any(axis=0)]])
            best = np.where(alike, same, -1).argmax(axis=1)
            got = [(ids[b[best[i]]], ids[a[i]]) for i in np.flatnonzero(alike.any(axis=1))]
        node = rows.column("node")[0].as_py()
        first, second = [p[0] for p in got] + ids[stay].tolist(), [p[1] for p in got] + [None] * len(stay)
        return pa.RecordBatch.from_arrays([pa.array([node] * len(first), pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64())], ["node", "a", "b"])

    ordered = groups.select("node", "part", "asks", "id", "n", "comp", "sketch").repartition("node", "part").sortWithinPartitions("node", "part", "id")
    return ordered.mapInArrow(lambda batches: _by_group(batches, work), "node long, a long, b long")


def _in_common(items: pa.ListArray, a: np.ndarray, b: np.ndarray, most: int = 2_000_000) -> np.ndarray:
    """Items that the sets of rows a share with those of rows b, at most about `most` items of either looked up at a time."""
    ends, flat = items.offsets.to_numpy(), items.values.to_numpy()
    out = np.zeros((len(a), len(b)), np.int64)
    filled = np.cumsum([ends[k + 1] - ends[k] for k in b])
    low = 0
    while low < len(b):
        high = max(low + 1, int(np.searchsorted(filled, most + (filled[low - 1] if low else 0), "right")))
        of = np.repeat(np.arange(high - low), [ends[k + 1] - ends[k] for k in b[low:high]])
        held = np.concatenate([flat[ends[k] : ends[k + 1]] for k in b[low:high]])
        order = np.argsort(held, kind="stable")
        held, of = held[order], of[order]
        for i, k in enumerate(a):
            asked = flat[ends[k] : ends[k + 1]]
            first = np.searchsorted(held, asked, "left")
            n = np.searchsorted(held, asked, "right") - first
            first, n = first[n > 0], n[n > 0]
            for x, y in _runs(n, most):
                at = np.repeat(first[x:y] - np.append(0, np.cumsum(n[x:y])[:-1]), n[x:y]) + np.arange(n[x:y].sum())
                out[i, low:high] += np.bincount(of[at], minlength=high - low)
        low = high
    return out


def _runs(n: np.ndarray, most: int):
    """Cuts of numbers into runs that add up to at most about `most`."""
    low, total = 0, np.cumsum(n)
    while low < len(n):
        high = max(low + 1, int(np.searchsorted(total, most + (total[low - 1] if low else 0), "right")))
        yield low, high
        low = high


def _settle(groups: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components of a group, by its members' full sets. Pairs that a link has joined are left out."""

    def work(rows: pa.Table) -> pa.RecordBatch:
        a, b, _, alike = _alike(rows, percent / 100)
        ids, n, comp = (rows.column(c).to_numpy() for c in ("id", "n", "comp"))
        i, j = np.flatnonzero(alike.any(axis=1)), np.flatnonzero(alike.any(axis=0))
        a, b, alike = a[i], b[j], alike[np.ix_(i, j)]
        both = _in_common(rows.column("items").combine_chunks(), a, b)
        linked = alike & (100 * both >= percent * (n[a, None] + n[b] - both))
        comp, got = np.unique(comp, return_inverse=True)[1], []
        for x, row in zip(a, linked):
            near = b[row]
            _, first = np.unique(comp[near], return_index=True)
            for y in near[first]:  # one for each component that is not yet joined
                if comp[x] != comp[y]:
                    got.append((ids[x], ids[y]))
                    comp[comp == comp[y]] = comp[x]
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in got], pa.int64()), pa.array([p[1] for p in got], pa.int64())], ["a", "b"])

    sets = materialise(_sets_of(docs, groups), "group-sets")
    ordered = groups.join(sets, "id").select("node", "part", "asks", "id", "n", "comp", "sketch", "items").repartition("node", "part").sortWithinPartitions("node", "part", "id")
    return ordered.mapInArrow(lambda batches: _by_group(batches, work), "a long, b long")


def _centres(large: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of the most central member of each large node, a, with the members whose sketches are like its own.

    Central is who agrees with most others on a group of twelve tokens.
    """
    rows = large.select("node", "id", F.xxhash64(F.slice("sketch", 1, 12)).alias("t"))
    often = rows.groupBy("node", "t").agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("c"))
    best = often.groupBy("node").agg(F.max(F.struct("w", (-F.col("c")).alias("c"))).alias("m")).select("node", (-F.col("m.c")).alias("c"))
    centre = large.select("node", F.col("id").alias("c"), F.col("n").alias("cn"), F.col("comp").alias("cc"), F.col("sketch").alias("cs")).join(best, ["node", "c"])
    met = large.join(centre, "node").filter(F.col("comp") != F.col("cc"))
    agree = F.size(F.filter(F.zip_with("sketch", "cs", lambda x, y: x == y), lambda x: x))
    near = met.filter((agree >= F.lit(threshold - SLACK) * TOKENS) & (F.least("n", "cn") >= F.lit(threshold) * F.greatest("n", "cn")))
    return near.select(F.col("c").alias("a"), F.col("id").alias("b"))


def _confirm(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold: 100 * intersection >= percent * union."""
    sets = materialise(_sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("id"))), "full-sets")
    left = pairs.join(sets.select(F.col("id").alias("b"), F.col("items").alias("right")), "b")
    both = left.join(sets.select(F.col("id").alias("a"), F.col("items").alias("left")), "a")
    common = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - common
    return both.filter(common * 100 >= union * percent).select("a", "b")


def _joined(comp: DataFrame | None, merged: DataFrame) -> DataFrame:
    """Components after some of them, or single documents, were merged."""
    if comp is None:
        return merged
    to = merged.select(F.col("id").alias("comp"), F.col("comp").alias("to"))
    kept = comp.join(to, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp"))
    alone = merged.join(comp.select("id"), "id", "left_anti")
    return materialise(kept.unionByName(alone), "components")


def _renamed(links: DataFrame, comp: DataFrame | None) -> DataFrame:
    """Links between documents as links between the components they are in."""
    if comp is None:
        return links.select("a", "b")
    of = links.join(comp.select(F.col("id").alias("a"), F.col("comp").alias("ca")), "a", "left").join(comp.select(F.col("id").alias("b"), F.col("comp").alias("cb")), "b", "left")
    return of.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))


def _parts(settled: list[DataFrame]) -> DataFrame:
    """The largest node (id, part_of) in which a document was compared with all others, of rows (id, node, members)."""
    rows = reduce(DataFrame.unionByName, settled).groupBy("id").agg(F.max(F.struct("members", "node")).alias("m"))
    return materialise(rows.select("id", F.col("m.node").alias("part_of")), "settled-parts")


def _grow(
    reps: DataFrame, docs: DataFrame, low: int, high: int, depth: int, comp: DataFrame | None, percent: int, small: int, parts: DataFrame | None = None,
) -> tuple[DataFrame | None, list[DataFrame], list[DataFrame]]:
    """Components after trees low to high - 1 of some documents, rows (id, depth) of those in nodes that descended, and rows
    (id, node, members) of those in nodes that were compared in blocks.

    parts: rows (id, part_of); documents of one part have been compared with each other.
    """
    threshold, deep, settled, level = percent / 100, [], [], 1
    roots = [F.lit(t).cast("long") for t in range(low, high)]
    first = F.flatten(F.array(*[F.transform(_chosen(r, 0, threshold), lambda i, r=r: F.xxhash64(r, i, F.get("sketch", i))) for r in roots]))
    nodes = reps.select("id", F.explode(first).alias("node"), F.lit(False).alias("seen"))
    while True:
        # Nodes of more than one component, and not of one part, with their members, their largest part and its size. A
        # document of no part counts as one of its component's.
        rows = nodes.withColumn("comp", F.col("id")) if comp is None else nodes.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        rows = rows.withColumn("part_of", F.col("comp")) if parts is None else rows.join(parts, "id", "left").withColumn("part_of", F.coalesce("part_of", "comp"))
        per = rows.groupBy("node", "part_of").agg(F.count(F.lit(1)).alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        stats = per.groupBy("node").agg(F.sum("c").alias("members"), F.max(F.struct("c", "part_of")).alias("m"), F.count(F.lit(1)).alias("several"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        stats = stats.filter("several > 1 and lo < hi").select("node", "members", F.col("m.c").alias("largest"), F.col("m.part_of").alias("top"))
        descends = (F.col("members") > IN_BLOCKS * small) & (F.col("members") - F.col("largest") > small) & ~F.col("seen") & F.lit(level < depth)
        open_ = materialise(rows.join(stats, "node").withColumn("descends", descends), "open-ids")
        # One look tells which kinds of nodes there are; no job is run for a kind that there is not.
        fresh_ones, more, last = open_.agg(F.bool_or(~F.col("seen") & ~F.col("descends")), F.bool_or("descends"), F.bool_or("seen")).first()
        if not (fresh_ones or more or last):
            break
        open_ = materialise(open_.join(only(reps, open_), "id"), "open-nodes")
        many, again, fresh = open_.filter("descends"), open_.filter("seen"), open_.filter("not descends and not seen")
        proposed, links = [], []
        if fresh_ones:
            settled.append(fresh.filter(F.col("members") > small).select("id", "node", "members"))
            visited = materialise(_propose(_groups_of(fresh, small), threshold), "visited-nodes")
            proposed.append(visited.filter("b is not null").select("a", "b"))
        if more:
            proposed.append(_centres(many, threshold))
        if proposed:
            pairs = materialise(reduce(DataFrame.unionByName, proposed).distinct(), "proposed")
            links += [] if pairs.isEmpty() else [_confirm(pairs, docs, percent)]
        if last:
            links.append(_settle(_groups_of(again, small), docs, percent))
        if links:
            linked = materialise(_renamed(reduce(DataFrame.unionByName, links), comp), "confirmed")
            if not linked.isEmpty():
                comp = _joined(comp, components(linked))
        if not (fresh_ones or more):
            break  # nothing is left to visit
        later = []
        if fresh_ones:
            later.append(visited.filter("b is null").select(F.col("a").alias("id"), "node", F.lit(True).alias("seen")).distinct())
        if more:
            later.append(_branch(many.select("node", "id", "sketch"), level, threshold, LEVELS).select("id", "node", F.lit(False).alias("seen")))
            level += LEVELS
            deep.append(many.select("id", F.lit(level).alias("depth")))
        nodes = materialise(reduce(DataFrame.unionByName, later), "nodes")
    return comp, deep, settled


def near_duplicates(docs: DataFrame, percent: int = 80, trees: int = TREES, small: int = SMALL, recall: float = RECALL) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept (doc_id = component_id) for every row.

    Further trees are run on the documents of nodes that descended, until pairs at the threshold meet with `recall` at the depth
    that was reached.
    """
    if not 0 < recall < 1:
        raise ValueError("recall must be between 0 and 1")
    threshold = percent / 100
    signed = materialise(signatures(docs), "signatures")
    filled = signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = materialise(filled.groupBy("x", "y").agg(F.min("doc_id").alias("id")), "set-classes")
    reps = filled.join(classes, ["x", "y"]).filter(F.col("doc_id") == F.col("id"))
    reps = materialise(reps.select("id", F.col("n_shingles").alias("n"), "sketch").dropDuplicates(["id"]), "set-sketches")
    comp, reached, settled, some = None, None, [], reps
    depth = 1 + depth_for(reps.count(), IN_BLOCKS * small)
    # The first tree alone finds the large groups, so that nodes of the others that lie within one are done at once.
    done, want, least = 0, 1, max(trees, trees_for(threshold, 1, recall))
    while want > done:
        comp, deep, compared = _grow(some, docs, done, want, depth, comp, percent, small, _parts(settled) if settled else None)
        done, settled = want, settled + compared
        for d in deep:
            reached = d if reached is None else reached.unionByName(d)
        if done < least:
            want = least
            continue
        if reached is None:
            break
        reached = materialise(reached.groupBy("id").agg(F.max("depth").alias("depth")), "depths")
        top = reached.agg(F.max("depth")).first()[0] or 1
        want = trees_for(threshold, top, recall)
        if want > done:
            lowest = next(k for k in range(1, top + 1) if trees_for(threshold, k, recall) > done)
            some = materialise(reps.join(reached.filter(F.col("depth") >= lowest).select("id"), "id", "left_semi"), "deep-sketches")
    out = signed.join(classes.withColumnRenamed("id", "rep"), ["x", "y"], "left")
    if comp is not None:
        out = out.join(comp.select(F.col("id").alias("rep"), "comp"), "rep", "left")
    else:
        out = out.withColumn("comp", F.lit(None).cast("long"))
    linked = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("comp", "rep"))
    out = out.select("doc_id", "n_shingles", F.coalesce(linked, F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
