"""Topic tables: sizes, labels, assignment to given labels, similarity, merging."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.config import NO_TOPIC

#: Labels compared in one row, and topics per block of a similarity matrix.
LABEL_BLOCK, GRAM_BLOCK = 256, 512


def outlier_rate(topics: DataFrame) -> DataFrame:
    flag = (F.col("topic_id") == NO_TOPIC).cast("long")
    return topics.agg(F.count("*").alias("n"), F.sum(flag).alias("n_outliers"), F.avg(flag).alias("outlier_rate"))


def topic_info(topics: DataFrame) -> DataFrame:
    """Size of every real topic, with the number of topics and of outliers on each row."""
    counts = topics.groupBy("topic_id").agg(F.count("*").alias("n"))
    real = counts.filter(F.col("topic_id") != NO_TOPIC)
    outliers = counts.agg(F.coalesce(F.sum(F.when(F.col("topic_id") == NO_TOPIC, F.col("n"))), F.lit(0)).alias("o")).scalar()
    n_topics = real.agg(F.count("*").alias("t")).scalar()
    return real.withColumns({"n_topics": n_topics, "n_outliers": outliers}).orderBy(F.desc("n"), "topic_id")


def topic_labels(ranked_terms: DataFrame, sizes: DataFrame, group: str, words: int = 3) -> DataFrame:
    """Topic name: top words joined by underscores, and the size in brackets; and all the ranked words given."""
    names = ranked_terms.groupBy(group).agg(
        F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("t")
    )
    joined = names.join(sizes, group)
    terms = F.transform("t", lambda x: x["term"])
    body = F.array_join(F.slice(terms, 1, words), "_")
    name = F.concat(body, F.lit(" ("), F.format_number(F.col("n"), 0), F.lit(")"))
    return joined.select(group, name.alias("topic_label"), F.array_join(terms, " ").alias("top_words"))


def topic_report(docs: DataFrame, labels: DataFrame, group: str, key: str) -> DataFrame:
    """Topic name and top words per document; documents outside every topic say so and have no words."""
    return docs.join(labels, group, "left").select(key, group, F.coalesce("topic_label", F.lit("outlier")).alias("topic_name"), "top_words")


def one_hot(topics: DataFrame, key: str, top: Sequence[int]) -> DataFrame:
    """0/1 columns for the given topics and one for all others."""
    t = F.col("topic_id")
    flags = [(t == i).cast("int").alias(f"topic_{i}") for i in top]
    return topics.select(key, *flags, (~t.isin(*top)).cast("int").alias("topic_other"))


def one_hot_top(topics: DataFrame, key: str, n: int) -> DataFrame:
    """0/1 columns for the n largest topics, named by size rank, and one for all others.

    The rank order is a one-row array (at most n ids) used as a scalar subquery.
    """
    ranked = topics.filter(F.col("topic_id") != NO_TOPIC).groupBy("topic_id").agg(F.count("*").alias("c")).orderBy(
        F.desc("c"), "topic_id"
    ).limit(n)
    order = ranked.agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("c")).alias("k"), "topic_id"))), lambda s: s["topic_id"]).alias("a")
    ).scalar()
    at = topics.withColumn("_r", F.array_position(order, F.col("topic_id")))
    flags = [(F.col("_r") == i + 1).cast("int").alias(f"top_{i + 1}") for i in range(n)]
    return at.select(key, "topic_id", *flags, (F.col("_r") == 0).cast("int").alias("topic_other"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def unit(v: Column) -> Column:
    """Vector scaled to length one; null if it has no length."""
    # The length is bound to a lambda variable; inside the inner lambda it would be recomputed per component.
    scaled = F.transform(F.array(F.sqrt(_dot(v, v))), lambda n: F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n)))
    return F.get(scaled, F.lit(0))


def label_vectors(vectors: DataFrame, label: str, vec: str) -> DataFrame:
    """Mean vector per label, one row per label."""
    flat = vectors.select(label, F.posexplode(vec).alias("i", "x")).groupBy(label, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return flat.groupBy(label).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("label_vec")
    )


def zero_shot_assign(docs: DataFrame, key: str, vec: str, labels: DataFrame, label: str, min_similarity: float = 0.4) -> DataFrame:
    """Nearest label by cosine (ties: the first in order), or none below the minimum.

    Labels of any type go in blocks of LABEL_BLOCK; a document meets each block in one row and keeps the best label of
    all blocks. Null and all-zero vectors have no similarity and are not assigned.
    """
    place = labels.agg(F.array_sort(F.collect_list(label)).alias("o")).scalar()
    numbered = labels.withColumn("_i", (F.array_position(place, F.col(label)) - 1).cast("int"))
    blocks = numbered.groupBy(F.floor(F.col("_i") / LABEL_BLOCK).cast("int").alias("_block")).agg(
        F.collect_list(F.struct("_i", F.col(label).alias("label"), unit(F.col("label_vec")).alias("u"))).alias("_t")
    )
    last = numbered.agg(F.coalesce(F.floor(F.max("_i") / LABEL_BLOCK), F.lit(0)).cast("int").alias("n")).scalar()
    sims = F.transform("_t", lambda t: F.struct(_dot(F.col("_u"), t["u"]).alias("similarity"), (-t["_i"]).alias("first"), t["label"].alias("label")))
    staged = docs.select(key, unit(F.col(vec)).alias("_u")).withColumn("_block", F.explode(F.sequence(F.lit(0), last)))
    best = staged.join(blocks, "_block", "left").select(key, F.array_max(F.filter(sims, lambda x: x["similarity"].isNotNull())).alias("b"))
    best = best.groupBy(key).agg(F.max("b").alias("b"))
    return best.select(key, F.when(F.col("b.similarity") >= min_similarity, F.col("b.label")).alias("assigned"), F.col("b.similarity").alias("similarity"))


def topic_gram(weights: DataFrame, group: str, groups: DataFrame) -> DataFrame:
    """Dot products of all topic vectors, long form (topic_a, topic_b, dot) with their positions a and b.

    Terms are grouped with the weights they have; each task adds its terms into blocks of the topics x topics matrix, and
    only the blocks' entries are shuffled. No pair of entries is ever a row before. A task holds a bounded number of
    blocks and hands them on when there are more. `groups` holds the topics; passing it saves deriving them.
    """
    order = groups.select(group).distinct().agg(F.array_sort(F.collect_list(group)).alias("o")).scalar()
    placed = weights.select("term", F.struct((F.array_position(order, F.col(group)) - 1).cast("int").alias("p"), "weight").alias("e"))
    rows = placed.groupBy("term").agg(F.collect_list("e").alias("e")).select(
        F.col("e.p").alias("p"), F.col("e.weight").alias("w")
    )

    def entries(blocks):
        for (i, j), m in blocks.items():
            a, b = np.nonzero(m)
            yield pd.DataFrame({"a": a + i * GRAM_BLOCK, "b": b + j * GRAM_BLOCK, "dot": m[a, b]})

    def add(batches):
        blocks: dict = {}
        for pdf in batches:
            for start in range(0, len(pdf), 2048):
                part = pdf.iloc[start:start + 2048]
                sizes = part["p"].map(len).to_numpy()
                row, p, w = np.repeat(np.arange(len(part)), sizes), np.concatenate(part["p"].to_numpy()), np.concatenate(part["w"].to_numpy())
                strips = {}
                for i in np.unique(p // GRAM_BLOCK):
                    at = p // GRAM_BLOCK == i
                    strips[i] = np.zeros((len(part), GRAM_BLOCK))
                    strips[i][row[at], p[at] % GRAM_BLOCK] = w[at]
                for i, x in strips.items():
                    for j, y in strips.items():
                        blocks[i, j] = blocks.get((i, j), 0.0) + x.T @ y
                        if len(blocks) >= 64:
                            yield from entries(blocks)
                            blocks = {}
        yield from entries(blocks)

    partial = rows.mapInPandas(add, "a int, b int, dot double")
    summed = partial.groupBy("a", "b").agg(F.sum("dot").alias("dot"))
    return summed.withColumns({"topic_a": F.element_at(order, F.col("a") + 1), "topic_b": F.element_at(order, F.col("b") + 1)})


def pair_similarity(gram: DataFrame) -> DataFrame:
    """Cosine of every topic pair with a shared term (a before b)."""
    norm = gram.filter(F.col("a") == F.col("b")).select(F.col("a").alias("k"), F.sqrt("dot").alias("norm"))
    na = norm.select(F.col("k").alias("a"), F.col("norm").alias("na"))
    nb = norm.select(F.col("k").alias("b"), F.col("norm").alias("nb"))
    return gram.filter(F.col("a") < F.col("b")).join(na, "a").join(nb, "b").select(
        "topic_a", "topic_b", (F.col("dot") / (F.col("na") * F.col("nb"))).alias("similarity")
    )


def merge_order(gram: DataFrame, sizes: DataFrame, group: str, down_to: int) -> list[tuple]:
    """Greedy merging of the smallest topic into its most similar one, on the bounded topics table.

    Returns (step, source, target, similarity, merged size). Merging is one decision after the other, so the topics x
    topics matrix is taken to the driver: its size is the number of topics that the user's topic model was given, and
    does not grow with the documents. Merged vectors add up, hence so do their dot products.
    """
    g = gram.select("topic_a", "topic_b", "dot").toPandas().pivot(index="topic_a", columns="topic_b", values="dot").fillna(0.0)
    known = gram.select(F.col("topic_a").alias(group)).distinct()
    n = {r[0]: int(r[1]) for r in sizes.select(group, "n").join(known, group, "left_semi").collect()}
    names = list(g.index)
    m = g.to_numpy(copy=True)
    steps = []
    while len(names) > down_to:
        i = min(range(len(names)), key=lambda x: (n[names[x]], names[x]))
        norms = np.sqrt(np.maximum(np.diag(m), 1e-300))
        sim = m[i] / (norms * norms[i])
        sim[i] = -np.inf
        j = int(np.argmax(sim))
        n[names[j]] += n[names[i]]
        steps.append((len(steps) + 1, names[i], names[j], float(sim[j]), n[names[j]]))
        m[j] += m[i]
        m[:, j] += m[:, i]
        keep = [x for x in range(len(names)) if x != i]
        m, names = m[np.ix_(keep, keep)], [names[x] for x in keep]
    return steps


def reduce_topics(topics: DataFrame, steps: list[tuple], group: str) -> DataFrame:
    """Apply the merges to the assignment table."""
    target: dict = {}
    for _, src, dst, _, _ in reversed(steps):
        target[src] = target.get(dst, dst)
    if not target:
        return topics.withColumn("reduced", F.col(group))
    table = F.create_map(*[F.lit(x) for kv in target.items() for x in kv])
    return topics.withColumn("reduced", F.coalesce(table[F.col(group)], F.col(group)))
