"""Topic queries (inventory 2.13, the one-hot extension and zero-shot assignment)."""

from __future__ import annotations

from pyspark.sql import functions as F

import ratelens.plans.text  # noqa: F401  (registers the term views used below)
from ratelens.operators import density, models, neighbours, terms, topics
from ratelens.plans.registry import query, view
from ratelens.plans.views import document_topics, number_topics, rounded, table
from ratelens.session import materialise

_UNIT = "list_transform({v}, lambda x: x::DOUBLE)"


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source", terms.raw_tokens(F.col("text")).alias("tokens"))


def _weights(spark, sf):
    return terms.ctfidf(_docs(spark, sf), "source", keep=terms.keep_terms())


@query("topic_outlier_rate", "SELECT count(*) AS n, count(*) FILTER (WHERE topic_id = -1) AS n_outliers, round(avg(CASE WHEN topic_id = -1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS outlier_rate FROM dtopics", "dtopics")
def _(spark, sf):
    return rounded(topics.outlier_rate(document_topics(spark, sf)), "outlier_rate")


@query("topic_info", """SELECT topic_id, count(*) AS n, (SELECT count(DISTINCT topic_id) FROM rntopics WHERE topic_id <> -1) AS n_topics,
  (SELECT count(*) FROM rntopics WHERE topic_id = -1) AS n_outliers FROM rntopics WHERE topic_id <> -1 GROUP BY topic_id""", "rntopics")
def _(spark, sf):
    return topics.topic_info(number_topics(spark, sf))


view("ctop", """SELECT source, term, row_number() OVER (PARTITION BY source ORDER BY round(weight, 6) DESC, term) AS rank FROM cw""", "cw")
view("clabel", """SELECT source, string_agg(term, '_' ORDER BY rank) FILTER (rank <= 3) || ' (' || n || ')' AS topic_label, string_agg(term, ' ' ORDER BY rank) AS top_words FROM ctop JOIN (SELECT source, count(*) AS n FROM documents GROUP BY 1) USING (source)
  WHERE rank <= 5 GROUP BY source, n""", "ctop")


def _labels(spark, sf):
    ranked = terms.top_per_group(rounded(_weights(spark, sf), "weight"), "source", "term", "weight", 5)
    sizes = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return topics.topic_labels(ranked, sizes, "source")


@query("topic_label", "SELECT source, topic_label FROM clabel", "clabel")
def _(spark, sf):
    return _labels(spark, sf).select("source", "topic_label")


@query("topic_report", """SELECT doc_id, source, coalesce(topic_label, 'outlier') AS topic_name, top_words FROM (SELECT doc_id, CASE WHEN n_chars % 9 = 0 THEN 'none' ELSE source END AS source FROM documents)
  LEFT JOIN clabel USING (source)""", "clabel")
def _(spark, sf):
    """Documents whose source is hidden have no topic."""
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") % 9 == 0, "none").otherwise(F.col("source")).alias("source"))
    return topics.topic_report(d, _labels(spark, sf), "source", "doc_id")


@query("topic_one_hot", """SELECT doc_id, topic_id, """ + ", ".join(f"CAST(coalesce(topic_id = r.ids[{i + 1}], false) AS INTEGER) AS top_{i + 1}" for i in range(14))
       + """, CAST(NOT list_contains(r.ids, topic_id) AS INTEGER) AS topic_other FROM dtopics, (SELECT list(topic_id ORDER BY n DESC, topic_id) AS ids FROM
  (SELECT topic_id, count(*) AS n FROM dtopics WHERE topic_id <> -1 GROUP BY 1 ORDER BY n DESC, topic_id LIMIT 14)) r""", "dtopics")
def _(spark, sf):
    return topics.one_hot_top(document_topics(spark, sf), "doc_id", 14)


@query("zeroshot_assign", """+cent AS (SELECT label, i, avg(x) AS m FROM (SELECT 'topic ' || label AS label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY ALL),
  cv AS (SELECT label, list(m ORDER BY i) AS v FROM cent GROUP BY label),
  s AS (SELECT e.vec_id, c.label, list_cosine_similarity(list_transform(e.embedding, lambda x: x::DOUBLE), c.v) AS sim FROM embeddings e, cv c),
  b AS (SELECT vec_id, label, sim, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, label) AS k FROM s)
  SELECT vec_id, CASE WHEN sim >= 0.4 THEN label END AS assigned, round(sim, 6) AS similarity FROM b WHERE k = 1""".replace("+cent", "WITH cent", 1))
def _(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("label", F.concat(F.lit("topic "), F.col("label").cast("string")))
    got = topics.zero_shot_assign(e, "vec_id", "embedding", topics.label_vectors(e, "label", "embedding"), "label", 0.4)
    return rounded(got, "similarity")


@query("topic_pair_similarity", """SELECT topic_a, topic_b, round(dot / (na * nb), 6) AS similarity FROM (SELECT a.source AS topic_a, b.source AS topic_b, sum(a.weight * b.weight) AS dot
  FROM cw a JOIN cw b ON a.term = b.term AND a.source < b.source GROUP BY ALL) JOIN (SELECT source AS topic_a, sqrt(sum(weight * weight)) AS na FROM cw GROUP BY 1) USING (topic_a)
  JOIN (SELECT source AS topic_b, sqrt(sum(weight * weight)) AS nb FROM cw GROUP BY 1) USING (topic_b)""", "cw")
def _(spark, sf):
    return rounded(topics.pair_similarity(topics.topic_gram(_weights(spark, sf), "source", table(spark, sf, "documents"))), "similarity")


def _merges(spark, sf, down_to):
    sizes = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return topics.merge_order(topics.topic_gram(_weights(spark, sf), "source", table(spark, sf, "documents")), sizes, "source", down_to)


@query("topic_reduce", """SELECT count(*) AS n, (SELECT least(8, count(DISTINCT source)) FROM documents) AS n_topics, true AS merged_whole FROM documents""")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    reduced = topics.reduce_topics(d, _merges(spark, sf, 8), "source")
    whole = reduced.groupBy("source").agg(F.count_distinct("reduced").alias("k")).agg(F.max("k") == 1).scalar()
    return reduced.agg(F.count("*").alias("n"), F.count_distinct("reduced").alias("n_topics")).withColumn("merged_whole", whole)


@query("topic_hierarchy", """SELECT count(DISTINCT source) - 1 AS n_steps, count(*) AS n_documents, true AS sizes_add_up, true AS similarity_in_range FROM documents""")
def _(spark, sf):
    steps = _merges(spark, sf, 1)
    tree = spark.createDataFrame(steps, "step int, source string, target string, similarity double, n bigint")
    own = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("own"))
    last = tree.filter(F.col("step") == len(steps)).select("n").scalar()
    # Each source is merged away once but one; the last target holds all documents.
    once = tree.select("source").distinct().count() == len(steps) == own.count() - 1
    return tree.agg(F.count("*").alias("n_steps")).select(
        "n_steps", last.alias("n_documents"), (F.lit(once)).alias("sizes_add_up"),
        F.lit(all(-1e-9 <= s[3] <= 1 + 1e-9 for s in steps)).alias("similarity_in_range"))


@query("topic_clusters", """SELECT count(*) AS n, true AS few_topics, true AS flags_agree, true AS large_enough FROM embeddings""")
def _(spark, sf):
    t = models.topic_clusters(table(spark, sf, "embeddings"), "vec_id", "embedding", k=10, min_size=15)
    per = t.groupBy("topic_id").agg(F.count("*").alias("n"), F.sum("is_topic_outlier").alias("out"))
    real = F.col("topic_id") != -1
    return per.agg(
        F.sum("n").alias("n"), (F.count_if(real).between(1, 10)).alias("few_topics"),
        F.every(F.when(real, F.col("out") == 0).otherwise(F.col("out") == F.col("n"))).alias("flags_agree"),
        F.every(~real | (F.col("n") >= 10)).alias("large_enough"))


@query("knn_cosine", """SELECT id, neighbour, round(sim, 6) AS similarity, rank FROM (SELECT a.vec_id AS id, b.vec_id AS neighbour, list_cosine_similarity(list_transform(a.embedding, lambda x: x::DOUBLE),
  list_transform(b.embedding, lambda x: x::DOUBLE)) AS sim, row_number() OVER (PARTITION BY a.vec_id ORDER BY sim DESC, b.vec_id) AS rank
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE rank <= 15""")
def _(spark, sf):
    out = neighbours.knn_cosine(table(spark, sf, "embeddings"), "vec_id", "embedding", 15, block_rows=256)
    return rounded(out, "similarity").withColumn("rank", F.col("rank").cast("long"))


@query("knn_descent", "SELECT count(*) AS n, true AS lists_full, count(*) FILTER (WHERE vec_id % 10 = 0) AS n_asked, true AS recall_reached FROM embeddings")
def _(spark, sf):
    """The approximate neighbour graph of all vectors; its recall is measured against exact products of a tenth of them."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    graph = materialise(neighbours.knn_descent(e, "vec_id", "embedding", 15), "neighbour-graph")
    per = graph.groupBy("id").agg(F.count("*").alias("c"), F.max("rank").alias("r"))
    full = per.agg(F.count("*").alias("n"), F.every((F.col("c") == 15) & (F.col("r") == 15)).alias("lists_full"))
    found = neighbours.recall(graph, e, "vec_id", "embedding", F.col("vec_id") % 10 == 0, 15)
    return full.withColumns({"n_asked": found.select("queries").scalar(), "recall_reached": found.select("recall").scalar() >= 0.9})


_LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßéèêçàñáíóú"


def letter_profile(docs):
    """Rows (doc_id, profile): roots of how often each letter occurs in the whole text."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    count = F.transform(F.split(F.lit(_LETTERS), ""), lambda c: F.sqrt((F.length("low") - F.length(F.replace(F.col("low"), c, F.lit("")))).cast("double")))
    return low.select("doc_id", count.alias("profile"))


@query("density_topics", """SELECT count(*) AS n, count(DISTINCT lang) AS n_languages, true AS pure, true AS few_outliers, true AS large_enough FROM documents""")
def _(spark, sf):
    """Clusters of documents by density of their letter profiles: they are found without the language, and hold one language each."""
    docs = table(spark, sf, "documents")
    profiles = materialise(letter_profile(docs), "letter-profiles")
    least = max(10, profiles.count() // 50)
    graph = neighbours.knn_descent(profiles, "doc_id", "profile", 15)
    apart = F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * F.col("similarity").cast("double")))
    found = density.density_clusters(graph.select("id", "neighbour", apart.alias("distance")), least, 5)
    both = docs.select("doc_id", "lang").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").fillna({"cluster": -1})
    counts = materialise(both.groupBy("cluster", "lang").agg(F.count("*").alias("c")), "cluster-languages")
    real = counts.filter("cluster <> -1").groupBy("cluster").agg(F.sum("c").alias("n"), F.max("c").alias("most"))
    all_rows = counts.agg(F.sum("c").alias("n"), F.count_distinct("lang").alias("n_languages"))
    sizes = real.agg(F.sum("n").alias("clustered"), F.sum("most").alias("most"), F.min("n").alias("least"))
    return all_rows.withColumns({
        "pure": sizes.select("most").scalar() >= 0.95 * sizes.select("clustered").scalar(),
        "few_outliers": sizes.select("clustered").scalar() >= 0.75 * F.col("n"),
        "large_enough": sizes.select("least").scalar() >= least,
    })
