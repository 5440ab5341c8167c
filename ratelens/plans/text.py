"""Text and term queries (inventory 2.5, 2.6, 2.9 and naive Bayes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelens.functions.text import alpha_tokens
from ratelens.operators import evaluation, terms
from ratelens.operators.features import sentiment_scores
from ratelens.plans.aggregates import metrics_sql
from ratelens.plans.ingest import _INDEX, _WTOK
from ratelens.plans.registry import query, view
from ratelens.plans.views import (
    RULES,
    WORD_CLASS,
    binary_documents,
    clean_reviews,
    rounded,
    scored_text,
    table,
    word_lists,
)

_TOP = """SELECT {g}, term, n, row_number() OVER (PARTITION BY {g} ORDER BY n DESC, term) AS rank FROM {src}"""


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source", terms.raw_tokens(F.col("text")).alias("tokens"))


def _train(spark, sf):
    return binary_documents(spark, sf).filter(F.col("split") == "train")


def _count(df):
    return df.agg(F.count("*").cast("double").alias("n")).scalar()


view("vocab", """SELECT term, count(*) AS total, count(DISTINCT doc_id) AS df FROM btok WHERE split = 'train' GROUP BY term
  HAVING count(DISTINCT doc_id) >= 2 ORDER BY total DESC, term LIMIT 1000""", "btok")
view("tf", "SELECT doc_id, y, split, term, count(*) AS tf FROM btok JOIN vocab USING (term) GROUP BY ALL", "btok", "vocab")
view("tfidf0", """SELECT doc_id, split, term, tf, (ln(tf::DOUBLE) + 1) * (ln(((SELECT count(*) FROM bdocs WHERE split = 'train') + 1.0::DOUBLE) / (df + 1.0::DOUBLE)) + 1) AS w
  FROM tf JOIN (SELECT term, df FROM vocab) USING (term)""", "tf", "vocab", "bdocs")
view("tfidf", "SELECT doc_id, split, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM tfidf0", "tfidf0")
view("nb", """SELECT term, ln((coalesce(n0, 0) + 1.0::DOUBLE) / ((SELECT sum(tf) FROM tf WHERE y = 0 AND split = 'train') + (SELECT count(*) FROM vocab))::DOUBLE) AS log_prob_0,
  ln((coalesce(n1, 0) + 1.0::DOUBLE) / ((SELECT sum(tf) FROM tf WHERE y = 1 AND split = 'train') + (SELECT count(*) FROM vocab))::DOUBLE) AS log_prob_1
  FROM vocab LEFT JOIN (SELECT term, sum(tf) FILTER (WHERE y = 0) AS n0, sum(tf) FILTER (WHERE y = 1) AS n1 FROM tf WHERE split = 'train' GROUP BY term) USING (term)""", "vocab", "tf")
view("nbpred", """SELECT d.doc_id, d.y, d.split, coalesce(s0, 0) + ln((SELECT count(*) FROM bdocs WHERE y = 0 AND split = 'train') / (SELECT count(*) FROM bdocs WHERE split = 'train')::DOUBLE) AS score_0,
  coalesce(s1, 0) + ln((SELECT count(*) FROM bdocs WHERE y = 1 AND split = 'train') / (SELECT count(*) FROM bdocs WHERE split = 'train')::DOUBLE) AS score_1
  FROM bdocs d LEFT JOIN (SELECT doc_id, sum(tf * log_prob_0) AS s0, sum(tf * log_prob_1) AS s1 FROM tf JOIN nb USING (term) GROUP BY doc_id) USING (doc_id)""", "bdocs", "tf", "nb")


@query("topk_terms_by_group", "SELECT * FROM (" + _TOP.format(g="stars", src="(SELECT stars, term, count(*) AS n FROM ctok JOIN rtc USING (doc_id) GROUP BY ALL)") + ") WHERE rank <= 20", "ctok", "rtc")
def _(spark, sf):
    r = clean_reviews(spark, sf)
    return terms.topk_terms(r, "stars", 20, terms.raw_tokens(F.col("text")), terms.keep_terms()).withColumn("rank", F.col("rank").cast("long"))


@query("clean_tokens", "SELECT d.doc_id, CAST(count(term) AS INTEGER) AS n_tokens, CAST(count(DISTINCT term) AS INTEGER) AS n_distinct FROM documents d LEFT JOIN ctok c USING (doc_id) GROUP BY d.doc_id", "ctok")
def _(spark, sf):
    return terms.token_summary(table(spark, sf, "documents"))


@query("sentence_counts", r"""SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '[.!?]+\s+'), lambda s: regexp_matches(s, '[^\s.!?]'))) AS INTEGER) AS n_sentences FROM documents""")
def _(spark, sf):
    return terms.sentence_counts(table(spark, sf, "documents"))


@query("lexicon_compound", "SELECT review_id, vader_compound FROM plainscore", "plainscore")
def _(spark, sf):
    return scored_text(spark, sf).select("review_id", "vader_compound")


@query("sentiment_scores", "SELECT review_id, stars, vader_compound, normalized_stars, round(sentiment_star_divergence, 6) AS sentiment_star_divergence, suspicious FROM ruled", "ruled")
def _(spark, sf):
    return rounded(sentiment_scores(clean_reviews(spark, sf), RULES), "sentiment_star_divergence")


@query("sentiment_divergence", "SELECT review_id, normalized_stars, round(sentiment_star_divergence, 6) AS sentiment_star_divergence, suspicious FROM scored", "scored")
def _(spark, sf):
    s = sentiment_scores(clean_reviews(spark, sf), RULES, plain=True)
    return rounded(s.select("review_id", "normalized_stars", "sentiment_star_divergence", "suspicious"), "sentiment_star_divergence")


@query("lexicon_classifier_metrics", metrics_sql("(SELECT CASE WHEN stars > 3 THEN 1 ELSE 0 END AS y, CASE WHEN vader_compound >= 0 THEN 1 ELSE 0 END AS p FROM scored WHERE stars <> 3)", "y", "p"), "scored")
def _(spark, sf):
    p = scored_text(spark, sf).filter(F.col("stars") != 3).select(
        (F.col("stars") > 3).cast("int").alias("y"), (F.col("vader_compound") >= 0).cast("int").alias("p")
    )
    return rounded(evaluation.binary_metrics(p, "y", "p"), *evaluation.METRICS)


def _vocab(train):
    return terms.vocabulary(train, 1000, 2, keep=terms.keep_terms(2))


@query("count_vectors", "SELECT doc_id, term, tf FROM tf", "tf")
def _(spark, sf):
    d = binary_documents(spark, sf)
    return terms.count_vectors(d, _vocab(d.filter(F.col("split") == "train")), "doc_id")


@query("vocabulary", "SELECT term, CAST(total AS BIGINT) AS total, df FROM vocab", "vocab")
def _(spark, sf):
    return _vocab(_train(spark, sf))


@query("tfidf_vectors", "SELECT doc_id, term, tf, round(weight, 6) AS weight FROM tfidf", "tfidf")
def _(spark, sf):
    d = binary_documents(spark, sf)
    train = d.filter(F.col("split") == "train")
    return rounded(terms.tfidf_vectors(d, _vocab(train), "doc_id", _count(train)), "weight")


@query("tfidf_mean_weights", "SELECT term, round(sum(weight) / (SELECT count(*) FROM bdocs WHERE split = 'train')::DOUBLE, 6) AS mean_weight FROM tfidf WHERE split = 'train' GROUP BY term", "tfidf", "bdocs")
def _(spark, sf):
    train = _train(spark, sf)
    n = _count(train)
    return rounded(terms.mean_weights(terms.tfidf_vectors(train, _vocab(train), "doc_id", n), n), "mean_weight")


@query("top_terms_count", "SELECT term, CAST(total AS BIGINT) AS total FROM vocab ORDER BY total DESC, term LIMIT 20", "vocab")
def _(spark, sf):
    return terms.vocabulary(_train(spark, sf), 20, 2, keep=terms.keep_terms(2)).select("term", "total")


_TOPW = """SELECT term, round(sum(weight) / (SELECT count(*) FROM bdocs WHERE split = 'train')::DOUBLE, 6) AS mean_weight FROM tfidf WHERE split = 'train'
  GROUP BY term ORDER BY mean_weight DESC, term LIMIT {k}"""


def _top_weights(spark, sf, k):
    train = _train(spark, sf)
    n = _count(train)
    means = rounded(terms.mean_weights(terms.tfidf_vectors(train, _vocab(train), "doc_id", n), n), "mean_weight")
    return means.orderBy(F.desc("mean_weight"), "term").limit(k)


@query("top_terms_tfidf", _TOPW.format(k=20), "tfidf", "bdocs")
def _(spark, sf):
    return _top_weights(spark, sf, 20)


@query("top_terms_difference", f"""+a AS (SELECT term FROM vocab ORDER BY total DESC, term LIMIT 10), b AS ({_TOPW.format(k=10)})
  SELECT term, 'counts' AS only_in FROM a WHERE term NOT IN (SELECT term FROM b) UNION ALL SELECT term, 'tfidf' FROM b WHERE term NOT IN (SELECT term FROM a)""", "vocab", "tfidf", "bdocs")
def _(spark, sf):
    return terms.top_difference(terms.vocabulary(_train(spark, sf), 10, 2, keep=terms.keep_terms(2)), _top_weights(spark, sf, 10))


@query("tf_density", """SELECT count(*) AS nnz, (SELECT count(*) FROM bdocs)::DOUBLE AS n_docs, (SELECT count(*) FROM vocab)::DOUBLE AS n_terms,
  round(count(*) / ((SELECT count(*) FROM bdocs) * (SELECT count(*) FROM vocab))::DOUBLE, 6) AS density FROM tf""", "tf", "bdocs", "vocab")
def _(spark, sf):
    d = binary_documents(spark, sf)
    vocab = _vocab(d.filter(F.col("split") == "train"))
    return rounded(terms.density(terms.count_vectors(d, vocab, "doc_id"), _count(d), _count(vocab)), "density")


@query("word_index", f"WITH wtok AS ({_WTOK}) SELECT term, n, word_id FROM ({_INDEX})")
def _(spark, sf):
    return terms.word_index(word_lists(table(spark, sf, "documents")), 5000).withColumn("word_id", F.col("word_id").cast("long"))


@query("token_sequences", f"""WITH wtok AS ({_WTOK}), idx AS ({_INDEX}), s AS (SELECT doc_id, list(coalesce(word_id, 1) ORDER BY pos) AS ids FROM wtok LEFT JOIN idx USING (term) GROUP BY doc_id)
  SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens, list_resize(ids[1:100], 100, 0)::INTEGER[] AS ids FROM s""")
def _(spark, sf):
    d = word_lists(table(spark, sf, "documents"))
    return terms.token_sequences(d, terms.word_index(d, 5000), "doc_id")


@query("term_class_topk", "SELECT * FROM (SELECT stars, term, n, word_class, row_number() OVER (PARTITION BY stars, word_class ORDER BY n DESC, term) AS rank FROM "
       "(SELECT stars, term, count(*) AS n FROM atok JOIN rtc USING (doc_id) GROUP BY ALL) JOIN wordclass USING (term)) WHERE rank <= 20", "atok", "rtc", "wordclass")
def _(spark, sf):
    return terms.term_class_topk(clean_reviews(spark, sf), WORD_CLASS, "stars", 20).withColumn("rank", F.col("rank").cast("long"))


view("mention", r"SELECT entity, lang AS label, count(*) AS n FROM (SELECT lang, unnest(regexp_extract_all(regexp_replace(text, '[\x{00C0}-\x{024F}]', '_', 'g'), '\b[A-Z][a-z]+(?: [A-Z][a-z]+)*\b')) AS entity FROM documents) GROUP BY ALL")


@query("entity_topk", """SELECT entity, CAST(sum(n) AS BIGINT) AS n, first(label ORDER BY n DESC, label) AS majority_label FROM mention GROUP BY entity
  ORDER BY n DESC, entity LIMIT 20""", "mention")
def _(spark, sf):
    return terms.entity_topk(terms.entity_mentions(table(spark, sf, "documents"), "lang"), 20)


@query("entity_majority_label", """SELECT entity, first(label ORDER BY n DESC, label) AS majority_label, max(n) AS n_majority, CAST(sum(n) AS BIGINT) AS n FROM mention GROUP BY entity""", "mention")
def _(spark, sf):
    return terms.entity_majority_label(terms.entity_mentions(table(spark, sf, "documents"), "lang"))


@query("entity_top10_by_star", r"""SELECT * FROM (SELECT stars, term, n, row_number() OVER (PARTITION BY stars ORDER BY n DESC, term) AS rank FROM (SELECT stars, term, count(*) AS n FROM
  (SELECT stars, unnest(regexp_extract_all(regexp_replace(text, '[\x{00C0}-\x{024F}]', '_', 'g'), '\b[A-Z][a-z]+(?: [A-Z][a-z]+)*\b')) AS term FROM rtc) GROUP BY ALL)) WHERE rank <= 10""", "rtc")
def _(spark, sf):
    from ratelens.functions.text import capitalised_spans

    return terms.topk_terms(clean_reviews(spark, sf), "stars", 10, capitalised_spans(F.col("text"))).withColumn("rank", F.col("rank").cast("long"))


@query("nb_log_prob", "SELECT term, round(log_prob_0, 6) AS log_prob_0, round(log_prob_1, 6) AS log_prob_1 FROM nb", "nb")
def _(spark, sf):
    train = _train(spark, sf)
    return rounded(terms.nb_log_prob(train, _vocab(train), "y", "doc_id"), "log_prob_0", "log_prob_1")


def _nb(spark, sf):
    d = binary_documents(spark, sf)
    train = d.filter(F.col("split") == "train")
    lp = terms.nb_log_prob(train, _vocab(train), "y", "doc_id")
    return d.filter(F.col("split") == "test"), lp, terms.nb_priors(train, "y")


@query("nb_predict", """SELECT doc_id, round(score_0, 4) AS score_0, round(score_1, 4) AS score_1, CASE WHEN score_1 > score_0 THEN 1 ELSE 0 END AS predicted
  FROM nbpred WHERE split = 'test'""", "nbpred")
def _(spark, sf):
    test, lp, priors = _nb(spark, sf)
    return rounded(terms.nb_predict(test, lp, priors, "doc_id"), "score_0", "score_1", digits=4)


@query("nb_metrics", metrics_sql("(SELECT y, CASE WHEN score_1 > score_0 THEN 1 ELSE 0 END AS p FROM nbpred WHERE split = 'test')", "y", "p"), "nbpred")
def _(spark, sf):
    test, lp, priors = _nb(spark, sf)
    p = terms.nb_predict(test, lp, priors, "doc_id").join(test.select("doc_id", "y"), "doc_id")
    return rounded(evaluation.binary_metrics(p, "y", "predicted"), *evaluation.METRICS)


@query("nb_tfidf_predict", """+w AS (SELECT t.doc_id, t.term, t.weight, b.y, b.split FROM tfidf t JOIN bdocs b ON t.doc_id = b.doc_id),
  p AS (SELECT v.term, coalesce(sum(w.weight) FILTER (WHERE w.y = 0), 0.0::DOUBLE) AS n0, coalesce(sum(w.weight) FILTER (WHERE w.y = 1), 0.0::DOUBLE) AS n1
    FROM vocab v LEFT JOIN (SELECT * FROM w WHERE split = 'train') w ON v.term = w.term GROUP BY v.term),
  l AS (SELECT term, ln((n0 + 1) / ((SELECT sum(n0) FROM p) + (SELECT count(*) FROM p))) AS l0, ln((n1 + 1) / ((SELECT sum(n1) FROM p) + (SELECT count(*) FROM p))) AS l1 FROM p),
  pr AS (SELECT ln(count(*) FILTER (WHERE y = 0) / count(*)::DOUBLE) AS p0, ln(count(*) FILTER (WHERE y = 1) / count(*)::DOUBLE) AS p1 FROM bdocs WHERE split = 'train'),
  s AS (SELECT b.doc_id, coalesce(sum(w.weight * l.l0), 0.0::DOUBLE) + any_value(p0) AS s0, coalesce(sum(w.weight * l.l1), 0.0::DOUBLE) + any_value(p1) AS s1
    FROM bdocs b CROSS JOIN pr LEFT JOIN w ON w.doc_id = b.doc_id LEFT JOIN l ON l.term = w.term WHERE b.split = 'test' GROUP BY b.doc_id)
  SELECT doc_id, round(s0, 4) AS score_0, round(s1, 4) AS score_1, CASE WHEN s1 > s0 THEN 1 ELSE 0 END AS predicted FROM s""", "tfidf", "vocab", "bdocs")
def _(spark, sf):
    d = binary_documents(spark, sf)
    train, test = d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")
    vocab = _vocab(train)
    vectors = terms.tfidf_vectors(d, vocab, "doc_id", _count(train))
    lp = terms.nb_weight_log_prob(vectors, train, vocab, "y", "doc_id")
    return rounded(terms.nb_weight_predict(test, vectors, lp, terms.nb_priors(train, "y"), "doc_id"), "score_0", "score_1", digits=4)


@query("tfidf_vectors_no_stop_words", """+k AS (SELECT b.doc_id, b.split, a.term FROM bdocs b JOIN atok a ON a.doc_id = b.doc_id WHERE length(a.term) >= 2),
  v AS (SELECT term, count(DISTINCT doc_id) AS df FROM k WHERE split = 'train' GROUP BY term HAVING count(DISTINCT doc_id) >= 2 ORDER BY count(*) DESC, term LIMIT 5000),
  f AS (SELECT doc_id, term, count(*) AS tf FROM k JOIN v USING (term) GROUP BY ALL),
  x AS (SELECT f.doc_id, f.term, tf, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM bdocs WHERE split = 'train')) / (1.0::DOUBLE + df)) + 1) AS w FROM f JOIN v USING (term))
  SELECT doc_id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM x""", "bdocs", "atok")
def _(spark, sf):
    d = binary_documents(spark, sf)
    train = d.filter(F.col("split") == "train")
    vocab = terms.vocabulary(train, 5000, 2, keep=lambda t: F.length(t) >= 2)
    return rounded(terms.tfidf_vectors(d, vocab, "doc_id", _count(train)), "weight")


@query("nb_top_terms", """SELECT class, term, round(log_prob, 6) AS log_prob, rank FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY log_prob DESC, term) AS rank FROM
  (SELECT 0 AS class, term, log_prob_0 AS log_prob FROM nb UNION ALL SELECT 1, term, log_prob_1 FROM nb)) WHERE rank <= 15""", "nb")
def _(spark, sf):
    _, lp, _ = _nb(spark, sf)
    return rounded(terms.nb_top_terms(lp), "log_prob").withColumn("rank", F.col("rank").cast("long"))


view("cw", """SELECT source, term, tf, tf * ln(1 + (SELECT sum(tf) / count(DISTINCT source)::DOUBLE FROM ct) / f) AS weight FROM ct JOIN (SELECT term, sum(tf)::DOUBLE AS f FROM ct GROUP BY term) USING (term)""", "ct")
view("ct", "SELECT source, term, count(*) AS tf FROM ctok JOIN documents USING (doc_id) GROUP BY ALL", "ctok")


@query("ctfidf_top_terms", """SELECT * FROM (SELECT source, term, tf, round(weight, 6) AS weight, row_number() OVER (PARTITION BY source ORDER BY round(weight, 6) DESC, term) AS rank FROM cw) WHERE rank <= 10""", "cw")
def _(spark, sf):
    w = rounded(terms.ctfidf(_docs(spark, sf), "source", keep=terms.keep_terms()), "weight")
    return terms.top_per_group(w, "source", "term", "weight", 10).withColumn("rank", F.col("rank").cast("long"))


@query("alpha_token_total", "SELECT d.lang, count(a.term) AS n FROM documents d LEFT JOIN atok a USING (doc_id) GROUP BY d.lang", "atok")
def _(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.sum(F.size(alpha_tokens(F.col("text"))).cast("long")).alias("n"))
