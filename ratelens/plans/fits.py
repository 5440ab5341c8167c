"""Model fits (inventory 2.12) and the scorer extension point."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelens.operators import models, scoring, terms
from ratelens.operators.features import feature_matrix, with_divergence
from ratelens.plans.registry import query
from ratelens.plans.views import (
    binary_documents,
    clean_reviews,
    number_features,
    number_reviews,
    number_topics,
    rounded,
    scored_numbers,
    table,
)


@query("suspicion_gbt", """SELECT CAST(ceil(0.2 * count(*) FILTER (WHERE suspicious = 1)) + ceil(0.2 * count(*) FILTER (WHERE suspicious = 0)) AS BIGINT) AS n, true AS label_is_learned,
  (SELECT count(*) FROM (SELECT business_id FROM rns GROUP BY business_id HAVING count(review_id) >= 10)) AS n_businesses, true AS gap_in_range FROM rns""", "rns")
def _(spark, sf):
    """Fit on the training part, score every review, report the test part and the trust score's extremes."""
    scored, _, metrics = models.fit_and_score(number_features(spark, sf))
    by = scoring.trust_score(scored, ordered=False)
    top = by.agg(F.max("manipulation_delta").alias("m")).scalar()
    n = by.agg(F.count("*").alias("n")).scalar()
    return metrics.select("n", (F.col("accuracy") > 0.95).alias("label_is_learned")).withColumns({"n_businesses": n, "gap_in_range": F.coalesce(top.between(-4.0, 4.0), F.lit(True))})


@query("degenerate_fallback", """SELECT business_id, count(*) AS review_count, round(avg(stars), 6) AS raw_avg_stars, 0.0::DOUBLE AS suspicion_pct, 0.0::DOUBLE AS mean_suspicion_score,
  round(avg(stars), 6) AS adjusted_stars, 0.0::DOUBLE AS manipulation_delta FROM rn GROUP BY business_id HAVING count(*) >= 10""", "rn")
def _(spark, sf):
    """With a threshold no review can exceed there is one class, no model, and the label is the score."""
    f = feature_matrix(with_divergence(number_reviews(spark, sf), threshold=2.0), number_topics(spark, sf), threshold=2.0, need=("stars",))
    scored, _, _ = models.fit_and_score(f)
    return rounded(scoring.trust_score(scored, ordered=False), "raw_avg_stars", "adjusted_stars", "manipulation_delta")


@query("feature_importance", "SELECT 9::BIGINT AS n_features, count(*) AS n_rows, true AS sums_to_one, true AS divergence_is_first FROM rn", "rn")
def _(spark, sf):
    scored, model, _ = models.fit_and_score(number_features(spark, sf))
    ranked = models.feature_importance(scored, model)
    return ranked.agg(
        F.count("*").alias("n_features"), F.max("n_rows").alias("n_rows"), (F.abs(F.sum("importance") - 1.0) < 1e-9).alias("sums_to_one"),
        (F.max_by("feature", "importance") == "sentiment_star_divergence").alias("divergence_is_first"))


def _train_test(spark, sf):
    d = binary_documents(spark, sf, lambda text: terms.clean_tokens(text, 2))
    return d.filter(F.col("split") == "train"), d.filter(F.col("split") == "test")


@query("linear_svm", "SELECT count(*) AS n, true AS in_range FROM bdocs WHERE split = 'test'", "bdocs")
def _(spark, sf):
    m = models.linear_svm(*_train_test(spark, sf), "tokens", "y")
    return m.select("n", (F.col("accuracy").between(0.0, 1.0) & F.col("f1").between(0.0, 1.0)).alias("in_range"))


@query("linear_svm_tfidf", "SELECT count(*) AS n, true AS in_range FROM bdocs WHERE split = 'test'", "bdocs")
def _(spark, sf):
    m = models.linear_svm(*_train_test(spark, sf), "tokens", "y", idf=True)
    return m.select("n", (F.col("accuracy").between(0.0, 1.0) & F.col("f1").between(0.0, 1.0)).alias("in_range"))


@query("logreg_fit", """SELECT count(*) AS n, true AS loss_falls, true AS loss_is_small, true AS sign_is_right FROM rn""", "rn")
def _(spark, sf):
    """Whether the loss falls at every step and ends below that of no model, and far apart sentiment raises the odds."""
    data = scored_numbers(spark, sf).withColumn("gap", F.abs(F.col("vader_compound") - (F.col("stars") - 3) / F.lit(2.0)))
    model = models.logistic_fit(data, ["gap"], "suspicious")
    loss = list(model.summary.objectiveHistory)
    falls = all(b <= a + 1e-12 for a, b in zip(loss, loss[1:]))
    return data.agg(F.count("*").alias("n")).select(
        "n", F.lit(falls).alias("loss_falls"), F.lit(loss[-1] < 0.5 * loss[0]).alias("loss_is_small"), F.lit(float(model.coefficients[0]) > 0).alias("sign_is_right"))


@query("linreg_fit", """SELECT count(*) AS n, round(regr_slope(l_extendedprice / 100000.0, l_quantity / 50.0), 4) AS slope,
  round(regr_intercept(l_extendedprice / 100000.0, l_quantity / 50.0), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 4) AS r2 FROM lineitem""")
def _(spark, sf):
    data = table(spark, sf, "lineitem").select((F.col("l_quantity") / 50.0).alias("x"), (F.col("l_extendedprice") / 100000.0).alias("y"))
    model = models.linear_fit(data, ["x"], "y")
    return data.agg(F.count("*").alias("n")).select(
        "n", F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"), F.round(F.lit(float(model.intercept)), 4).alias("intercept"),
        F.round(F.lit(float(model.summary.r2)), 4).alias("r2"))


@query("linreg_closed_form", """SELECT count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""")
def _(spark, sf):
    out = models.linear_closed_form(table(spark, sf, "lineitem"), F.col("l_quantity"), F.col("l_extendedprice"))
    return rounded(rounded(out, "slope", "intercept", digits=4), "r2")


@query("lda_topics", "SELECT k, k::BIGINT AS n_topics, 5 AS n_words, true AS fits FROM (VALUES (5), (10), (15), (20)) AS t(k) WHERE (SELECT count(*) FROM rtc) > 0", "rtc")
def _(spark, sf):
    d = clean_reviews(spark, sf).select(terms.clean_tokens(F.col("text")).alias("tokens"))
    found = spark.createDataFrame(models.lda_topics(d, "tokens", (5, 10, 15, 20)), "k int, log_perplexity double, topic int, words array<string>")
    return found.groupBy("k").agg(F.count("*").alias("n_topics"), F.min(F.size("words")).alias("n_words"), (F.min("log_perplexity") > 0).alias("fits"))
