"""Aggregations, rankings, set operations and scalar functions (inventory 2.4 - 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelens.functions import labels as lab
from ratelens.functions import text as tx
from ratelens.functions.numbers import decimal_text, round_half_even_exact
from ratelens.functions.sentiment import normalised_stars
from ratelens.operators import distributions, evaluation, profile, sampling, scoring
from ratelens.plans.registry import query, view
from ratelens.plans.views import (
    clean_reviews,
    day,
    dec_text_sql,
    document_topics,
    number_features,
    number_reviews,
    number_topics,
    predictions,
    py_round_sql,
    rounded,
    ruled_features,
    scored_numbers,
    scored_text,
    table,
    text_features,
    text_reviews,
)
from ratelens.session import materialise

_W = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))"


@query("corpus_summary", f"""SELECT count(*) AS n_reviews, count(DISTINCT business_id) AS n_businesses, count(DISTINCT user_id) AS n_users,
  round(avg(stars), 6) AS mean_stars, round(avg(w), 6) AS mean_words, median(w)::DOUBLE AS median_words, max(w) AS max_words,
  round(avg(useful), 6) AS mean_useful, strftime(min(date), '%Y-%m-%d') AS date_min, strftime(max(date), '%Y-%m-%d') AS date_max
  FROM (SELECT *, {_W} AS w FROM rtc)""", "rtc")
def _(spark, sf):
    return rounded(profile.corpus_summary(clean_reviews(spark, sf)), "mean_stars", "mean_words", "mean_useful")


@query("distinct_counts", """SELECT count(DISTINCT business_id) AS n_business_id, count(DISTINCT user_id) AS n_user_id,
  count(DISTINCT review_id) AS n_review_id FROM rn""", "rn")
def _(spark, sf):
    return profile.distinct_counts(number_reviews(spark, sf), ["business_id", "user_id", "review_id"])


@query("distinct_counts_sketch", "SELECT true AS n_business_id, true AS n_user_id, true AS n_review_id FROM (SELECT count(*) AS n FROM rn) WHERE n > 0", "rn")
def _(spark, sf):
    """Whether the sketch is within a tenth of the exact counts."""
    columns, rows = ["business_id", "user_id", "review_id"], number_reviews(spark, sf)
    near = profile.approx_distinct_counts(rows, columns).select(F.struct("*").alias("near")).scalar()
    exact = rows.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns]).withColumn("near", near)
    return exact.select(*[(F.abs(F.col(f"near.n_{c}") - F.col(f"n_{c}")) <= 0.1 * F.col(f"n_{c}")).alias(f"n_{c}") for c in columns])


@query("token_vocab_size", r"""SELECT count(*) AS n_tokens, count(DISTINCT t) AS vocabulary FROM
  (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS t FROM documents) WHERE t <> ''""")
def _(spark, sf):
    return profile.token_vocab_size(table(spark, sf, "documents"))


@query("star_distribution", "SELECT stars, count(*) AS n FROM rtc GROUP BY stars ORDER BY stars", "rtc")
def _(spark, sf):
    return profile.value_counts(clean_reviews(spark, sf), "stars")


@query("star_sentiment_counts", "SELECT stars, CASE WHEN stars > 3 THEN 1 ELSE 0 END AS sentiment, count(*) AS n FROM rn WHERE stars <> 3 GROUP BY ALL", "rn")
def _(spark, sf):
    r = number_reviews(spark, sf).filter(F.col("stars") != 3).withColumn("sentiment", (F.col("stars") > 3).cast("int"))
    return profile.value_counts(r, "stars", "sentiment")


@query("topic_star_counts", "SELECT topic_id, stars, count(*) AS n FROM nfeat GROUP BY ALL", "nfeat")
def _(spark, sf):
    return profile.value_counts(number_features(spark, sf), "topic_id", "stars", ordered=False)


@query("useful_by_star", "SELECT stars, round(avg(useful), 6) AS mean_useful, count(useful) AS n FROM rn GROUP BY stars", "rn")
def _(spark, sf):
    return rounded(profile.mean_by(number_reviews(spark, sf), "stars", F.col("useful"), "mean_useful"), "mean_useful")


@query("divergence_by_star", """SELECT stars, round(avg(sentiment_star_divergence), 6) AS mean_divergence, count(sentiment_star_divergence) AS n
  FROM scored GROUP BY stars""", "scored")
def _(spark, sf):
    return rounded(profile.mean_by(scored_text(spark, sf), "stars", F.col("sentiment_star_divergence"), "mean_divergence"), "mean_divergence")


@query("suspicious_rate_by_star", "SELECT stars, round(avg(suspicious), 6) AS rate, count(*) AS n FROM rns GROUP BY stars", "rns")
def _(spark, sf):
    return rounded(profile.mean_by(scored_numbers(spark, sf), "stars", F.col("suspicious"), "rate"), "rate")


@query("outlier_rate_by_business", "SELECT business_id, round(avg(is_topic_outlier), 6) AS outlier_rate, count(*) AS n FROM nfeat GROUP BY business_id", "nfeat")
def _(spark, sf):
    return rounded(profile.mean_by(number_features(spark, sf), "business_id", F.col("is_topic_outlier"), "outlier_rate"), "outlier_rate")


@query("business_date_range", """SELECT business_id, strftime(min(date), '%Y-%m-%d') AS date_min, strftime(max(date), '%Y-%m-%d') AS date_max
  FROM rn GROUP BY business_id""", "rn")
def _(spark, sf):
    return profile.date_range_by(number_reviews(spark, sf)).select("business_id", day("date_min").alias("date_min"), day("date_max").alias("date_max"))


@query("weighted_mean_fallback", """SELECT user_id, round(CASE WHEN sum(1 - suspicious) > 0 THEN sum(stars * (1 - suspicious))::DOUBLE / nullif(sum(1 - suspicious), 0)
  ELSE avg(stars) END, 6) AS weighted, sum(1 - suspicious) = 0 AS fell_back FROM rns GROUP BY user_id""", "rns")
def _(spark, sf):
    w = 1.0 - F.col("suspicious").cast("double")
    return rounded(scored_numbers(spark, sf).groupBy("user_id").agg(
        scoring.weighted_mean(F.col("stars").cast("double"), w).alias("weighted"), (F.sum(w) == 0).alias("fell_back")
    ), "weighted")


_TRUST = """SELECT business_id, review_count, round(raw_avg_stars, 6) AS raw_avg_stars, round(suspicion_pct, 6) AS suspicion_pct,
  round(mean_suspicion_score, 6) AS mean_suspicion_score, round(adjusted_stars, 6) AS adjusted_stars, round(manipulation_delta, 6) AS manipulation_delta FROM {}"""
_TRUST_COLS = ("raw_avg_stars", "suspicion_pct", "mean_suspicion_score", "adjusted_stars", "manipulation_delta")


@query("trust_score", _TRUST.format("rtrust"), "rtrust")
def _(spark, sf):
    """The flagship: rule-based sentiment, divergence flag as score, trust-weighted rating per business."""
    return rounded(scoring.trust_score(scoring.label_as_score(ruled_features(spark, sf))), *_TRUST_COLS)


@query("trust_score_volume", _TRUST.format("ntrust"), "ntrust")
def _(spark, sf):
    return rounded(scoring.trust_score(scoring.label_as_score(number_features(spark, sf))), *_TRUST_COLS)


@query("top10_manipulated", _TRUST.format("ntrust") + " ORDER BY ntrust.manipulation_delta DESC, business_id LIMIT 10", "ntrust")
def _(spark, sf):
    by = scoring.trust_score(scoring.label_as_score(number_features(spark, sf)), ordered=False)
    return rounded(scoring.top_by_delta(by), *_TRUST_COLS)


@query("anchor_scores", """SELECT business_id, count(review_id) AS review_count, round(avg(stars), 6) AS raw_avg_stars,
  round(CASE WHEN sum(1 - suspicious) > 0 THEN sum(stars * (1 - suspicious))::DOUBLE / nullif(sum(1 - suspicious), 0) ELSE avg(stars) END, 6) AS adjusted_stars,
  round(avg(suspicious) * 100, 6) AS suspicious_review_pct, round(avg(sentiment_star_divergence), 6) AS mean_divergence,
  strftime(min(date), '%Y-%m-%d') AS date_min, strftime(max(date), '%Y-%m-%d') AS date_max FROM scored GROUP BY business_id HAVING count(review_id) >= 10""", "scored")
def _(spark, sf):
    out = scoring.first_order_scores(scored_text(spark, sf))
    return rounded(out, "raw_avg_stars", "adjusted_stars", "suspicious_review_pct", "mean_divergence").withColumns(
        {"date_min": day("date_min"), "date_max": day("date_max")}
    )


@query("headline_pct", "SELECT count(*) AS n, CAST(sum(suspicious) AS BIGINT) AS n_flagged, round(avg(suspicious) * 100, 6) AS pct FROM scored", "scored")
def _(spark, sf):
    return rounded(profile.share_over(scored_text(spark, sf), F.col("suspicious")), "pct")


@query("class_balance", "SELECT suspicious, count(*) AS n, round(count(*) / (SELECT count(*) FROM rns)::DOUBLE, 6) AS share FROM rns GROUP BY suspicious", "rns")
def _(spark, sf):
    return rounded(profile.class_balance(scored_numbers(spark, sf), "suspicious"), "share")


_REVIEW_TYPES = (("doc_id", "bigint"), ("review_id", "string"), ("user_id", "string"), ("business_id", "string"), ("stars", "int"), ("useful", "int"),
                 ("funny", "int"), ("cool", "int"), ("text", "string"), ("date", "timestamp_ntz"))


@query("schema_report", "SELECT (SELECT count(*) FROM rt) AS n_rows, * FROM (VALUES " + ", ".join(
    f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(_REVIEW_TYPES)) + ") AS t(position, column_name, data_type)", "rt")
def _(spark, sf):
    return profile.schema_report(text_reviews(spark, sf))


_REVIEW_COLUMNS = ("review_id", "user_id", "business_id", "stars", "useful", "funny", "cool", "text", "date")


@query("null_counts", "SELECT u.column_name, u.n_null FROM (SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _REVIEW_COLUMNS)
       + f" FROM rt) UNPIVOT (n_null FOR column_name IN ({', '.join(_REVIEW_COLUMNS)})) AS u", "rt")
def _(spark, sf):
    return profile.null_counts(text_reviews(spark, sf).select(*_REVIEW_COLUMNS))


def _describe(c: str, source: str) -> str:
    return f"""SELECT '{c}' AS column_name, count({c}) AS n_values, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min,
  quantile_cont({c}::DOUBLE, 0.25) AS p25, quantile_cont({c}::DOUBLE, 0.5) AS p50, quantile_cont({c}::DOUBLE, 0.75) AS p75, max({c})::DOUBLE AS max FROM {source}"""


_DESCRIBED = ("stars", "useful", "funny", "cool", "review_length_words", "vader_compound", "sentiment_star_divergence")


@query("describe_numeric", "SELECT column_name, n_values, mean, std, min, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, round(max, 6) AS max FROM ("
       + " UNION ALL ".join(_describe(c, "rns") for c in _DESCRIBED) + ")", "rns")
def _(spark, sf):
    return rounded(distributions.describe_numeric(scored_numbers(spark, sf), _DESCRIBED), "mean", "std", "p25", "p50", "p75", "max")


def _describe_text(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, (SELECT count({c}) FROM rtd) AS n_values, (SELECT count(DISTINCT {c}) FROM rtd) AS n_unique, {c} AS top_value, n AS freq
  FROM (SELECT {c}, count(*) AS n FROM rtd GROUP BY {c} ORDER BY n DESC, {c} LIMIT 1)"""


view("rtd", "SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM rt", "rt")


@query("describe_string", " UNION ALL ".join(f"SELECT * FROM ({_describe_text(c)})" for c in ("review_id", "user_id", "business_id", "text", "date")), "rtd")
def _(spark, sf):
    reviews = text_reviews(spark, sf).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return profile.describe_string(reviews, ["review_id", "user_id", "business_id", "text", "date"])


@query("length_stats", f"""SELECT round(avg(w), 6) AS mean_words, median(w)::DOUBLE AS median_words, min(w) AS min_words, max(w) AS max_words,
  round(stddev_samp(w), 6) AS std_words FROM (SELECT {_W} AS w FROM documents)""")
def _(spark, sf):
    return rounded(profile.length_stats(table(spark, sf, "documents")), "mean_words", "std_words")


def _hist(source: str, x: str, bins: int, group: str = "", bounds: str | None = None) -> str:
    g = f"{group}, " if group else ""
    lohi = bounds or "(SELECT min(x) FROM d) AS lo, (SELECT max(x) FROM d) AS hi"
    spine = f"(SELECT DISTINCT {group} FROM d) g, " if group else ""
    on = f" AND c.{group} = g.{group}" if group else ""
    gs = f"g.{group}, " if group else ""
    return f"""+d AS (SELECT {g}({x})::DOUBLE AS x FROM {source}), b AS (SELECT {lohi}),
  c AS (SELECT {g}CAST(least(floor((x - lo) / ((hi - lo) / {bins}.0::DOUBLE)), {bins - 1}) AS INTEGER) AS bin, count(*) AS n FROM d, b GROUP BY ALL)
  SELECT {gs}s.bin, round(lo + (hi - lo) / {bins}.0::DOUBLE * s.bin, 6) AS bin_lo, round(lo + (hi - lo) / {bins}.0::DOUBLE * (s.bin + 1), 6) AS bin_hi,
  coalesce(c.n, 0) AS n FROM b, {spine}(SELECT unnest(range(0, {bins}))::INTEGER AS bin) s LEFT JOIN c ON c.bin = s.bin{on}"""


@query("histogram_length", _hist("rtc", f"least({_W}, 500)", 40), "rtc")
def _(spark, sf):
    lengths = materialise(clean_reviews(spark, sf).select(tx.word_count(F.col("text")).alias("w")), "lengths")
    h = distributions.histogram(lengths, F.col("w"), 40, upper=500)
    return rounded(h, "bin_lo", "bin_hi")


@query("histogram_divergence", _hist("rns", "sentiment_star_divergence", 50), "rns")
def _(spark, sf):
    return rounded(distributions.histogram(scored_numbers(spark, sf), F.col("sentiment_star_divergence"), 50), "bin_lo", "bin_hi")


@query("histogram_per_business", _hist("(SELECT user_id, count(*) AS n FROM rn GROUP BY 1)", "n", 60), "rn")
def _(spark, sf):
    sizes = number_reviews(spark, sf).groupBy("user_id").agg(F.count("*").alias("n"))
    return rounded(distributions.histogram(sizes, F.col("n"), 60), "bin_lo", "bin_hi")


@query("histogram_score_by_star", _hist("rn", "vader_compound", 30, "stars", "-1.0::DOUBLE AS lo, 1.0::DOUBLE AS hi"), "rn")
def _(spark, sf):
    return rounded(distributions.histogram(number_reviews(spark, sf), F.col("vader_compound"), 30, bounds=(-1, 1), group="stars"), "bin_lo", "bin_hi")


@query("boxplot_by_star", f"""+d AS (SELECT stars, {_W} AS w FROM rtc), q AS (SELECT stars, quantile_cont(w::DOUBLE, 0.25) AS q1, quantile_cont(w::DOUBLE, 0.5) AS med,
  quantile_cont(w::DOUBLE, 0.75) AS q3 FROM d GROUP BY stars)
  SELECT d.stars, round(q1, 6) AS q1, round(med, 6) AS med, round(q3, 6) AS q3, min(w) FILTER (WHERE w BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::DOUBLE AS whisker_lo,
  max(w) FILTER (WHERE w BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::DOUBLE AS whisker_hi,
  count(*) FILTER (WHERE NOT (w BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers FROM d JOIN q USING (stars) GROUP BY d.stars, q1, med, q3""", "rtc")
def _(spark, sf):
    d = materialise(clean_reviews(spark, sf).select("stars", tx.word_count(F.col("text")).alias("w")), "lengths")
    return rounded(distributions.boxplot(d, "stars", "w", bounded_groups=True), "q1", "med", "q3")


@query("reviews_per_user", "SELECT user_id, count(*) AS n FROM rn GROUP BY user_id", "rn")
def _(spark, sf):
    return profile.value_counts(number_reviews(spark, sf), "user_id", ordered=False)


@query("avg_stars_per_business", "SELECT business_id, round(avg(stars), 6) AS mean_stars, count(stars) AS n FROM rn GROUP BY business_id", "rn")
def _(spark, sf):
    return rounded(profile.mean_by(number_reviews(spark, sf), "business_id", F.col("stars"), "mean_stars"), "mean_stars")


@query("monthly_volume", """+m AS (SELECT date_trunc('month', date)::DATE AS month, count(*) AS n FROM rt GROUP BY 1),
  s AS (SELECT unnest(generate_series((SELECT min(month) FROM m)::TIMESTAMP, (SELECT max(month) FROM m)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month)
  SELECT last_day(s.month) AS month_end, coalesce(m.n, 0) AS n FROM s LEFT JOIN m ON m.month = s.month""", "rt")
def _(spark, sf):
    return profile.monthly_volume(text_reviews(spark, sf))


@query("monthly_volume_sparse", """+m AS (SELECT date_trunc('month', o_orderdate + to_months(CAST(month(o_orderdate) % 2 AS INTEGER)))::DATE AS month, count(*) AS n FROM orders GROUP BY 1),
  s AS (SELECT unnest(generate_series((SELECT min(month) FROM m)::TIMESTAMP, (SELECT max(month) FROM m)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month)
  SELECT last_day(s.month) AS month_end, coalesce(m.n, 0) AS n FROM s LEFT JOIN m ON m.month = s.month""".replace("+m", "WITH m", 1))
def _(spark, sf):
    """Orders of odd months are booked a month later, so odd months are empty and must show 0."""
    orders = table(spark, sf, "orders")
    return profile.monthly_volume(orders.withColumn("booked", F.add_months("o_orderdate", F.month("o_orderdate") % 2)), "booked")


@query("topic_monthly", """SELECT date_trunc('month', date)::DATE AS month, topic_id, count(*) AS n FROM nfeat WHERE topic_id IN
  (SELECT topic_id FROM nfeat WHERE topic_id <> -1 GROUP BY topic_id ORDER BY count(*) DESC, topic_id LIMIT 6) GROUP BY ALL""", "nfeat")
def _(spark, sf):
    from ratelens.operators import lookups, topics

    f = number_features(spark, sf).select("topic_id", "date")
    return profile.category_monthly(lookups.members(f, topics.topic_info(f).limit(6), "topic_id"), "topic_id")


@query("topic_star_dense", """+t AS (SELECT topic_id FROM nfeat WHERE topic_id <> -1 GROUP BY topic_id ORDER BY count(*) DESC, topic_id LIMIT 6),
  c AS (SELECT topic_id, stars, count(*) AS n FROM nfeat GROUP BY ALL)
  SELECT t.topic_id, s.stars, coalesce(c.n, 0) AS n FROM t, (SELECT unnest(range(1, 6))::INTEGER AS stars) s LEFT JOIN c ON c.topic_id = t.topic_id AND c.stars = s.stars""", "nfeat")
def _(spark, sf):
    from ratelens.operators import lookups, topics

    f = number_features(spark, sf).select("topic_id", "stars")
    top = topics.topic_info(f).limit(6).select("topic_id")
    counts = profile.value_counts(lookups.members(f, top, "topic_id"), "topic_id", "stars", ordered=False)
    spine = top.select("topic_id", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("stars"))
    return lookups.densify(counts, spine, ["topic_id", "stars"], "n").select("topic_id", "stars", "n")


_M = """count(*) AS n, count(*) FILTER (WHERE {y} = {p}) / count(*)::DOUBLE AS accuracy,
  coalesce(count(*) FILTER (WHERE {y} = 1 AND {p} = 1) / nullif(count(*) FILTER (WHERE {p} = 1), 0)::DOUBLE, 0.0::DOUBLE) AS precision,
  coalesce(count(*) FILTER (WHERE {y} = 1 AND {p} = 1) / nullif(count(*) FILTER (WHERE {y} = 1), 0)::DOUBLE, 0.0::DOUBLE) AS recall,
  coalesce(2 * count(*) FILTER (WHERE {y} = 1 AND {p} = 1) / nullif(count(*) FILTER (WHERE {y} = 1) + count(*) FILTER (WHERE {p} = 1), 0)::DOUBLE, 0.0::DOUBLE) AS f1"""
_R = "round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1"


def metrics_sql(source: str, y: str, p: str) -> str:
    return f"SELECT n, {_R} FROM (SELECT {_M.format(y=y, p=p)} FROM {source})"


@query("confusion_matrix", """SELECT a.v AS y_true, b.v AS y_pred, coalesce(n, 0) AS n FROM (VALUES (-1), (0), (1)) AS a(v), (VALUES (-1), (0), (1)) AS b(v)
  LEFT JOIN (SELECT y_true, coalesce(y_pred, -1) AS y_pred, count(*) AS n FROM preds GROUP BY ALL) c ON c.y_true = a.v AND c.y_pred = b.v""", "preds")
def _(spark, sf):
    return evaluation.confusion_matrix(predictions(spark, sf), "y_true", "y_pred", [-1, 0, 1])


@query("binary_metrics", metrics_sql("preds", "y_true", "y_other"), "preds")
def _(spark, sf):
    return rounded(evaluation.binary_metrics(predictions(spark, sf), "y_true", "y_other"), *evaluation.METRICS)


@query("valid_only_metrics", "SELECT *, (SELECT count(*) FROM preds) AS n_total FROM (" + metrics_sql("(SELECT * FROM preds WHERE y_pred IS NOT NULL)", "y_true", "y_pred") + ")", "preds")
def _(spark, sf):
    return rounded(evaluation.valid_only_metrics(predictions(spark, sf), "y_true", "y_pred"), *evaluation.METRICS)


@query("classification_report", """+p AS (SELECT y_true AS y, y_pred AS p FROM preds WHERE y_pred IS NOT NULL), per AS (
  SELECT c AS class, coalesce((SELECT count(*) FROM p WHERE y = c AND p.p = c) / nullif((SELECT count(*) FROM p WHERE p.p = c), 0)::DOUBLE, 0.0::DOUBLE) AS precision,
    coalesce((SELECT count(*) FROM p WHERE y = c AND p.p = c) / nullif((SELECT count(*) FROM p WHERE y = c), 0)::DOUBLE, 0.0::DOUBLE) AS recall,
    (SELECT count(*) FROM p WHERE y = c) AS support, (SELECT count(*) FROM p WHERE y = c AND p.p = c) AS tp FROM (VALUES (0), (1)) AS v(c)),
  full_ AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0::DOUBLE END AS f1 FROM per),
  out_ AS (SELECT class::VARCHAR AS class, precision, recall, f1, support FROM full_
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support)::DOUBLE, sum(tp) / sum(support)::DOUBLE, sum(tp) / sum(support)::DOUBLE, sum(support)::BIGINT FROM full_
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM full_
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support)::DOUBLE, sum(recall * support) / sum(support)::DOUBLE, sum(f1 * support) / sum(support)::DOUBLE, sum(support)::BIGINT FROM full_)
  SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM out_""", "preds")
def _(spark, sf):
    p = predictions(spark, sf).filter(F.col("y_pred").isNotNull())
    return rounded(evaluation.classification_report(p, "y_true", "y_pred"), "precision", "recall", "f1")


@query("metric_delta", f"""+a AS ({metrics_sql("preds", "y_true", "y_other")}), b AS ({metrics_sql("(SELECT * FROM preds WHERE y_pred IS NOT NULL)", "y_true", "y_pred")}),
  ua AS (UNPIVOT (SELECT accuracy, precision, recall, f1 FROM a) ON accuracy, precision, recall, f1 INTO NAME metric VALUE v),
  ub AS (UNPIVOT (SELECT accuracy, precision, recall, f1 FROM b) ON accuracy, precision, recall, f1 INTO NAME metric VALUE v)
  SELECT metric, ua.v AS before, ub.v AS after, round(ub.v - ua.v, 6) AS delta FROM ua JOIN ub USING (metric)""", "preds")
def _(spark, sf):
    p = predictions(spark, sf)
    a = rounded(evaluation.binary_metrics(p, "y_true", "y_other"), *evaluation.METRICS)
    b = rounded(evaluation.binary_metrics(p.filter(F.col("y_pred").isNotNull()), "y_true", "y_pred"), *evaluation.METRICS)
    return rounded(evaluation.metric_delta(a, b), "delta")


@query("scoreboard", f"""+r AS (SELECT 'cached' AS run, * FROM ({metrics_sql("(SELECT * FROM preds WHERE y_pred IS NOT NULL)", "y_true", "y_pred")})
  UNION ALL SELECT 'comparator', * FROM ({metrics_sql("preds", "y_true", "y_other")})
  UNION ALL SELECT 'always positive', * FROM ({metrics_sql("preds", "y_true", "1")}))
  SELECT run, accuracy, f1, round((SELECT max(accuracy) FROM r) - accuracy, 6) AS gap_to_best, accuracy = (SELECT max(accuracy) FROM r) AS is_best FROM r""", "preds")
def _(spark, sf):
    p = predictions(spark, sf).withColumn("one", F.lit(1))
    runs = [("cached", p.filter(F.col("y_pred").isNotNull()), "y_pred"), ("comparator", p, "y_other"), ("always positive", p, "one")]
    out = None
    for name, df, c in runs:
        m = rounded(evaluation.binary_metrics(df, "y_true", c), *evaluation.METRICS).withColumn("run", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return rounded(evaluation.scoreboard(out), "gap_to_best")


@query("agreement_rate", """SELECT count(*) AS n, round(avg(CASE WHEN primary_label IS NOT NULL AND primary_label = comparator_label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS agreement_rate
  FROM cache WHERE ord = 0""", "cache")
def _(spark, sf):
    from ratelens.plans.views import label_cache

    return rounded(evaluation.agreement_rate(label_cache(spark, sf).filter(F.col("ord") == 0), "multi_model_agreement"), "agreement_rate")


@query("log_loss", """SELECT count(*) AS n, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS log_loss FROM (SELECT suspicious::DOUBLE AS y,
  greatest(1e-15::DOUBLE, least(1 - 1e-15::DOUBLE, (vader_compound + 1) / 2.0::DOUBLE)) AS p FROM rns)""", "rns")
def _(spark, sf):
    p = (F.col("vader_compound") + 1.0) / F.lit(2.0)
    return rounded(evaluation.log_loss(scored_numbers(spark, sf), F.col("suspicious"), p), "log_loss")


@query("mse_r2", """SELECT count(*) AS n, round(avg(e * e), 6) AS mse, round(1 - avg(e * e) / var_pop(y), 6) AS r2
  FROM (SELECT stars::DOUBLE AS y, stars::DOUBLE - (vader_compound * 2 + 3) AS e FROM rns)""", "rns")
def _(spark, sf):
    return rounded(evaluation.mse_r2(scored_numbers(spark, sf), F.col("stars"), F.col("vader_compound") * 2.0 + 3.0), "mse", "r2")


@query("head_preview", """SELECT review_id, stars, CASE WHEN length(text) > 120 THEN substr(text, 1, 120) || '...' ELSE text END AS preview FROM rtc ORDER BY review_id LIMIT 5""", "rtc")
def _(spark, sf):
    return clean_reviews(spark, sf).orderBy("review_id").limit(5).select("review_id", "stars", tx.preview(F.col("text"), 120).alias("preview"))


@query("top100_volume", "SELECT business_id, review_count FROM ntrust ORDER BY review_count DESC, business_id LIMIT 100", "ntrust")
def _(spark, sf):
    by = scoring.trust_score(scoring.label_as_score(number_features(spark, sf)), ordered=False)
    return scoring.top_by_volume(by).select("business_id", "review_count")


@query("coverage_union", "SELECT business_id, review_count, round(manipulation_delta, 6) AS manipulation_delta, covered_by FROM ncovered", "ncovered")
def _(spark, sf):
    by = scoring.trust_score(scoring.label_as_score(number_features(spark, sf)), ordered=False)
    return rounded(scoring.coverage(by).select("business_id", "review_count", "manipulation_delta", "covered_by"), "manipulation_delta")


@query("normalized_stars", "SELECT review_id, stars, normalized_stars FROM rns", "rns")
def _(spark, sf):
    return number_reviews(spark, sf).select("review_id", "stars", normalised_stars(F.col("stars")).alias("normalized_stars"))


@query("scalar_math", f"""SELECT o_orderkey, abs(o_custkey - o_orderkey) AS gap, least(o_totalprice, 250000.0::DOUBLE) AS clipped,
  {py_round_sql('o_totalprice / 16.0::DOUBLE', 2)} AS rounded, {dec_text_sql(py_round_sql('o_totalprice / 16.0::DOUBLE', 2), 2)} AS rounded_text FROM orders""")
def _(spark, sf):
    r = round_half_even_exact("o_totalprice / 16D", 2)
    return table(spark, sf, "orders").select(
        "o_orderkey", F.abs(F.col("o_custkey") - F.col("o_orderkey")).alias("gap"),
        F.least("o_totalprice", F.lit(250000.0)).alias("clipped"), F.expr(r).alias("rounded"), F.expr(decimal_text(r, 2)).alias("rounded_text"),
    )


@query("word_count", f"SELECT doc_id, CAST({_W} AS INTEGER) AS n_words FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.word_count(F.col("text")).alias("n_words"))


@query("clean_text", r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(lower(text), '[^a-z\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS cleaned_md5 FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(tx.clean_text(F.col("text"))).alias("cleaned_md5"))


# Answers appended to the conversation text so that every branch of the parsers occurs.
_ANSWERS = ["Positive", "neg", "positive or negative", "1", "maybe", "", "POS\nnegative", "rating: 0", "0 or 1", "It is negative."]
_PICK = "[" + ", ".join("'" + a.replace("\n", "' || chr(10) || '") + "'" for a in _ANSWERS) + "]"
_ANSWER_SQL = f"SELECT conv_id, turn, {_PICK}[CAST((conv_id * 7 + turn) % {len(_ANSWERS)} AS INTEGER) + 1] || CASE WHEN role = 'user' THEN ' ' || text ELSE '' END AS answer FROM conversations"


def _answers(spark, sf):
    """Model answers built from the conversation table: a phrase picked per turn, followed by the user's text."""
    pick = F.array(*[F.lit(a) for a in _ANSWERS])
    at = ((F.col("conv_id") * 7 + F.col("turn")) % len(_ANSWERS)).cast("int")
    tail = F.when(F.col("role") == "user", F.concat(F.lit(" "), F.col("text"))).otherwise("")
    return table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.get(pick, at), tail).alias("answer"))


@query("parse_label_strict", f"""+a AS ({_ANSWER_SQL}), s AS (SELECT conv_id, turn, regexp_replace(split_part(lower(trim(regexp_replace(answer, '^\\s+', ''))), chr(10), 1), '[^a-z]', '', 'g') AS s FROM a)
  SELECT conv_id, turn, CASE WHEN contains(s, 'positive') OR s = 'pos' THEN 1 WHEN contains(s, 'negative') OR s = 'neg' THEN 0 END AS label FROM s""".replace("+a", "WITH a", 1))
def _(spark, sf):
    return _answers(spark, sf).select("conv_id", "turn", lab.parse_strict(F.col("answer")).alias("label"))


@query("parse_label_window", f"""+a AS ({_ANSWER_SQL}), s AS (SELECT conv_id, turn, substr(lower(regexp_replace(answer, '^\\s+|\\s+$', '', 'g')), 1, 50) AS s FROM a),
  f AS (SELECT conv_id, turn, contains(s, 'positive') AS p, contains(s, 'negative') AS n, regexp_matches(s, '\\b1\\b') AS one, regexp_matches(s, '\\b0\\b') AS zero FROM s)
  SELECT conv_id, turn, CASE WHEN p AND NOT n THEN 1 WHEN n AND NOT p THEN 0 WHEN one AND NOT zero THEN 1 WHEN zero AND NOT one THEN 0 END AS label FROM f""".replace("+a", "WITH a", 1))
def _(spark, sf):
    return _answers(spark, sf).select("conv_id", "turn", lab.parse_window(F.col("answer")).alias("label"))


@query("render_prompt", "SELECT doc_id, md5(" + "'" + lab.FEW_SHOT.partition("{text}")[0].replace("'", "''") + "' || text || '" + lab.FEW_SHOT.partition("{text}")[2] + "') AS prompt_md5 FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(lab.render(lab.FEW_SHOT, F.col("text"))).alias("prompt_md5"))


@query("text_preview", "SELECT page_id, CASE WHEN length(html) > 60 THEN substr(html, 1, 60) || '...' ELSE html END AS preview FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.preview(F.col("html"), 60).alias("preview"))


@query("date_functions", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, date_trunc('month', ts)::DATE AS month,
  last_day(ts) AS month_end FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", day("ts").alias("day"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
        F.trunc(F.to_date("ts"), "month").alias("month"), F.last_day("ts").alias("month_end"),
    )


@query("array_pad_truncate", """SELECT vec_id, list_resize(list_transform(embedding[1:(vec_id % 10)::INTEGER], lambda x: CAST(floor(x::DOUBLE * 10) AS INTEGER)), 6, 0)::INTEGER[] AS padded,
  len(embedding) AS dim, round(embedding[-1]::DOUBLE, 6) AS first_reversed FROM embeddings""")
def _(spark, sf):
    ids = F.transform(F.slice("embedding", F.lit(1), (F.col("vec_id") % 10).cast("int")), lambda x: F.floor(x.cast("double") * 10).cast("int"))
    return table(spark, sf, "embeddings").select(
        "vec_id", tx.pad_truncate(ids, 6).alias("padded"), F.size("embedding").cast("long").alias("dim"),
        F.round(F.get(F.reverse("embedding"), F.lit(0)).cast("double"), 6).alias("first_reversed"),
    )


@query("null_coercions", """SELECT review_id, coalesce(primary_label, 0)::DOUBLE AS as_float, primary_label IS NOT NULL AND primary_label <> 0 AS as_bool,
  CAST(primary_label IS NOT NULL AS INTEGER) AS as_int FROM cache WHERE ord = 0""", "cache")
def _(spark, sf):
    from ratelens.plans.views import label_cache

    p = F.col("primary_label")
    return label_cache(spark, sf).filter(F.col("ord") == 0).select(
        "review_id", F.coalesce(p, F.lit(0)).cast("double").alias("as_float"), F.coalesce(p.cast("boolean"), F.lit(False)).alias("as_bool"),
        p.isNotNull().cast("int").alias("as_int"),
    )


@query("balanced_sample_union", """SELECT review_id, stars FROM (SELECT review_id, stars, row_number() OVER (PARTITION BY stars ORDER BY md5(review_id || ':42'), review_id) AS k
  FROM rtc WHERE stars IN (1, 5)) WHERE k <= 20
  AND (SELECT least(count(*) FILTER (WHERE stars = 1), count(*) FILTER (WHERE stars = 5)) FROM rtc) >= 20""", "rtc")
def _(spark, sf):
    r = clean_reviews(spark, sf)
    return sampling.balanced_sample(r, "stars", [1, 5], 40, "review_id").select("review_id", "stars")


@query("run_summary", """SELECT (SELECT count(*) FROM tfeat) AS n_reviews, (SELECT count(*) FROM ttrust) AS n_businesses_scored,
  (SELECT round(avg(suspicious) * 100, 6) FROM tfeat) AS headline_pct, (SELECT count(*) FROM tcovered) AS records_written""", "tfeat", "ttrust", "tcovered")
def _(spark, sf):
    from ratelens import workflow
    from ratelens.plans.views import COMPUTED_AT, RULES

    result = workflow.run(clean_reviews(spark, sf), RULES, COMPUTED_AT, topics=document_topics(spark, sf), fit_model=False, plain=True)
    return rounded(workflow.run_summary(result), "headline_pct")


@query("burst_days", """+d AS (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL),
  s AS (SELECT user_id, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM d GROUP BY user_id),
  f AS (SELECT s.user_id, s.day, coalesce(d.n, 0) AS n FROM s LEFT JOIN d ON d.user_id = s.user_id AND d.day = s.day),
  q AS (SELECT user_id, quantile_cont(n::DOUBLE, 0.95) AS limit_n FROM f GROUP BY user_id)
  SELECT f.user_id, f.day, f.n, round(q.limit_n, 6) AS limit_n FROM f JOIN q USING (user_id) WHERE f.n > q.limit_n""".replace("+d", "WITH d", 1))
def _(spark, sf):
    return rounded(profile.busy_days(table(spark, sf, "events")), "limit_n")
