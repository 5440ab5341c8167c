"""Samples, splits and label sourcing (inventory 2.14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelens.functions.labels import agreement
from ratelens.functions.text import preview
from ratelens.operators import evaluation, lookups, sampling
from ratelens.plans.registry import query
from ratelens.plans.views import (
    clean_reviews,
    label_cache,
    number_reviews,
    predictions,
    rounded,
    table,
)
from ratelens.session import scratch_path
from ratelens.sources import reviews


@query("hash_sample", "SELECT review_id, user_id, stars FROM rn ORDER BY md5(review_id || ':42'), review_id LIMIT 500", "rn")
def _(spark, sf):
    return sampling.hash_sample(number_reviews(spark, sf), "review_id", 500).select("review_id", "user_id", "stars")


@query("hash_sample_all", "SELECT review_id FROM rtc", "rtc")
def _(spark, sf):
    """A sample larger than the table is the table."""
    return sampling.hash_sample(clean_reviews(spark, sf).select("review_id"), "review_id", 1_000_000)


@query("entity_sample", """SELECT review_id, business_id, stars FROM rn WHERE business_id IN
  (SELECT business_id FROM (SELECT DISTINCT business_id FROM rn) ORDER BY md5(business_id || ':42'), business_id LIMIT 50)""", "rn")
def _(spark, sf):
    return sampling.entity_sample(number_reviews(spark, sf), "business_id", 50).select("review_id", "business_id", "stars")


@query("balanced_sample", """SELECT review_id, stars FROM (SELECT review_id, stars, row_number() OVER (PARTITION BY stars ORDER BY md5(review_id || ':42'), review_id) AS k
  FROM rn WHERE stars IN (1, 5)) WHERE k <= 20
  AND (SELECT least(count(*) FILTER (WHERE stars = 1), count(*) FILTER (WHERE stars = 5)) FROM rn) >= 20""", "rn")
def _(spark, sf):
    return sampling.balanced_sample(number_reviews(spark, sf), "stars", [1, 5], 40, "review_id").select("review_id", "stars")


@query("balanced_sample_insufficient", "SELECT review_id, stars FROM rn WHERE false", "rn")
def _(spark, sf):
    """No review has six stars, so no sample can be drawn."""
    return sampling.balanced_sample(number_reviews(spark, sf), "stars", [1, 6], 40, "review_id").select("review_id", "stars")


_SPLIT = """SELECT review_id, stars, CASE WHEN k <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM (SELECT review_id, stars,
  row_number() OVER (PARTITION BY stars ORDER BY md5(review_id || ':42'), review_id) AS k, count(*) OVER (PARTITION BY stars) AS n FROM rn)"""


@query("stratified_split", _SPLIT, "rn")
def _(spark, sf):
    return sampling.stratified_split(number_reviews(spark, sf).select("review_id", "stars"), "stars", "review_id")


@query("split_report", f"SELECT split, stars, count(*) AS n, round(count(*) / (sum(count(*)) OVER (PARTITION BY split))::DOUBLE, 6) AS share FROM ({_SPLIT}) GROUP BY split, stars", "rn")
def _(spark, sf):
    s = sampling.stratified_split(number_reviews(spark, sf).select("review_id", "stars"), "stars", "review_id")
    return rounded(sampling.split_report(s, "stars"), "share")


@query("label_cache_replay", """SELECT s.review_id, CASE WHEN stars >= 4 THEN 1 ELSE 0 END AS true_label, zero_shot_label, few_shot_label, primary_label, comparator_label,
  primary_label IS NOT NULL AND primary_label IS NOT DISTINCT FROM comparator_label AS multi_model_agreement FROM
  (SELECT review_id, stars FROM (SELECT review_id, stars, row_number() OVER (PARTITION BY stars ORDER BY md5(review_id || ':42'), review_id) AS k FROM rtc WHERE stars IN (1, 5)) WHERE k <= 40
  AND (SELECT least(count(*) FILTER (WHERE stars = 1), count(*) FILTER (WHERE stars = 5)) FROM rtc) >= 40) s
  LEFT JOIN (SELECT * FROM cache WHERE ord = 0) c USING (review_id)""", "rtc", "cache")
def _(spark, sf):
    sample = sampling.balanced_sample(clean_reviews(spark, sf), "stars", [1, 5], 80, "review_id").select("review_id", "stars")
    names = ["zero_shot_label", "few_shot_label", "primary_label", "comparator_label"]
    got = lookups.lookup_first(sample, label_cache(spark, sf), "review_id", ["ord"], names)
    return got.select("review_id", (F.col("stars") >= 4).cast("int").alias("true_label"), *names,
                      agreement(F.col("primary_label"), F.col("comparator_label")).alias("multi_model_agreement"))


@query("label_source_status", """SELECT 'cached' AS source, count(*) AS n_rows, round(avg(CASE WHEN primary_label IS NOT NULL AND primary_label = comparator_label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS agreement_rate FROM cache WHERE ord = 0
  UNION ALL SELECT 'skipped', 0::BIGINT, NULL""", "cache")
def _(spark, sf):
    """A cache that exists and one that does not: the skipped source gives an empty table and no rate."""
    path = scratch_path(spark, "cache")
    cache = label_cache(spark, sf).filter(F.col("ord") == 0)
    reviews.write_csv(cache, f"{path}/present")
    out = None
    for name in ("present", "absent"):
        df, there = reviews.read_optional_csv(spark, f"{path}/{name}", cache.schema)
        row = evaluation.agreement_rate(df, "multi_model_agreement").select(
            F.lit("cached" if there else "skipped").alias("source"), F.col("n").alias("n_rows"), F.round("agreement_rate", 6).alias("agreement_rate")
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("cache_write_roundtrip", "SELECT review_id, zero_shot_label, few_shot_label, primary_label, comparator_label, primary_label IS NOT NULL AND primary_label = comparator_label AS multi_model_agreement FROM cache WHERE ord = 0", "cache")
def _(spark, sf):
    """Writing replaces the earlier content of the cache."""
    path = scratch_path(spark, "cache")
    cache = label_cache(spark, sf)
    names = ["review_id", "zero_shot_label", "few_shot_label", "primary_label", "comparator_label", "multi_model_agreement"]
    reviews.write_csv(cache.select(*names), path)
    first = cache.filter(F.col("ord") == 0).select(*names)
    reviews.write_csv(first, path)
    return reviews.read_csv(spark, path, first.schema)


@query("misclassified_rows", """SELECT review_id, CASE y_true WHEN 1 THEN 'Positive' ELSE 'Negative' END AS true_name, CASE y_pred WHEN 1 THEN 'Positive' ELSE 'Negative' END AS predicted_name,
  CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS preview FROM preds WHERE y_pred IS NOT NULL AND y_pred <> y_true ORDER BY md5(review_id || ':42'), review_id LIMIT 3""", "preds")
def _(spark, sf):
    def name(c):
        return F.when(F.col(c) == 1, "Positive").otherwise("Negative")

    rows = sampling.misclassified(predictions(spark, sf), "y_true", "y_pred", "review_id")
    return rows.select("review_id", name("y_true").alias("true_name"), name("y_pred").alias("predicted_name"), preview(F.col("text"), 100).alias("preview"))


@query("fraction_sample", "SELECT o_orderkey FROM orders WHERE ('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT < 429496729")
def _(spark, sf):
    """About a tenth of the orders, chosen by hash without a sort."""
    return sampling.fraction_sample(table(spark, sf, "orders"), "o_orderkey", 0.1).select("o_orderkey")
