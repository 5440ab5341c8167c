"""Trust-weighted rating per business, rankings and the covered set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.config import (
    ANCHOR_COUNT,
    ANCHOR_MIN_STARS,
    COVERAGE_BY_VOLUME,
    MIN_REVIEWS,
    SUSPICION_CUTOFF,
    TOP_N,
)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: weighted mean, or the plain mean when the weights do not add up to more than zero."""
    total = F.sum(weight)
    return F.when(total > 0, F.sum(value * weight) / F.nullif(total, F.lit(0.0))).otherwise(F.avg(value))


def trust_score(features: DataFrame, score: str = "suspicion_score", min_reviews: int = MIN_REVIEWS,
                ordered: bool = True, extra: dict[str, Column] | None = None) -> DataFrame:
    """Mean rating, rating weighted by (1 - suspicion) and their gap, for businesses with enough reviews.

    One aggregation: partial sums are combined before the shuffle, so a business holding a large
    share of all reviews costs one row per task. `extra` adds aggregates to the same grouping.
    """
    s, stars = F.col(score).cast("double"), F.col("stars").cast("double")
    by = features.filter(F.col("business_id").isNotNull()).groupBy("business_id").agg(
        F.count("review_id").alias("review_count"),
        F.avg(stars).alias("raw_avg_stars"),
        (F.avg((s > SUSPICION_CUTOFF).cast("double")) * 100.0).alias("suspicion_pct"),
        F.avg(s).alias("mean_suspicion_score"),
        weighted_mean(stars, 1.0 - s).alias("adjusted_stars"),
        *[c.alias(name) for name, c in (extra or {}).items()],
    )
    by = by.withColumn("manipulation_delta", F.col("raw_avg_stars") - F.col("adjusted_stars"))
    by = by.filter(F.col("review_count") >= min_reviews)
    return by.orderBy(F.desc("manipulation_delta"), "business_id") if ordered else by


def label_as_score(features: DataFrame) -> DataFrame:
    """The branch without a model: the 0/1 label is the suspicion score."""
    return features.withColumn("suspicion_score", F.col("suspicious_label").cast("double"))


def top_by_delta(scored: DataFrame, n: int = TOP_N) -> DataFrame:
    return scored.orderBy(F.desc("manipulation_delta"), "business_id").limit(n)


def top_by_volume(scored: DataFrame, n: int = COVERAGE_BY_VOLUME) -> DataFrame:
    return scored.orderBy(F.desc("review_count"), "business_id").limit(n)


def coverage(scored: DataFrame, by_volume: int = COVERAGE_BY_VOLUME, by_delta: int = TOP_N) -> DataFrame:
    """Businesses that get a record: most reviewed, then largest gap, first occurrence kept.

    At most by_volume + by_delta rows reach the de-duplication.
    """
    ranked = top_by_volume(scored, by_volume).withColumn("_list", F.lit(0)).unionByName(
        top_by_delta(scored, by_delta).withColumn("_list", F.lit(1))
    )
    rest = [c for c in scored.columns if c != "business_id"]
    first = F.min_by(F.struct(*rest), "_list").alias("r")
    return ranked.groupBy("business_id").agg(first, F.min("_list").alias("_list")).select(
        "business_id", *[F.col(f"r.{c}").alias(c) for c in rest],
        F.when(F.col("_list") == 0, "volume").otherwise("delta").alias("covered_by"),
    )


def first_order_scores(reviews: DataFrame, min_reviews: int = MIN_REVIEWS) -> DataFrame:
    """Scores from the divergence flag alone, for every business in one pass."""
    flag, stars = F.col("suspicious").cast("double"), F.col("stars").cast("double")
    return reviews.filter(F.col("business_id").isNotNull()).groupBy("business_id").agg(
        F.count("review_id").alias("review_count"),
        F.avg(stars).alias("raw_avg_stars"),
        weighted_mean(stars, 1.0 - flag).alias("adjusted_stars"),
        (F.avg(flag) * 100.0).alias("suspicious_review_pct"),
        F.avg("sentiment_star_divergence").alias("mean_divergence"),
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
    ).filter(F.col("review_count") >= min_reviews)


def anchor_candidates(reviews: DataFrame, k: int = ANCHOR_COUNT, min_reviews: int = MIN_REVIEWS,
                      min_stars: float = ANCHOR_MIN_STARS) -> DataFrame:
    """The k most reviewed businesses with a high mean rating."""
    return (
        reviews.filter(F.col("business_id").isNotNull()).groupBy("business_id")
        .agg(F.count("review_id").alias("review_count"), F.avg(F.col("stars").cast("double")).alias("avg_stars"))
        .filter((F.col("review_count") >= min_reviews) & (F.col("avg_stars") >= min_stars))
        .orderBy(F.desc("review_count"), "business_id").limit(k)
    )
