"""Sentiment columns and the feature matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.config import DIVERGENCE_THRESHOLD, NO_TOPIC, NO_TOPIC_OUTLIER
from ratelens.functions.sentiment import (
    Rules,
    divergence,
    divergence_flag,
    normalised_stars,
    plain_compound,
    rule_compound,
)
from ratelens.functions.text import word_count


def with_divergence(df: DataFrame, compound: str = "vader_compound",
                    threshold: float = DIVERGENCE_THRESHOLD) -> DataFrame:
    """Add normalised stars, their distance to the text score, and the 0/1 flag."""
    div = divergence(F.col(compound), F.col("stars"))
    return df.withColumns({
        "normalized_stars": normalised_stars(F.col("stars")),
        "sentiment_star_divergence": div,
        "suspicious": divergence_flag(div, threshold),
    })


def with_sentiment(df: DataFrame, rules: Rules, plain: bool = False,
                   threshold: float = DIVERGENCE_THRESHOLD) -> DataFrame:
    """Score the text in the row and add the divergence columns. Nothing is shuffled."""
    if plain:
        scored = df.withColumn("vader_compound", plain_compound(F.col("text"), rules.lexicon))
    else:
        scored = rule_compound(df, "text", rules)
    return with_divergence(scored, threshold=threshold)


def sentiment_scores(df: DataFrame, rules: Rules, plain: bool = False) -> DataFrame:
    """The persisted score table: one row per review."""
    return with_sentiment(df, rules, plain).select(
        "review_id", "stars", "vader_compound", "normalized_stars", "sentiment_star_divergence", "suspicious"
    )


def join_sentiment(reviews: DataFrame, scores: DataFrame) -> DataFrame:
    """Left join of stored scores, one per review; reviews without a score keep nulls."""
    return reviews.join(_one_per_review(scores, "vader_compound", "sentiment_star_divergence", "suspicious"), "review_id", "left")


def _one_per_review(table: DataFrame, *columns: str) -> DataFrame:
    """The smallest row of each review: a review that is listed twice must not be counted twice."""
    return table.groupBy("review_id").agg(F.min(F.struct(*columns)).alias("_one")).select("review_id", "_one.*")


def join_topics(reviews: DataFrame, topics: DataFrame | None) -> DataFrame:
    """Left join of topic ids, one per review. Unmatched reviews, or a skipped topic step, count as outliers."""
    if topics is None:
        return reviews.withColumns({"topic_id": F.lit(NO_TOPIC), "is_topic_outlier": F.lit(NO_TOPIC_OUTLIER)})
    joined = reviews.join(_one_per_review(topics, "topic_id", "is_topic_outlier"), "review_id", "left")
    return joined.withColumns({
        "topic_id": F.coalesce(F.col("topic_id").cast("int"), F.lit(NO_TOPIC)),
        "is_topic_outlier": F.coalesce(F.col("is_topic_outlier").cast("int"), F.lit(NO_TOPIC_OUTLIER)),
    })


def feature_matrix(scored: DataFrame, topics: DataFrame | None = None,
                   threshold: float = DIVERGENCE_THRESHOLD, keep: tuple[str, ...] = (),
                   need: tuple[str, ...] = ("vader_compound", "sentiment_star_divergence")) -> DataFrame:
    """One row per review with all features and the proxy label.

    `scored` carries text or review_length_words plus the sentiment columns. Text is reduced to a word
    count before the join, so the only shuffled columns are narrow.
    `keep` carries further columns through, such as the date. Rows lacking a column of `need` are dropped;
    pass ("stars",) when the scores come from with_sentiment, where they are missing only with the stars:
    a filter on a score column would be pushed below it and score the text twice.
    """
    if "review_length_words" not in scored.columns:
        scored = scored.withColumn("review_length_words", word_count(F.col("text")))
    narrow = scored.select(
        "review_id", "business_id", "stars", "useful", "funny", "cool", "review_length_words",
        "vader_compound", "sentiment_star_divergence", "suspicious", *keep,
    ).dropna(subset=list(need))
    return join_topics(narrow, topics).withColumn(
        "suspicious_label", divergence_flag(F.col("sentiment_star_divergence"), threshold)
    )
