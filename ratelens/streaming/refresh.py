"""Trust scores kept up to date from arriving reviews, and daily counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.config import MIN_REVIEWS, SUSPICION_CUTOFF


def partial_sums(features: DataFrame, score: str = "suspicion_score") -> DataFrame:
    """Mergeable per-business sums: adding those of two batches gives those of their union."""
    s, stars = F.col(score).cast("double"), F.col("stars").cast("double")
    return features.filter(F.col("business_id").isNotNull()).groupBy("business_id").agg(
        F.count("review_id").alias("n"), F.count("*").alias("n_rows"), F.sum(stars).alias("sum_stars"),
        F.sum(s).alias("sum_score"), F.sum((s > SUSPICION_CUTOFF).cast("long")).alias("n_over"),
        F.sum(1.0 - s).alias("sum_w"), F.sum((1.0 - s) * stars).alias("sum_wx"),
    )


def merge_sums(parts: DataFrame) -> DataFrame:
    return parts.groupBy("business_id").agg(*[
        F.sum(c).alias(c) for c in ("n", "n_rows", "sum_stars", "sum_score", "n_over", "sum_w", "sum_wx")
    ])


def scores_from_sums(sums: DataFrame, min_reviews: int = MIN_REVIEWS) -> DataFrame:
    """The trust-score table restored from sums."""
    raw = F.col("sum_stars") / F.col("n_rows")
    adjusted = F.when(F.col("sum_w") > 0, F.col("sum_wx") / F.nullif(F.col("sum_w"), F.lit(0.0))).otherwise(raw)
    return sums.filter(F.col("n") >= min_reviews).select(
        "business_id", F.col("n").alias("review_count"), raw.alias("raw_avg_stars"),
        (F.col("n_over") / F.col("n_rows") * 100.0).alias("suspicion_pct"),
        (F.col("sum_score") / F.col("n_rows")).alias("mean_suspicion_score"),
        adjusted.alias("adjusted_stars"), (raw - adjusted).alias("manipulation_delta"),
    )


def run_refresh(stream: DataFrame, state_path: str, checkpoint: str, score: str = "suspicion_score") -> None:
    """Consume what has arrived and stop. Each batch writes its sums under its own id, so a batch that is
    replayed after a failure overwrites itself and nothing is counted twice."""

    def save(batch: DataFrame, batch_id: int) -> None:
        partial_sums(batch, score).write.mode("overwrite").parquet(f"{state_path}/batch_id={batch_id}")

    q = (
        stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()


def read_refreshed(spark: SparkSession, state_path: str, min_reviews: int = MIN_REVIEWS) -> DataFrame:
    return scores_from_sums(merge_sums(spark.read.parquet(state_path)), min_reviews)


def compact(spark: SparkSession, state_path: str, target: str) -> None:
    """Merge the sums of all batches into one batch in a new folder; later refreshes write to that folder.

    The old folder is left as it was, so a failed run can be repeated, and the sums are never in one place twice.
    """
    if target.rstrip("/") == state_path.rstrip("/"):
        raise ValueError("compact into a folder of its own: sums beside those they were made of would count twice")
    merge_sums(spark.read.parquet(state_path)).write.mode("overwrite").parquet(f"{target}/batch_id=-1")


def run_daily_counts(stream: DataFrame, state_path: str, checkpoint: str, entity: str = "user_id", ts: str = "ts") -> None:
    """Per-entity day counts of what has arrived. Each batch writes its counts under its own id, so that late rows
    count on their day however late they are, no day is held back, and a replayed batch overwrites itself."""

    def save(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(entity, F.to_date(ts).alias("day")).agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{state_path}/batch_id={batch_id}")

    q = (
        stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()


def read_daily_counts(spark: SparkSession, state_path: str, entity: str = "user_id") -> DataFrame:
    """Day counts over all batches."""
    return spark.read.parquet(state_path).groupBy(entity, "day").agg(F.sum("n").alias("n"))
