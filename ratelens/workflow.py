"""The whole job: reviews in, ranked businesses and signed records out."""

from __future__ import annotations

from dataclasses import dataclass, field

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.config import GBT_DEPTH, GBT_ROUNDS, MIN_REVIEWS, TOP_N
from ratelens.functions.labels import ZERO_SHOT, agreement, parse_window, render
from ratelens.functions.sentiment import Rules
from ratelens.operators import cleaning, evaluation, lookups, models, records, sampling, scoring
from ratelens.operators.features import feature_matrix, with_sentiment
from ratelens.operators.sampling import hash_sample
from ratelens.session import materialise
from ratelens.sources import record_store


@dataclass
class Result:
    """Tables of a run. The features have been written once; everything after them is lazy."""

    scored_reviews: DataFrame
    by_business: DataFrame
    top: DataFrame
    records: DataFrame
    metrics: DataFrame | None
    skipped: list[str] = field(default_factory=list)


def run(reviews: DataFrame, rules: Rules, computed_at: str, *, topics: DataFrame | None = None,
        label_agreement: Column | None = None, fit_model: bool = True, sample: int | None = None,
        rounds: int = GBT_ROUNDS, depth: int = GBT_DEPTH, min_reviews: int = MIN_REVIEWS, plain: bool = False) -> Result:
    """Sentiment, features, suspicion, aggregation and records for cleaned reviews.

    Text is scored in the scan stage and dropped; the narrow features are written to the scratch folder, so
    ranking, records and totals read them and never the text again.
    """
    if sample:
        reviews = hash_sample(reviews, "review_id", sample)
    features = feature_matrix(with_sentiment(reviews, rules, plain), topics, keep=("date",), need=("stars",))
    metrics = None
    if fit_model:
        scored, _, metrics = models.fit_and_score(features, rounds, depth)
    else:
        scored = scoring.label_as_score(materialise(features, "features"))
    by = scoring.trust_score(scored, min_reviews=min_reviews, ordered=False, extra=records.business_evidence())
    signed = records.sign_records(records.build_records(scoring.coverage(by), computed_at, agreement_rate=label_agreement))
    skipped = [name for name, gone in (("topics", topics is None), ("labels", label_agreement is None)) if gone]
    return Result(scored, by, scoring.top_by_delta(by, TOP_N), signed, metrics, skipped)


def run_summary(result: Result) -> DataFrame:
    """One row of run totals."""
    headline = result.scored_reviews.agg(
        F.count("*").alias("n_reviews"), (F.avg(F.col("suspicious").cast("double")) * 100.0).alias("headline_pct")
    )
    scored = result.by_business.agg(F.count("*").alias("n")).scalar()
    written = result.records.agg(F.count("*").alias("n")).scalar()
    return headline.select("n_reviews", scored.alias("n_businesses_scored"), "headline_pct", written.alias("records_written"))


def summary_payload(result: Result) -> DataFrame:
    """One JSON document with run totals, the top list and all covered records.

    At most TOP_N rows and the covered set (bounded by its two limits) are collected into it.
    """
    stats = run_summary(result).select(F.struct("*").alias("stats"))
    row = F.struct("manipulation_delta", "business_id", "review_count", "raw_avg_stars", "adjusted_stars", "suspicion_pct")
    top = result.top.agg(F.reverse(F.array_sort(F.collect_list(row))).alias("top")).scalar()
    docs = records.documents(result.records).agg(F.array_sort(F.collect_list("value")).alias("d")).scalar()
    return stats.select(F.concat(
        F.lit('{"stats":'), F.to_json("stats"), F.lit(',"top":'), F.to_json(top),
        F.lit(',"records":['), F.array_join(docs, ","), F.lit("]}"),
    ).alias("payload"))


LABELS = ("zero_shot_label", "few_shot_label", "primary_label", "comparator_label")


def label_rows(sample: DataFrame, *, ask: Callable[[list[str]], list[str]] | None = None, compare: Callable[[list[str]], list[str]] | None = None,
               cache: DataFrame | None = None) -> tuple[DataFrame | None, str]:
    """Labels of sampled reviews and where they come from: a live model, else a cache, else nowhere (no table).

    ask and compare take the prompts of a batch and return answers; they run on the executors. Live labels use the same
    answer for the zero-shot and the primary label.
    """
    if ask is not None:
        prompts = sample.withColumn("prompt", render(ZERO_SHOT, F.col("text")))
        said = models.apply_answers(prompts, "prompt", ask, "a1")
        said = models.apply_answers(said, "prompt", compare or ask, "a2")
        first, second = parse_window(F.col("a1")), parse_window(F.col("a2"))
        columns = [first.alias(LABELS[0]), F.lit(None).cast("int").alias(LABELS[1]), first.alias(LABELS[2]), second.alias(LABELS[3])]
        return said.select("review_id", "stars", *columns, agreement(first, second).alias("multi_model_agreement")), "live"
    if cache is not None:
        got = lookups.lookup_first(sample, cache, "review_id", ["review_id"], LABELS)
        return got.select("review_id", "stars", *LABELS, agreement(F.col("primary_label"), F.col("comparator_label")).alias("multi_model_agreement")), "cached"
    return None, "skipped"


def run_job(reviews: DataFrame, rules: Rules, computed_at: str, out: str, *, source: str = "reviews", vectors: DataFrame | None = None,
            topics: DataFrame | None = None, ask: Callable | None = None, compare: Callable | None = None, cache: DataFrame | None = None,
            sample: int = 40, anchors: bool = True, **options) -> Result:
    """The whole job with its sinks: topics, labels, scores, records, and a log of signed events, in folders under `out`.

    vectors: rows (review_id, vector) to cluster when no topics are given. A step without input is skipped and named.
    Every folder is overwritten by a rerun but the event log, which belongs to one run: give each its own `out`.
    """
    events = f"{out}/events"

    def log(rows: DataFrame, kind: str) -> None:
        record_store.append_events(records.event_envelope(rows, kind, computed_at, rows.schema), events)

    log(cleaning.ingest_event(reviews, source).select("source_type", "source_path", "row_count"), "ingest")
    if topics is None and vectors is not None:
        topics = models.topic_clusters(vectors, "review_id", "vector")
    if topics is not None:
        topics = materialise(topics, "topics")
    picked = sampling.balanced_sample(reviews, "stars", [1, 5], sample, "review_id").select("review_id", "stars", "text")
    labels, label_source = label_rows(picked, ask=ask, compare=compare, cache=cache)
    rate = None
    if labels is not None:
        labels = materialise(labels, "labels")
        labels.write.mode("overwrite").parquet(f"{out}/labels")
        rate = evaluation.agreement_rate(labels, "multi_model_agreement").select("agreement_rate").scalar()
        log(labels.select("review_id", F.lit(label_source).alias("label_source"), "primary_label", "comparator_label"), "label_call")
    else:
        spark = reviews.sparkSession
        log(spark.createDataFrame([("label_source", -1, "deviation", "alert")], "metric string, delta int, classification string, action string"), "anomaly")
    result = run(reviews, rules, computed_at, topics=topics, label_agreement=rate, **options)
    log(records.balance_anomaly(result.scored_reviews), "anomaly")
    result.scored_reviews.write.mode("overwrite").parquet(f"{out}/scores")
    result.by_business.write.mode("overwrite").parquet(f"{out}/by_business")
    result.top.write.mode("overwrite").json(f"{out}/top")
    record_store.write_records(result.records, f"{out}/records", one_per_key=True)
    stored = record_store.read_records(reviews.sparkSession, f"{out}/records")
    record_store.write_store(stored, f"{out}/store")
    log(records.verification_anomalies(records.verify_records(stored)), "anomaly")
    if anchors:
        flagged = with_sentiment(reviews, rules, options.get("plain", False))
        record_store.write_records(records.sign_records(records.anchor_records(flagged, computed_at)), f"{out}/anchors", one_per_key=True)
    return result
