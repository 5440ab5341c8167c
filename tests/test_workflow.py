"""The whole job on a small table: sample, fit, score, sign, verify, payload."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ratelens import workflow
from ratelens.functions.sentiment import Rules
from ratelens.operators import record_queries, records
from ratelens.session import scratch_path
from ratelens.sources import record_store

RULES = Rules({"good": 2.0, "great": 3.0, "bad": -2.0, "awful": -3.0})


@pytest.fixture(scope="module")
def reviews(spark):
    rng = random.Random(9)
    rows = [(f"r{i}", f"u{i % 20}", "hot" if i % 3 == 0 else f"b{i % 8}", rng.randint(1, 5), rng.randint(0, 3), 0, 0,
             " ".join(rng.choice(["good", "great", "bad", "awful", "food", "not", "very"]) for _ in range(6)), f"2020-0{1 + i % 9}-11")
            for i in range(300)]
    names = "review_id string, user_id string, business_id string, stars int, useful int, funny int, cool int, text string, d string"
    return spark.createDataFrame(rows, names).withColumn("date", F.col("d").cast("timestamp_ntz"))


@pytest.mark.parametrize("fit", [False, True])
def test_run(spark, reviews, fit):
    result = workflow.run(reviews, RULES, "2024-01-01T00:00:00Z", fit_model=fit, sample=250, rounds=3, depth=3)
    assert result.scored_reviews.count() == 250
    assert (result.metrics is not None) == fit and result.skipped == ["topics", "labels"]
    path = scratch_path(spark, "run")
    record_store.write_records(result.records, path, one_per_key=True)
    store = record_store.read_records(spark, path)
    summary = record_queries.verify_summary(record_queries.verify_chain(store, ["hot", "nobody"], spark)).collect()[0]
    assert (summary["total_checked"], summary["verified"], summary["failed"]) == (2, 1, 1)
    classes = {r["topology"] for r in record_queries.classify(records.typed(store)).collect()}
    assert classes <= {"OPEN", "HYBRID"}  # skipped topics make every review an outlier
    payload = json.loads(workflow.summary_payload(result).collect()[0]["payload"])
    assert payload["stats"]["n_reviews"] == 250
    assert len(payload["records"]) == payload["stats"]["records_written"] == result.by_business.count()


def test_rerun_gives_the_same_documents(reviews):
    def docs():
        run = workflow.run(reviews, RULES, "2024-01-01T00:00:00Z", fit_model=False)
        return sorted(r["value"] for r in records.documents(run.records).collect())

    assert docs() == docs()


def test_whole_job_with_live_labels(spark, reviews):
    def said(prompts):
        return ["positive" if "good" in p or "great" in p else "negative" for p in prompts]

    out = scratch_path(spark, "job")
    vectors = reviews.select("review_id", F.array(*[(F.crc32(F.concat("review_id", F.lit(str(i)))) % 100 / 100.0) for i in range(6)]).alias("vector"))
    result = workflow.run_job(reviews, RULES, "2024-01-01T00:00:00Z", out, vectors=vectors, ask=said, compare=said, sample=20, rounds=3, depth=3)
    assert result.skipped == []
    log = spark.read.json(f"{out}/events")
    kinds = {r["receipt_type"]: r["count"] for r in log.groupBy("receipt_type").count().collect()}
    assert kinds["ingest"] == 1 and kinds["label_call"] == 20
    assert log.filter("length(payload_hash.sha256) <> 64 or ts is null or tenant_id is null").count() == 0
    assert spark.read.parquet(f"{out}/labels").filter("multi_model_agreement").count() == 20
    assert record_store.read_store(spark, f"{out}/store").filter("evidence.label_agreement_rate = 1.0").count() == result.by_business.count()
    anchors = records.verify_records(record_store.read_records(spark, f"{out}/anchors"))
    assert anchors.filter(~F.col("verified") | F.col("evidence.topic_outlier_pct").isNotNull()).count() == 0


def test_job_without_inputs_names_what_it_skipped(spark, reviews):
    out = scratch_path(spark, "bare")
    flat = reviews.withColumn("stars", F.lit(3)).withColumn("text", F.lit("food"))
    result = workflow.run_job(flat, RULES, "2024-01-01T00:00:00Z", out)
    assert result.skipped == ["topics", "labels"] and result.metrics is None
    metrics = {r["metric"] for r in spark.read.json(f"{out}/events").filter("receipt_type = 'anomaly'").collect()}
    assert metrics == {"label_source", "classifier_class_balance"}


def test_custom_scorer(spark):
    from ratelens.operators import models

    df = spark.createDataFrame([("ab",), (None,)], "text string")
    assert [r["score"] for r in models.apply_scorer(df, "text", lambda texts: [len(t) for t in texts]).collect()] == [2.0, 0.0]
