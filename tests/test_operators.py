import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.functions.sentiment import Rules
from ratelens.operators import cleaning, distributions, features, lookups, models, neighbours, profile, records, sampling, scoring, topics
from ratelens.session import scratch_path
from ratelens.sources import record_store, reviews
from ratelens.streaming import refresh

RULES = Rules({"good": 2.0, "bad": -2.0})


def review_rows(n, hot=3):
    """A third of all reviews belong to one business."""
    rng = random.Random(1)
    return [(f"r{i}", "hot" if i % hot == 0 else f"b{i % 17}", rng.randint(1, 5), rng.choice(["good", "bad", "", None, "so so"]))
            for i in range(n)]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame(review_rows(900), "review_id string, business_id string, stars int, text string").withColumns({
        "user_id": F.lit("u"), "useful": F.lit(0), "funny": F.lit(0), "cool": F.lit(0),
        "date": F.to_timestamp_ntz(F.lit("2020-02-03 04:05:06"))})
    return features.with_sentiment(df, RULES, plain=True)


@pytest.fixture(scope="module")
def matrix(scored):
    return scoring.label_as_score(features.feature_matrix(scored, keep=("date",), need=("stars",)))


def test_delta_is_raw_minus_adjusted(matrix):
    for r in scoring.trust_score(matrix).collect():
        assert abs(r["raw_avg_stars"] - r["adjusted_stars"] - r["manipulation_delta"]) < 1e-12


def test_constant_scores_give_no_delta(matrix):
    for s in (0.0, 1.0):
        rows = scoring.trust_score(matrix.withColumn("suspicion_score", F.lit(s))).collect()
        assert rows and all(r["manipulation_delta"] == 0 for r in rows)


def test_minimum_number_of_reviews(spark, matrix):
    small = matrix.limit(0).unionByName(matrix.filter(F.col("business_id") == "b1").limit(9))
    assert scoring.trust_score(small).count() == 0


def test_ties_are_ordered_by_key(matrix):
    rows = scoring.trust_score(matrix.withColumn("suspicion_score", F.lit(0.0))).collect()
    assert [r["business_id"] for r in rows] == sorted(r["business_id"] for r in rows)


def test_coverage_is_bounded_and_distinct(matrix):
    got = scoring.coverage(scoring.trust_score(matrix, ordered=False), 5, 3).collect()
    assert len(got) <= 8 and len({r["business_id"] for r in got}) == len(got)


def test_left_join_keeps_row_count(spark, scored):
    topics_table = spark.createDataFrame([(f"r{i}", i % 4 - 1, int(i % 4 == 0)) for i in range(0, 900, 2)],
                                         "review_id string, topic_id int, is_topic_outlier int")
    out = features.feature_matrix(scored, topics_table, need=("stars",))
    assert out.count() == 900
    assert out.filter((F.col("topic_id") == -1) & (F.col("is_topic_outlier") != 1)).count() == 0


def test_text_is_scored_once(matrix):
    plan = scoring.trust_score(matrix, ordered=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^a-z]+") == 1


def test_null_ids_survive_cleaning(spark):
    df = spark.createDataFrame([("#NAME?", "b"), ("r", "#NAME?"), (None, "b"), ("r", "b")], "review_id string, business_id string")
    assert cleaning.drop_invalid_ids(df).count() == 2


def test_missing_columns_are_refused(spark):
    with pytest.raises(ValueError, match="stars"):
        cleaning.require_columns(spark.createDataFrame([("r",)], "review_id string"))


def test_strict_row_count(spark):
    df = spark.range(5)
    assert cleaning.require_row_count(df, 5).count() == 5
    with pytest.raises(Exception, match="expected 6 rows"):
        cleaning.require_row_count(df, 6).collect()


def test_csv_round_trip_of_awkward_text(spark):
    texts = ['line one\nline two', 'quote " and, comma', "  padded  ", None, "ünïcode", 'ends with "']
    df = spark.createDataFrame(
        [(f"r{i}", "u", "b", "3", "0", "0", "0", t, "1/5/2020 9:07") for i, t in enumerate(texts)], reviews.RAW_REVIEWS)
    path = scratch_path(spark, "csv")
    reviews.write_csv(df, path)
    got = {r["review_id"]: r for r in reviews.load_reviews(spark, path, expected_rows=len(texts)).collect()}
    assert [got[f"r{i}"]["text"] for i in range(len(texts))] == texts
    assert got["r0"]["stars"] == 3 and str(got["r0"]["date"]) == "2020-01-05 09:07:00"


def test_bad_integers_fail_and_bad_dates_are_null(spark):
    row = ("r", "u", "b", "3", "0", "0", "0", "t", "yesterday")
    ok = cleaning.typed_reviews(spark.createDataFrame([row], reviews.RAW_REVIEWS))
    assert ok.collect()[0]["date"] is None
    with pytest.raises(Exception):
        cleaning.typed_reviews(spark.createDataFrame([row[:3] + ("three",) + row[4:]], reviews.RAW_REVIEWS)).collect()


def test_records_verify_until_changed(spark, matrix):
    by = scoring.trust_score(matrix, ordered=False, extra=records.business_evidence())
    signed = records.sign_records(records.build_records(by, "2024-01-01T00:00:00Z"))
    path = scratch_path(spark, "records")
    record_store.write_records(signed, path)
    back = record_store.read_records(spark, path).persist()
    assert back.count() == by.count()
    assert records.verify_records(back).filter(~F.col("verified")).count() == 0
    assert records.verify_records(records.sign_records(back)).filter(~F.col("verified")).count() == 0
    changes = {
        "tenant_id": F.lit("x"), "computed_at": F.lit("2024"), "limitations": F.array_append("limitations", F.lit("more")),
        "scores": F.col("scores").withField("raw_rating", F.lit("9.9")),
        "evidence": F.col("evidence").withField("label_agreement_rate", F.lit("0.5")),
        "input": F.col("input").withField("review_count", F.lit("1")),
        "dual_hash": F.col("dual_hash").withField("sha512", F.lit(None).cast("string")),
    }
    for column, value in changes.items():
        assert records.verify_records(back.withColumn(column, value)).filter("verified").count() == 0, column
    back.unpersist()


def test_unreadable_documents_are_skipped(spark):
    path = scratch_path(spark, "broken")
    spark.createDataFrame([("{not json",), ("",), ('{"business_id": "b1", "tenant_id": "t"}',)], "value string").write.text(path)
    store = record_store.read_records(spark, path)
    assert [r["business_id"] for r in store.collect()] == ["b1"]
    assert records.verify_records(store).collect()[0]["verified"] is False


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64])
def test_merkle_root(spark, n):
    leaves = sorted(hashlib.sha256(str(i).encode()).hexdigest() for i in range(n))
    level = leaves
    while len(level) > 1:
        level = [hashlib.sha256((level[i] + level[min(i + 1, len(level) - 1)]).encode()).hexdigest() for i in range(0, len(level), 2)]
    df = spark.createDataFrame([(x,) for x in reversed(leaves)], "h string")
    assert records.merkle_root(df, "h").collect()[0]["merkle_root"] == level[0]


def test_exact_quantiles_with_a_hot_group(spark):
    rng = np.random.default_rng(2)
    data = {"hot": rng.lognormal(size=6000), "flat": np.full(50, 2.5), "one": np.array([7.0]), "few": rng.normal(size=5)}
    rows = [(g, float(x)) for g, xs in data.items() for x in xs]
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = distributions.exact_quantiles(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", probs).collect()
    assert len(got) == len(data) * len(probs)
    for r in got:
        assert r["q"] == pytest.approx(np.quantile(data[r["g"]], r["p"]), abs=1e-12)


def test_split_is_exact_per_class(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1003)], "k long, y int")
    split = sampling.stratified_split(df, "y", "k").groupBy("y", "split").count().collect()
    n = {(r["y"], r["split"]): r["count"] for r in split}
    assert n[(1, "test")] == 21 and n[(1, "train")] == 80 and n[(0, "test")] == 181


def test_balanced_sample_needs_both_classes(spark):
    df = spark.createDataFrame([(i, 0 if i < 95 else 1) for i in range(100)], "k long, y int")
    assert sampling.balanced_sample(df, "y", [0, 1], 10, "k").count() == 10
    assert sampling.balanced_sample(df, "y", [0, 1], 20, "k").count() == 0


def test_fanout_audit_with_a_hot_key(spark):
    left = spark.createDataFrame([("hot",)] * 300 + [("a",), ("b",)], "k string")
    right = spark.createDataFrame([("hot",)] * 40 + [("a",)], "k string")
    r = lookups.fanout_audit(left, right, "k").collect()[0]
    assert r["join_rows"] == left.join(right, "k").count() and r["right_key_unique"] is False


def test_empty_months_count_zero(spark):
    df = spark.createDataFrame([("2020-01-15",), ("2020-04-01",), ("2020-04-30",), (None,)], "d string").select(F.col("d").cast("date").alias("date"))
    assert [(str(r[0]), r[1]) for r in profile.monthly_volume(df).orderBy("month_end").collect()] == [
        ("2020-01-31", 1), ("2020-02-29", 0), ("2020-03-31", 0), ("2020-04-30", 2)]


def test_neighbours_equal_brute_force_with_a_hot_cell(spark):
    rng = np.random.default_rng(4)
    hot = rng.normal(size=8) + 0.05 * rng.normal(size=(150, 8))
    x = np.vstack([hot, rng.normal(size=(250, 8))])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>")
    got = neighbours.knn_cosine(df, "id", "v", k=5, block_rows=40).orderBy("id", "rank").collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sim = u @ u.T
    np.fill_diagonal(sim, -np.inf)
    want = np.argsort(-sim, axis=1)[:, :5]
    assert [r["neighbour"] for r in got] == want.ravel().tolist()


def test_exact_neighbours_shuffle_no_vectors_to_compare_them(spark):
    """Blocks are read where they are compared: only the best of a comparison cross an exchange. Copies, short lists and repeated pivots count."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 6))
    x[600:] = x[0]  # more copies than neighbours are asked for
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>")
    found = neighbours.knn_cosine(df, "id", "v", k=3, block_rows=50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and plan.count("Exchange hashpartitioning(") == 1 and "CoGroup" not in plan
    got = found.orderBy("id", "rank").collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sim = u @ u.T
    np.fill_diagonal(sim, -np.inf)
    assert [r["similarity"] for r in got] == pytest.approx((-np.sort(-sim, axis=1)[:, :3]).ravel().tolist(), abs=1e-12)
    assert [r["neighbour"] for r in got if r["id"] == 650] == [0, 600, 601]
    assert neighbours.knn_cosine(df.limit(2), "id", "v", k=3).count() == 2


def test_trees_are_fitted_on_weighted_buckets(spark):
    """More rows of the same kinds are more weight and no more rows, and give the same scores; rare values of a feature are told apart."""
    rows = spark.range(3000).select(
        (F.col("id") % 5 + 1).cast("int").alias("stars"), (F.col("id") % 7).cast("int").alias("useful"), F.lit(0).alias("funny"), (F.col("id") % 200 == 0).cast("int").alias("cool"),
        (F.col("id") % 11).cast("int").alias("review_length_words"), (F.col("id") * 37 % 101 / 50.0 - 1).alias("vader_compound"),
        (F.col("id") * 13 % 997 / 500.0).alias("sentiment_star_divergence"), (F.col("id") % 3).cast("int").alias("topic_id"), F.lit(0).alias("is_topic_outlier"))
    rows = rows.withColumn("suspicious_label", ((F.col("sentiment_star_divergence") > 1.0) | (F.col("cool") == 1)).cast("int")).persist()
    more = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(4)))).drop("copy")
    once, often = models.feature_buckets(rows), models.feature_buckets(more)
    a, b = models.bucketed_rows(rows, once), models.bucketed_rows(more, once)
    assert once.getSplitsArray()[3][1:-1] == [1.0] and len(often.getSplitsArray()[6]) <= models.BUCKETS + 1
    assert b.count() == a.count() <= 3000 and b.agg(F.sum("weight")).first()[0] == 4 * a.agg(F.sum("weight")).first()[0] == 12000
    model = models.fit_suspicion(more, rounds=10, depth=3)
    scored = models.score_suspicion(rows, model)
    assert set(scored.columns) == {*rows.columns, "suspicion_score", "predicted"} and scored.filter(F.col("predicted") != F.col("suspicious_label")).count() <= 90
    assert scored.filter("cool = 1 and predicted = 1").count() == 15 and abs(sum(model.featureImportances.toArray()) - 1) < 1e-9


def test_merging_topics_keeps_every_document(spark):
    w = spark.createDataFrame([(t, term, float((t * 7 + i) % 5)) for t in range(6) for i, term in enumerate("abcdefgh")], "t int, term string, weight double")
    docs = spark.createDataFrame([(i, i % 6) for i in range(60)], "d int, t int")
    steps = topics.merge_order(topics.topic_gram(w, "t", docs), docs.groupBy("t").agg(F.count("*").alias("n")), "t", 3)
    out = topics.reduce_topics(docs, steps, "t")
    assert len(steps) == 3 and out.count() == 60 and out.select("reduced").distinct().count() == 3


def test_refresh_survives_a_replayed_batch(spark, matrix):
    path = scratch_path(spark, "state")
    parts = matrix.randomSplit([0.5, 0.5], 7)
    for i, p in enumerate(parts):
        p = p.persist()
        p.count()
        for _ in range(2):  # the same batch written twice counts once
            refresh.partial_sums(p).write.mode("overwrite").parquet(f"{path}/batch_id={i}")
    got = {r["business_id"]: r["manipulation_delta"] for r in refresh.read_refreshed(spark, path).collect()}
    want = {r["business_id"]: r["manipulation_delta"] for r in scoring.trust_score(matrix).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_anything_added_to_a_document_is_a_mismatch(spark, matrix):
    by = scoring.trust_score(matrix, ordered=False, extra=records.business_evidence())
    text = records.documents(records.sign_records(records.build_records(by, "2024-01-01T00:00:00Z"))).first()["value"]
    changes = [text, text[:-1] + ',"note":"x"}', text.replace('"scores":{', '"scores":{"bonus":1.0,'), text.replace('"label_agreement_rate":null,', ""),
               text.replace('"review_count":', '"review_count":"') .replace('},"limitations"', '"},"limitations"'), text.replace(',"scores"', ', "scores"')]
    got = []
    for i, t in enumerate(changes):
        path = scratch_path(spark, f"added{i}")
        spark.createDataFrame([(t,)], "value string").write.text(path)
        got.append(records.verify_records(record_store.read_records(spark, path)).first()["verified"])
    assert got == [True, False, False, False, False, True]


def test_bounds_reach_the_scan_of_a_store(spark, matrix):
    by = scoring.trust_score(matrix, ordered=False, extra=records.business_evidence())
    path = scratch_path(spark, "typed")
    record_store.write_store(records.sign_records(records.build_records(by, "2024-01-01T00:00:00Z")), path)
    from ratelens.operators import record_queries

    q = record_queries.matching(record_store.read_store(spark, path), min_delta=0.01)
    assert "GreaterThanOrEqual(scores.manipulation_delta" in q._jdf.queryExecution().executedPlan().toString()


def test_many_topics_classes_and_labels(spark):
    n = 1100
    w = spark.range(n).select(F.col("id").cast("int").alias("t"), F.explode(F.array(F.lit("x"), F.concat(F.lit("y"), (F.col("id") % 7).cast("string")))).alias("term"), (F.col("id") % 5 + 1.0).alias("weight"))
    gram = topics.topic_gram(w, "t", spark.range(n).select(F.col("id").cast("int").alias("t")))
    pairs = topics.pair_similarity(gram)
    assert pairs.count() == n * (n - 1) // 2
    assert pairs.filter((F.col("topic_a") == 3) & (F.col("topic_b") == 1005)).first()["similarity"] == pytest.approx(0.5)
    split = sampling.stratified_split(spark.range(n * 5).select("id", (F.col("id") % n).alias("y")), "y", "id")
    assert split.groupBy("split").count().filter("split = 'test'").first()["count"] == n
    labels = spark.createDataFrame([(f"label {i}", [float(i == j) for j in range(600)]) for i in range(600)], "label string, label_vec array<double>")
    docs = spark.createDataFrame([(1, [float(j == 599) for j in range(600)]), (2, [0.0] * 600), (3, None)], "d int, v array<double>")
    got = {r["d"]: r["assigned"] for r in topics.zero_shot_assign(docs, "d", "v", labels, "label").collect()}
    assert got == {1: "label 599", 2: None, 3: None}


def test_sample_is_the_first_rows_in_hash_order(spark):
    df = spark.range(500).select("id", F.lit("text").alias("text"))
    want = [r["id"] for r in df.orderBy(sampling.hash_order("id"), "id").limit(70).collect()]
    got = sampling.hash_sample(df, "id", 70)
    assert sorted(r["id"] for r in got.collect()) == sorted(want)
    assert "TakeOrdered" not in got._jdf.queryExecution().executedPlan().toString()
    assert sampling.hash_sample(df, "id", 500).count() == sampling.hash_sample(df, "id", 900).count() == 500
    assert sampling.hash_sample(df.limit(0), "id", 5).count() == 0


def test_daily_counts_hold_late_rows_and_last_days(spark):
    path = scratch_path(spark, "days")
    days = ["2024-01-05", "2024-01-01", "2024-01-09", "2024-01-01"]
    stream_in = f"{path}/in"
    for d in days:
        spark.createDataFrame([("u", d)], "user_id string, d string").select("user_id", F.to_timestamp("d").alias("ts")).coalesce(1).write.mode("append").parquet(stream_in)
        stream = spark.readStream.schema("user_id string, ts timestamp").parquet(stream_in)
        refresh.run_daily_counts(stream, f"{path}/state", f"{path}/checkpoint")
    got = {str(r["day"]): r["n"] for r in refresh.read_daily_counts(spark, f"{path}/state").collect()}
    assert got == {"2024-01-01": 2, "2024-01-05": 1, "2024-01-09": 1}


def test_compacted_sums_do_not_count_twice(spark, matrix):
    path = scratch_path(spark, "sums")
    for i, p in enumerate(matrix.randomSplit([0.5, 0.5], 3)):
        refresh.partial_sums(p).write.mode("overwrite").parquet(f"{path}/batch_id={i}")
    before = sorted(map(tuple, refresh.read_refreshed(spark, path).select("business_id", "review_count").collect()))
    for _ in range(2):
        refresh.compact(spark, path, f"{path}-compact")
    assert sorted(map(tuple, refresh.read_refreshed(spark, f"{path}-compact").select("business_id", "review_count").collect())) == before
    with pytest.raises(ValueError):
        refresh.compact(spark, path, path)


def test_repeated_topic_rows_do_not_repeat_reviews(spark, scored):
    twice = spark.createDataFrame([("r1", 3, 0), ("r1", 2, 0), ("r2", 1, 0)], "review_id string, topic_id int, is_topic_outlier int")
    assert features.feature_matrix(scored, twice, need=("stars",)).count() == 900
