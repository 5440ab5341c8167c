"""Signed records and the questions asked of a record store (inventory 2.10, filters 22, lookups 32)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.config import LIMITATIONS
from ratelens.functions.canonical import canonical_json, digests
from ratelens.operators import record_queries as rq
from ratelens.operators import records, scoring
from ratelens.plans.registry import query, view
from ratelens.plans.views import (
    COMPUTED_AT,
    clean_reviews,
    dec_text_sql,
    number_features,
    number_reviews,
    py_round_sql,
    quote,
    scored_numbers,
)
from ratelens.session import scratch_path
from ratelens.sources import record_store

_STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _by_business(spark, sf) -> DataFrame:
    return scoring.trust_score(scoring.label_as_score(number_features(spark, sf)), ordered=False, extra=records.business_evidence())


def _by_user(spark, sf) -> DataFrame:
    f = scoring.label_as_score(number_features(spark, sf)).drop("business_id").withColumnRenamed("user_id", "business_id")
    return scoring.trust_score(f, min_reviews=1, ordered=False, extra=records.business_evidence())


def _signed(spark, sf, by=None) -> DataFrame:
    covered = scoring.coverage(_by_business(spark, sf)) if by is None else by
    return records.sign_records(records.build_records(covered, COMPUTED_AT))


def _store(spark, sf, by=None) -> DataFrame:
    """A record store written as JSON and read back, numbers still as text."""
    path = scratch_path(spark, "records")
    record_store.write_records(_signed(spark, sf, by), path)
    return record_store.read_records(spark, path)


def _queryable(spark, sf, by=None, signed=None) -> DataFrame:
    """The records as a typed Parquet store."""
    path = scratch_path(spark, "store")
    record_store.write_store(_signed(spark, sf, by) if signed is None else signed, path)
    return record_store.read_store(spark, path)


def _t(x: str, d: int) -> str:
    return dec_text_sql(py_round_sql(x, d), d)


_PARTS = [
    ("'{\"business_id\":\"' || business_id || '\",\"computed_at\":\"" + COMPUTED_AT + "\",\"evidence\":{\"label_agreement_rate\":null,\"mean_divergence\":' || ", "mean_divergence", 4),
    (" || ',\"mean_suspicion_score\":' || ", "mean_suspicion_score", 4),
    (" || ',\"topic_outlier_pct\":' || ", "topic_outlier_pct", 4),
]
_LIMITS = ",".join('"' + x + '"' for x in LIMITATIONS).replace("'", "''")


def body_sql(source: str) -> str:
    """The canonical text of every record, built by concatenation."""
    text = "".join(a + _t(x, d) for a, x, d in _PARTS)
    text += (
        " || '},\"input\":{\"data_source\":\"review_table\",\"date_range\":[\"' || strftime(date_min, '%Y-%m-%d') || '\",\"' || strftime(date_max, '%Y-%m-%d')"
        " || '\"],\"review_count\":' || review_count || '},\"limitations\":[" + _LIMITS + "],\"models\":{\"classifier\":{\"label_proxy\":\"sentiment_star_divergence > 1.0\","
        "\"name\":\"boosted trees\",\"version\":\"gbt-1\"},\"sentiment\":{\"name\":\"lexicon rules\",\"version\":\"lexicon-1\"},"
        "\"topic\":{\"name\":\"embedding clusters\",\"version\":\"bisecting-kmeans-1\"}},\"schema_version\":\"review-trust-1.0\",\"scores\":{\"adjusted_rating\":' || "
        + _t("adjusted_stars", 3) + " || ',\"manipulation_delta\":' || " + _t("manipulation_delta", 3) + " || ',\"raw_rating\":' || " + _t("raw_avg_stars", 3)
        + " || ',\"suspicious_review_pct\":' || " + _t("suspicion_pct", 2) + " || '},\"tenant_id\":\"default-tenant\"}'"
    )
    return f"SELECT *, {text} AS body FROM {source}"


view("nbody", body_sql("ncovered"), "ncovered")
view("nstore", f"""SELECT business_id, review_count, {py_round_sql('raw_avg_stars', 3)} AS raw_rating, {py_round_sql('adjusted_stars', 3)} AS adjusted_rating,
  {py_round_sql('manipulation_delta', 3)} AS delta, {py_round_sql('suspicion_pct', 2)} AS pct, {py_round_sql('mean_suspicion_score', 4)} AS susp,
  {py_round_sql('topic_outlier_pct', 4)} AS outlier, {py_round_sql('mean_divergence', 4)} AS divergence, date_min, date_max FROM ncovered""", "ncovered")
view("ustore", f"""SELECT business_id, {py_round_sql('manipulation_delta', 3)} AS delta, {py_round_sql('mean_suspicion_score', 4)} AS susp,
  {py_round_sql('topic_outlier_pct', 4)} AS outlier FROM utrust""", "utrust")


@query("receipt_build", """SELECT business_id, 'review-trust-1.0' AS schema_version, 'default-tenant' AS tenant_id, '2024-01-01T00:00:00Z' AS computed_at, review_count,
  strftime(date_min, '%Y-%m-%d') AS date_from, strftime(date_max, '%Y-%m-%d') AS date_to, raw_rating, adjusted_rating, delta, pct, susp, outlier, divergence, 5 AS n_limitations FROM nstore""", "nstore")
def _(spark, sf):
    r = records.typed(records.sign_records(records.build_records(scoring.coverage(_by_business(spark, sf)), COMPUTED_AT)))
    return r.select(
        "business_id", "schema_version", "tenant_id", "computed_at", F.col("input.review_count").alias("review_count"),
        F.col("input.date_range")[0].alias("date_from"), F.col("input.date_range")[1].alias("date_to"),
        F.col("scores.raw_rating").alias("raw_rating"), F.col("scores.adjusted_rating").alias("adjusted_rating"),
        F.col("scores.manipulation_delta").alias("delta"), F.col("scores.suspicious_review_pct").alias("pct"),
        F.col("evidence.mean_suspicion_score").alias("susp"), F.col("evidence.topic_outlier_pct").alias("outlier"),
        F.col("evidence.mean_divergence").alias("divergence"), F.size("limitations").alias("n_limitations"),
    )


@query("receipt_sign", "SELECT business_id, sha256(body) AS sha256, length(body) AS body_length FROM nbody", "nbody")
def _(spark, sf):
    s = _signed(spark, sf)
    return s.select("business_id", F.col("dual_hash.sha256").alias("sha256"), F.length(records.body_text()).cast("long").alias("body_length"))


@query("receipt_second_digest", "SELECT business_id, 128::BIGINT AS n_digits, true AS is_of_body, true AS differs FROM ncovered", "ncovered")
def _(spark, sf):
    """The second check engine has no SHA-512, so its properties are returned."""
    s, second = _signed(spark, sf), F.col("dual_hash.sha512")
    return s.select("business_id", F.length(second).cast("long").alias("n_digits"), (second == F.sha2(records.body_text(), 512)).alias("is_of_body"),
                    (F.substring(second, 1, 64) != F.col("dual_hash.sha256")).alias("differs"))


@query("anchor_records", """SELECT user_id AS business_id, count(review_id) AS review_count, 6 AS n_limitations, true AS outlier_is_null, true AS verified FROM rns
  GROUP BY user_id HAVING count(review_id) >= 10 AND avg(stars) >= 4.0 ORDER BY review_count DESC, business_id LIMIT 5""", "rns")
def _(spark, sf):
    """Picked, built from the divergence flag, signed, written, read and verified."""
    r = scored_numbers(spark, sf).drop("business_id").withColumnRenamed("user_id", "business_id")
    path = scratch_path(spark, "anchors")
    record_store.write_records(records.sign_records(records.anchor_records(r, COMPUTED_AT)), path)
    v = records.verify_records(record_store.read_records(spark, path))
    return v.select("business_id", F.col("input.review_count").cast("long").alias("review_count"), F.size("limitations").alias("n_limitations"),
                    F.col("evidence.topic_outlier_pct").isNull().alias("outlier_is_null"), "verified")


@query("receipt_verify", "SELECT business_id, true AS verified FROM ncovered", "ncovered")
def _(spark, sf):
    return records.verify_records(_store(spark, sf)).select("business_id", "verified")


def _tampered(spark, sf) -> DataFrame:
    """Records changed in their stored text: another rating, no second digest, added fields, a number as text, a lost field."""
    path = scratch_path(spark, "tampered")
    n = F.substring("business_id", 2, 10).cast("int")
    docs = records.documents(_signed(spark, sf)).withColumn("n", n)
    text = F.col("value")
    changes = [
        (n % 7 == 0, F.regexp_replace(text, '"raw_rating":[0-9.]+', '"raw_rating":5.0')),
        (n % 11 == 0, F.regexp_replace(text, '"sha512":"[0-9a-f]+"', '"sha512":null')),
        (n % 13 == 0, F.regexp_replace(text, r"\}$", ',"note":"added"}')),
        (n % 17 == 0, F.regexp_replace(text, r'"scores":\{', '"scores":{"bonus":1.0,')),
        (n % 19 == 0, F.regexp_replace(text, '"review_count":([0-9]+)', '"review_count":"$1"')),
        (n % 23 == 0, F.regexp_replace(text, '"label_agreement_rate":null,', "")),
    ]
    for when, changed in changes:
        docs = docs.withColumn("value", F.when(when, changed).otherwise(text))
    docs.select("value").write.text(path)
    return record_store.read_records(spark, path)


_N = "CAST(substr(business_id, 2) AS INTEGER)"
_BAD = f"({_N} % 7 = 0 AND raw_rating <> 5.0) OR " + " OR ".join(f"{_N} % {p} = 0" for p in (11, 13, 17, 19, 23))


@query("receipt_verify_tampered", f"SELECT business_id, NOT ({_BAD}) AS verified FROM nstore", "nstore")
def _(spark, sf):
    return records.verify_records(_tampered(spark, sf)).select("business_id", "verified")


@query("anomaly_rows", f"""SELECT 'receipt_verify' AS metric, -1 AS delta, 'violation' AS classification, 'halt' AS action, s.business_id, sha256(b.body) AS expected_sha256,
  CASE WHEN CAST(substr(s.business_id, 2) AS INTEGER) % 7 = 0 AND raw_rating <> 5.0 THEN 'changed' ELSE 'same' END AS actual
  FROM nstore s JOIN nbody b USING (business_id) WHERE {_BAD.replace('business_id', 's.business_id')}""", "nstore", "nbody")
def _(spark, sf):
    a = records.verification_anomalies(records.verify_records(_tampered(spark, sf)))
    return a.withColumn("actual", F.when(F.col("actual_sha256") == F.col("expected_sha256"), "same").otherwise("changed")).drop("actual_sha256")


@query("balance_anomaly", """SELECT 'classifier_class_balance' AS metric, -1 AS delta, 'degradation' AS classification, 'alert' AS action, 0::BIGINT AS n_positive
  FROM (SELECT count(*) AS n FROM rn) WHERE n > 0""", "rn")
def _(spark, sf):
    """No divergence can exceed two, so with that threshold the label has one class."""
    return records.balance_anomaly(scored_numbers(spark, sf).withColumn("suspicious_label", (F.col("sentiment_star_divergence") > 2.0).cast("int")))


@query("verify_with_missing", """SELECT b.business_id, CASE WHEN n.business_id IS NULL THEN 'missing' ELSE 'verified' END AS status,
  CASE WHEN n.business_id IS NOT NULL THEN substr(sha256(n.body), 1, 16) || '...' END AS sha256
  FROM (SELECT DISTINCT business_id FROM rn) b LEFT JOIN nbody n USING (business_id)""", "rn", "nbody")
def _(spark, sf):
    ids = number_reviews(spark, sf).select("business_id").distinct()
    return rq.verify_chain(_store(spark, sf), ids).drop("sha512")


@query("verify_summary", f"""SELECT (SELECT count(DISTINCT business_id) FROM rn) AS total_checked, count(*) FILTER (WHERE NOT ({_BAD})) AS verified,
  (SELECT count(DISTINCT business_id) FROM rn) - count(*) FILTER (WHERE NOT ({_BAD})) AS failed FROM nstore""", "rn", "nstore")
def _(spark, sf):
    ids = number_reviews(spark, sf).select("business_id").distinct()
    return rq.verify_summary(rq.verify_chain(_tampered(spark, sf), ids))


@query("topology_class", """SELECT u.business_id, CASE WHEN s.business_id IS NULL THEN 'no_receipt' WHEN abs(delta) >= 0.85 AND susp > 0.75 THEN 'OPEN' WHEN outlier > 0.70 THEN 'HYBRID' ELSE 'CLOSED' END AS topology,
  coalesce(delta, 0.0::DOUBLE) AS e_delta, coalesce(susp, 0.0::DOUBLE) AS a_suspicion, coalesce(outlier, 0.0::DOUBLE) AS t_outlier
  FROM (SELECT 'u' || c_custkey AS business_id FROM customer UNION SELECT business_id FROM ustore) u LEFT JOIN ustore s USING (business_id)""", "ustore")
def _(spark, sf):
    """Records per reviewer: few reviews each, so every class occurs; unknown customers have no record."""
    from ratelens.plans.views import table

    store = _queryable(spark, sf, _by_user(spark, sf))
    ids = table(spark, sf, "customer").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("business_id"))
    return rq.classify(store, ids.union(store.select("business_id")).distinct())


_Q = "SELECT business_id, delta, pct FROM nstore WHERE {} ORDER BY coalesce(delta, 0) DESC, business_id LIMIT {}"


def _answer(spark, sf, limit=20, **bounds):
    q = rq.query_records(_queryable(spark, sf), limit, **bounds)
    return q.select("business_id", F.col("scores.manipulation_delta").alias("delta"), F.col("scores.suspicious_review_pct").alias("pct"))


@query("query_receipts_by_id", _Q.format("business_id = 'b1'", 20), "nstore")
def _(spark, sf):
    return _answer(spark, sf, business_id="b1")


@query("query_receipts_min_delta", _Q.format("delta >= 0.02", 20), "nstore")
def _(spark, sf):
    return _answer(spark, sf, min_delta=0.02)


@query("query_receipts_max_delta", _Q.format("delta <= 0.0 AND delta >= -0.1", 15), "nstore")
def _(spark, sf):
    return _answer(spark, sf, 15, max_delta=0.0, min_delta=-0.1)


@query("query_receipts_min_suspicion", _Q.format("pct >= 30.0", 20), "nstore")
def _(spark, sf):
    return _answer(spark, sf, min_suspicion_pct=30.0)


@query("query_receipts_date", _Q.format("strftime(date_max, '%Y-%m-%dT%H:%M:%SZ') >= '2001'", 20), "nstore")
def _(spark, sf):
    """Records stamped with the date of their last review, so the text comparison splits the store."""
    covered = scoring.coverage(_by_business(spark, sf))
    stamped = records.build_records(covered, COMPUTED_AT).join(covered.select("business_id", F.date_format("date_max", _STAMP).alias("stamp")), "business_id")
    stamped = stamped.withColumn("computed_at", F.col("stamp")).drop("stamp")
    q = rq.query_records(_queryable(spark, sf, signed=records.sign_records(stamped)), 20, date_after="2001")
    return q.select("business_id", F.col("scores.manipulation_delta").alias("delta"), F.col("scores.suspicious_review_pct").alias("pct"))


@query("query_receipts_limitation", _Q.format("review_count % 3 = 0", 20), "nstore")
def _(spark, sf):
    """A third of the records, by their number of reviews, carry a limitation of their own."""
    covered, more = scoring.coverage(_by_business(spark, sf)), "counts rounded"
    third = F.col("review_count") % 3 == 0
    built = records.build_records(covered.filter(third), COMPUTED_AT, extra_limitations=(more,))
    built = built.unionByName(records.build_records(covered.filter(~third), COMPUTED_AT))
    q = rq.query_records(_queryable(spark, sf, signed=records.sign_records(built)), 20, limitation=more)
    return q.select("business_id", F.col("scores.manipulation_delta").alias("delta"), F.col("scores.suspicious_review_pct").alias("pct"))


@query("query_summary", """SELECT (SELECT count(*) FROM nstore) AS total_in_store, count(*) AS match_count, least(20, count(*)) AS returned FROM nstore WHERE delta >= 0.02""", "nstore")
def _(spark, sf):
    return rq.query_summary(_queryable(spark, sf), 20, min_delta=0.02)


@query("canonical_json", r"""SELECT review_id, '{"business_id":' || to_json(business_id) || ',"labels":[' || stars || ',' || useful || '],"review_id":' || to_json(review_id) || ',"scores":{"cool":' || cool || ',"missing":null}}' AS canonical FROM rtc""", "rtc")
def _(spark, sf):
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("review_id", T.StringType()), T.StructField("business_id", T.StringType()),
        T.StructField("scores", T.StructType([T.StructField("missing", T.DoubleType()), T.StructField("cool", T.IntegerType())])),
        T.StructField("labels", T.ArrayType(T.IntegerType())),
    ])
    r = clean_reviews(spark, sf)
    raw = r.select(
        "review_id", "business_id",
        F.struct(F.lit(None).cast("string").alias("missing"), F.col("cool").cast("string").alias("cool")).alias("scores"),
        F.array(F.col("stars").cast("string"), F.col("useful").cast("string")).alias("labels"),
    )
    return raw.select("review_id", F.expr(canonical_json(schema)).alias("canonical"))


@query("sha256_text", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def _(spark, sf):
    from ratelens.plans.views import table

    return table(spark, sf, "documents").select("doc_id", F.expr(digests("text"))["sha256"].alias("sha256"))


@query("merkle_root", """RECURSIVE +leaf AS (SELECT sha256(body) AS h, row_number() OVER (ORDER BY sha256(body)) - 1 AS pos FROM nbody),
  tree AS (SELECT 0 AS lvl, h, pos, (SELECT count(*) FROM leaf) AS n FROM leaf
  UNION ALL SELECT lvl + 1, sha256(h || coalesce(nxt, h)), pos // 2, (n + 1) // 2 FROM (SELECT *, lead(h) OVER (ORDER BY pos) AS nxt FROM tree) WHERE n > 1 AND pos % 2 = 0)
  SELECT h AS merkle_root, (SELECT count(*) FROM leaf) AS n_leaves FROM tree WHERE n = 1""", "nbody")
def _(spark, sf):
    return records.merkle_root(_signed(spark, sf).select(F.col("dual_hash.sha256").alias("h")), "h")
