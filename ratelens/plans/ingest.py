"""Sources, sinks, cleaning, filters and joins (inventory 2.1 - 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens import workflow
from ratelens.config import FEATURES
from ratelens.functions.text import is_nonempty
from ratelens.operators import cleaning, features, lookups, profile, records, scoring, terms, topics
from ratelens.plans.registry import query
from ratelens.plans.views import (
    COMPUTED_AT,
    RULES,
    clean_reviews,
    day,
    document_topics,
    label_cache,
    number_features,
    number_reviews,
    rounded,
    scored_numbers,
    scored_text,
    table,
    text_features,
    text_reviews,
    word_lists,
)
from ratelens.session import scratch_path
from ratelens.sources import record_store, reviews, split_csv, vectors, versions

_CSV_DATE = "M/d/yyyy H:mm"


@query("csv_scan_roundtrip", """SELECT review_id, user_id, business_id, stars, useful, funny, cool, md5(text) AS text_md5,
  strftime(date, '%Y-%m-%d') AS day FROM rt""", "rt")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    out = text_reviews(spark, sf).drop("doc_id").withColumn("date", F.date_format("date", _CSV_DATE))
    reviews.write_csv(out, path)
    return reviews.load_reviews(spark, path).withColumns({"text_md5": F.md5("text"), "day": day("date")}).drop("text", "date")


@query("csv_split_scan", """SELECT review_id, user_id, business_id, stars, useful, md5(chr(10) || text || chr(10) || '"' || business_id || '",' || chr(10) || chr(10) || 'end') AS text_md5,
  strftime(date, '%Y-%m-%d') AS day FROM rt""", "rt")
def _(spark, sf):
    """Quoted text over several lines, read by splits and not by files."""
    path = scratch_path(spark, "csv-split")
    said = F.concat(F.lit("\n"), "text", F.lit('\n"'), "business_id", F.lit('",\n\nend'))
    out = text_reviews(spark, sf).drop("doc_id").withColumns({"text": said, "date": F.date_format("date", _CSV_DATE)})
    reviews.write_csv(out, path)
    got = cleaning.typed_reviews(split_csv.read_split_csv(spark, path, reviews.RAW_REVIEWS), _CSV_DATE)
    return got.select("review_id", "user_id", "business_id", "stars", "useful", F.md5("text").alias("text_md5"), day("date").alias("day"))


@query("store_upserts", """SELECT o_custkey AS customer, max(o_orderkey) AS last_order, 3 AS versions, true AS first_kept FROM orders GROUP BY 1""")
def _(spark, sf):
    """The last order of each customer in a versioned table: batches in order of keys, one of them replayed, then compacted."""
    root = scratch_path(spark, "last-orders")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("last_order"))
    middle = orders.agg(F.expr("(min(last_order) + max(last_order)) div 2")).scalar()
    versions.upsert(orders.filter(F.col("last_order") <= middle), root, "customer", mark=("orders", 0))
    first = versions.read(spark, root, key="customer", version=1).agg(F.max("last_order")).scalar()
    for batch in (1, 1):
        versions.upsert(orders.filter(F.col("last_order") > middle), root, "customer", mark=("orders", batch))
    last = versions.compact(spark, root, "customer")
    kept = versions.read(spark, root, key="customer", version=1).agg(F.max("last_order") == first).scalar()
    return versions.read(spark, root, key="customer").withColumns({"versions": F.lit(last), "first_kept": kept})


@query("missing_columns", """SELECT c.column_name, (SELECT count(*) FROM documents) AS n_rows
  FROM (VALUES ('cool'), ('date')) AS c(column_name)""")
def _(spark, sf):
    df = text_reviews(spark, sf).drop("cool", "date")
    gap = cleaning.missing_columns(df)
    return df.agg(F.count("*").alias("n_rows")).select(F.explode(F.array(*[F.lit(c) for c in gap])).alias("column_name"), "n_rows")


@query("typed_reviews", """SELECT review_id, stars, useful, funny, cool,
  CASE WHEN doc_id % 50 <> 0 THEN strftime(date, '%Y-%m-%d %H:%M:%S') END AS ts FROM rt""", "rt")
def _(spark, sf):
    raw = text_reviews(spark, sf).withColumn(
        "date", F.when(F.col("doc_id") % 50 == 0, "not a date").otherwise(F.date_format("date", _CSV_DATE))
    ).withColumns({c: F.col(c).cast("string") for c in ("stars", "useful", "funny", "cool")})
    return cleaning.typed_reviews(raw).select(
        "review_id", "stars", "useful", "funny", "cool", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("ts")
    )


@query("row_count_expectation", """SELECT 'raw' AS expectation, (SELECT count(DISTINCT doc_id) FROM documents) AS expected, count(*) AS actual, count(*) = (SELECT count(DISTINCT doc_id) FROM documents) AS ok FROM rt
  UNION ALL SELECT 'clean', (SELECT count(DISTINCT doc_id) FROM documents), count(*), count(*) = (SELECT count(DISTINCT doc_id) FROM documents) FROM rtc""", "rtc")
def _(spark, sf):
    """The documents say how many reviews to expect; cleaning drops some, so its expectation is not met."""
    expected = table(spark, sf, "documents").agg(F.count_distinct("doc_id")).first()[0]
    return cleaning.row_count_expectation(text_reviews(spark, sf), expected, "raw").unionByName(
        cleaning.row_count_expectation(clean_reviews(spark, sf), expected, "clean")
    )


@query("ingest_event", """SELECT 'ingest' AS receipt_type, 'default-tenant' AS tenant_id, 'csv' AS source_type,
  'reviews.csv' AS source_path, count(*) AS row_count FROM rtc""", "rtc")
def _(spark, sf):
    return cleaning.ingest_event(clean_reviews(spark, sf), "reviews.csv")


@query("receipt_store_scan", """SELECT business_id, review_count, round(manipulation_delta, 3) AS manipulation_delta,
  '2024-01-01T00:00:00Z' AS computed_at FROM tcovered""", "tcovered")
def _(spark, sf):
    """A store with stale copies in an earlier file and unreadable documents in another."""
    path = scratch_path(spark, "store")
    by = scoring.trust_score(scoring.label_as_score(text_features(spark, sf)), ordered=False, extra=records.business_evidence())
    covered = scoring.coverage(by)
    for folder, stamp in (("a", "2020-01-01T00:00:00Z"), ("b", COMPUTED_AT)):
        record_store.write_records(records.sign_records(records.build_records(covered, stamp)), f"{path}/{folder}")
    covered.select(F.concat(F.lit("{broken "), F.col("business_id")).alias("value")).write.text(f"{path}/c")
    store = records.typed(record_store.read_records(spark, path))
    return store.select("business_id", F.col("input.review_count").alias("review_count"),
                        F.round("scores.manipulation_delta", 3).alias("manipulation_delta"), "computed_at")


@query("json_field_extract", """SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS sum_k, min(k) AS min_k, max(k) AS max_k
  FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY event_type""")
def _(spark, sf):
    k = F.from_json("props", "k int")["k"]
    return table(spark, sf, "events").select("event_type", k.alias("k")).groupBy("event_type").agg(
        F.count("k").alias("n"), F.sum("k").alias("sum_k"), F.min("k").alias("min_k"), F.max("k").alias("max_k")
    )


@query("optional_input_status", """SELECT 'labels' AS input, 'available' AS status, count(*) AS n_rows FROM labels
  UNION ALL SELECT 'topics', 'not available', 0::BIGINT""")
def _(spark, sf):
    path = scratch_path(spark, "optional")
    reviews.write_csv(table(spark, sf, "labels"), f"{path}/labels")
    schema = table(spark, sf, "labels").schema
    out = None
    for name in ("labels", "topics"):
        df, there = reviews.read_optional_csv(spark, f"{path}/{name}", schema)
        row = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("input"), F.lit("available" if there else "not available").alias("status"), "n_rows"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("vector_text_scan", """SELECT CAST(vec_id AS VARCHAR) AS term, len(embedding) AS dim,
  round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total FROM embeddings""")
def _(spark, sf):
    path = scratch_path(spark, "vectors")
    vectors.write_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding", path)
    total = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return vectors.read_vectors(spark, path).select("term", F.size("vector").cast("long").alias("dim"), F.round(total, 6).alias("total"))


@query("receipt_sink_partitions", "SELECT business_id, 1::BIGINT AS n_documents FROM tcovered", "tcovered")
def _(spark, sf):
    """One folder per business; the folder name is read back as the partition column."""
    path = scratch_path(spark, "per-key")
    by = scoring.trust_score(scoring.label_as_score(text_features(spark, sf)), ordered=False, extra=records.business_evidence())
    record_store.write_records(records.sign_records(records.build_records(scoring.coverage(by), COMPUTED_AT)), path, one_per_key=True)
    return spark.read.text(path).groupBy("business_id").agg(F.count("*").alias("n_documents"))


@query("summary_payload", """SELECT (SELECT count(*) FROM tfeat) AS n_reviews, (SELECT count(*) FROM ttrust) AS n_businesses,
  (SELECT least(10, count(*)) FROM ttrust) AS n_top, (SELECT count(*) FROM tcovered) AS n_records,
  (SELECT business_id FROM ttrust ORDER BY manipulation_delta DESC, business_id DESC LIMIT 1) AS first_business,
  (SELECT round(avg(suspicious) * 100, 6) FROM tfeat) AS headline_pct""", "tfeat", "tcovered", "ttrust")
def _(spark, sf):
    result = workflow.run(clean_reviews(spark, sf), RULES, COMPUTED_AT, topics=document_topics(spark, sf), fit_model=False, plain=True)
    doc = F.from_json("payload", """stats struct<n_reviews: bigint, n_businesses_scored: bigint, headline_pct: double, records_written: bigint>,
        top array<struct<business_id: string, manipulation_delta: double>>, records array<struct<business_id: string>>""")
    return workflow.summary_payload(result).select(doc.alias("d")).select(
        F.col("d.stats.n_reviews").alias("n_reviews"), F.col("d.stats.n_businesses_scored").alias("n_businesses"),
        F.size("d.top").cast("long").alias("n_top"), F.size("d.records").cast("long").alias("n_records"),
        F.get("d.top.business_id", F.lit(0)).alias("first_business"), F.round("d.stats.headline_pct", 6).alias("headline_pct"),
    )


@query("event_envelope", """SELECT 'label_call' AS receipt_type, '2024-01-01T00:00:00Z' AS ts, 'default-tenant' AS tenant_id,
  sha256('{"input_chars":' || n_chars || ',"model":"m1","review_id":"r' || doc_id || '"}') AS sha256,
  'r' || doc_id AS review_id, 'm1' AS model, n_chars AS input_chars FROM documents""")
def _(spark, sf):
    calls = table(spark, sf, "documents").select(
        F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("review_id"), F.lit("m1").alias("model"), F.col("n_chars").alias("input_chars")
    )
    out = records.event_envelope(calls, "label_call", COMPUTED_AT, calls.schema)
    return out.select("receipt_type", "ts", "tenant_id", F.col("payload_hash.sha256").alias("sha256"), "review_id", "model", "input_chars")


@query("event_log_append", """SELECT receipt_type, '2024-01-01T00:00:00Z' AS ts, tenant_id, count(*) AS n, count(*) AS n_signed FROM
  (SELECT event_type AS receipt_type, 'default-tenant' AS tenant_id FROM events UNION ALL SELECT 'ingest', 'default-tenant') GROUP BY ALL""")
def _(spark, sf):
    """Two appends of event envelopes to one log, read back by type; a digest belongs to each."""
    path = scratch_path(spark, "log")
    ev = table(spark, sf, "events").select("event_type", "event_id", "user_id")
    payload = ev.select("event_id", "user_id").schema
    done = records.event_envelope(ev, "event", COMPUTED_AT, payload)
    typed = ev.select("event_id", F.col("event_type").alias("receipt_type"))
    record_store.append_events(done.drop("receipt_type").join(typed, "event_id").select("receipt_type", *[c for c in done.columns if c != "receipt_type"]), path)
    load = cleaning.ingest_event(table(spark, sf, "documents"), "documents").select("source_type", "source_path", "row_count")
    record_store.append_events(records.event_envelope(load, "ingest", COMPUTED_AT, load.schema), path)
    log = spark.read.schema("receipt_type string, ts string, tenant_id string, payload_hash struct<sha256: string, sha512: string>").json(path)
    return log.groupBy("receipt_type", "ts", "tenant_id").agg(F.count("*").alias("n"), F.count_if(F.length("payload_hash.sha256") == 64).alias("n_signed"))


@query("clean_corrupted", "SELECT review_id, business_id, user_id, stars FROM rtc", "rtc")
def _(spark, sf):
    return clean_reviews(spark, sf).select("review_id", "business_id", "user_id", "stars")


@query("corruption_report", """SELECT count(*) AS n_rows, count(*) FILTER (WHERE business_id = '#NAME?') AS bad_business_id,
  count(*) FILTER (WHERE review_id = '#NAME?') AS bad_review_id,
  count(*) FILTER (WHERE review_id = '#NAME?' OR business_id = '#NAME?') AS bad_either,
  count(*) FILTER (WHERE review_id <> '#NAME?' AND business_id <> '#NAME?') AS n_clean FROM rt""", "rt")
def _(spark, sf):
    return cleaning.corruption_report(text_reviews(spark, sf))


@query("star_subsets", """SELECT 'negative' AS subset, review_id, stars FROM rtc WHERE stars = 1
  UNION ALL SELECT 'positive', review_id, stars FROM rtc WHERE stars = 5""", "rtc")
def _(spark, sf):
    r = clean_reviews(spark, sf).filter(F.col("stars").isin(1, 5))
    return r.select(F.when(F.col("stars") == 1, "negative").otherwise("positive").alias("subset"), "review_id", "stars")


@query("binary_sentiment", "SELECT review_id, stars, CASE WHEN stars > 3 THEN 1 ELSE 0 END AS sentiment FROM rtc WHERE stars <> 3", "rtc")
def _(spark, sf):
    return clean_reviews(spark, sf).filter(F.col("stars") != 3).select(
        "review_id", "stars", F.when(F.col("stars") > 3, 1).otherwise(0).alias("sentiment")
    )


@query("features_dropna", """SELECT s.review_id, s.stars, round(s.sentiment_star_divergence, 6) AS sentiment_star_divergence, s.suspicious AS suspicious_label
  FROM scored s WHERE stars <> 2""", "scored")
def _(spark, sf):
    """Scores of two-star reviews are null; these reviews lose their features and are dropped."""
    r = clean_reviews(spark, sf)
    known = F.col("stars") != 2
    stored = scored_text(spark, sf).withColumns({c: F.when(known, F.col(c)) for c in ("vader_compound", "sentiment_star_divergence")})
    f = features.feature_matrix(features.join_sentiment(r, stored))
    return rounded(f.select("review_id", "stars", "sentiment_star_divergence", "suspicious_label"), "sentiment_star_divergence")


@query("divergence_flag", """SELECT suspicious, stars, count(*) AS n, round(min(sentiment_star_divergence), 6) AS lo,
  round(max(sentiment_star_divergence), 6) AS hi FROM rns GROUP BY ALL""", "rns")
def _(spark, sf):
    return rounded(scored_numbers(spark, sf).groupBy("suspicious", "stars").agg(
        F.count("*").alias("n"), F.min("sentiment_star_divergence").alias("lo"), F.max("sentiment_star_divergence").alias("hi")
    ), "lo", "hi")


@query("min_reviews_having", "SELECT business_id, count(review_id) AS review_count FROM rn GROUP BY business_id HAVING count(review_id) >= 38", "rn")
def _(spark, sf):
    return number_reviews(spark, sf).groupBy("business_id").agg(F.count("review_id").alias("review_count")).filter(F.col("review_count") >= 38)


@query("anchor_candidates", """SELECT user_id AS business_id, count(review_id) AS review_count, round(avg(stars), 6) AS avg_stars FROM rn
  GROUP BY user_id HAVING count(review_id) >= 10 AND avg(stars) >= 4.0 ORDER BY review_count DESC, business_id LIMIT 5""", "rn")
def _(spark, sf):
    r = number_reviews(spark, sf).drop("business_id").withColumnRenamed("user_id", "business_id")
    return rounded(scoring.anchor_candidates(r), "avg_stars")


@query("topic_membership_semi", """SELECT topic_id, count(*) AS n FROM rntopics WHERE topic_id IN
  (SELECT topic_id FROM rntopics WHERE topic_id <> -1 GROUP BY topic_id ORDER BY count(*) DESC, topic_id LIMIT 3) GROUP BY topic_id""", "rntopics")
def _(spark, sf):
    from ratelens.plans.views import number_topics

    t = number_topics(spark, sf)
    top = topics.topic_info(t).limit(3)
    return lookups.members(t, top, "topic_id").groupBy("topic_id").agg(F.count("*").alias("n"))


@query("nonempty_text", r"""SELECT role, count(*) AS n, count(*) FILTER (WHERE regexp_matches(text, '\S')) AS n_text
  FROM conversations GROUP BY role""")
def _(spark, sf):
    return table(spark, sf, "conversations").groupBy("role").agg(F.count("*").alias("n"), F.count_if(is_nonempty(F.col("text"))).alias("n_text"))


@query("features_left_join", """SELECT r.review_id, r.stars, round(s.vader_compound, 6) AS vader_compound, s.suspicious
  FROM rtc r LEFT JOIN scored s ON r.review_id = s.review_id AND s.stars <> 2""", "rtc", "scored")
def _(spark, sf):
    """Scores of two-star reviews are stored under another id, so these reviews find none."""
    stored = scored_text(spark, sf).withColumn("review_id", F.when(F.col("stars") == 2, F.concat(F.lit("x"), "review_id")).otherwise(F.col("review_id")))
    out = features.join_sentiment(clean_reviews(spark, sf).select("review_id", "stars"), stored)
    return rounded(out.select("review_id", "stars", "vader_compound", "suspicious"), "vader_compound")


@query("topics_left_join", """SELECT r.review_id, coalesce(t.topic_id, -1) AS topic_id, CASE WHEN coalesce(t.topic_id, -1) = -1 THEN 1 ELSE 0 END AS is_topic_outlier
  FROM rtc r LEFT JOIN dtopics t USING (review_id)""", "rtc", "dtopics")
def _(spark, sf):
    return features.join_topics(clean_reviews(spark, sf).select("review_id"), document_topics(spark, sf))


@query("agg_inner_join", """SELECT a.business_id, a.n, round(b.mean_useful, 6) AS mean_useful FROM
  (SELECT business_id, count(*) AS n FROM rn WHERE stars >= 4 GROUP BY 1) a JOIN
  (SELECT business_id, avg(useful) AS mean_useful FROM rn WHERE stars <= 2 GROUP BY 1) b USING (business_id)""", "rn")
def _(spark, sf):
    r = number_reviews(spark, sf)
    a = r.filter(F.col("stars") >= 4).groupBy("business_id").agg(F.count("*").alias("n"))
    b = r.filter(F.col("stars") <= 2).groupBy("business_id").agg(F.avg("useful").alias("mean_useful"))
    return rounded(lookups.join_aggregates(a, b, "business_id"), "mean_useful")


@query("densify_categories", """SELECT b.source, s.stars, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT source FROM documents) b,
  (SELECT unnest(range(1, 7))::INTEGER AS stars) s LEFT JOIN (SELECT source, CAST(1 + n_chars % 5 AS INTEGER) AS stars, count(*) AS n FROM documents GROUP BY ALL) c
  ON c.source = b.source AND c.stars = s.stars""")
def _(spark, sf):
    d = table(spark, sf, "documents").select("source", (F.col("n_chars") % 5 + 1).cast("int").alias("stars"))
    counts = profile.value_counts(d, "source", "stars", ordered=False)
    spine = counts.select("source").distinct().select("source", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("stars"))
    return lookups.densify(counts, spine, ["source", "stars"], "n").select("source", "stars", "n")


@query("join_fanout_audit", """SELECT CAST(sum(n) AS BIGINT) AS left_rows, CAST(sum(n) AS BIGINT) AS right_rows, count(*) AS left_keys, count(*) AS right_keys,
  count(*) FILTER (WHERE n > 1) AS duplicate_right_keys, CAST(sum(n * n) AS BIGINT) AS join_rows, max(n) <= 1 AS right_key_unique
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return lookups.fanout_audit(li, li, "k")


@query("cache_first_match", """SELECT r.review_id, c.primary_label, c.comparator_label FROM rtc r
  LEFT JOIN (SELECT * FROM cache WHERE ord = 0) c USING (review_id)""", "rtc", "cache")
def _(spark, sf):
    return lookups.lookup_first(clean_reviews(spark, sf).select("review_id"), label_cache(spark, sf), "review_id", ["ord"],
                                ["primary_label", "comparator_label"])


@query("lookup_default", """SELECT c.c_custkey, round(coalesce(t.rate, 0.0::DOUBLE), 6) AS rate FROM customer c LEFT JOIN
  (SELECT o_custkey, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS rate FROM orders GROUP BY 1) t ON t.o_custkey = c.c_custkey""")
def _(spark, sf):
    rate = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("rate")
    )
    return rounded(lookups.lookup_default(table(spark, sf, "customer").select("c_custkey"), rate, "c_custkey", "rate"), "rate")


_INDEX = """SELECT term, n, row_number() OVER (ORDER BY n DESC, term) + 1 AS word_id FROM
  (SELECT term, count(*) AS n FROM wtok GROUP BY term ORDER BY n DESC, term LIMIT 4998)"""
_WTOK = r"SELECT doc_id, pos, term FROM (SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS term FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS ws FROM documents))"


@query("vocab_vector_coverage", f"""+wtok AS ({_WTOK}), idx AS ({_INDEX})
  SELECT count(*) AS n_terms, count(vec_id) AS n_found, count(*) - count(vec_id) AS n_missing,
    round(count(vec_id) * 100.0::DOUBLE / count(*), 6) AS pct_found,
    round(sum(coalesce(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 0.0::DOUBLE)), 4) AS checksum
  FROM idx LEFT JOIN embeddings ON vec_id = word_id""".replace("+wtok", "WITH wtok"))
def _(spark, sf):
    """The vector table covers only some word ids; other words get zeros."""
    index = terms.word_index(word_lists(table(spark, sf, "documents")), 5000)
    vec = table(spark, sf, "embeddings").select(F.col("vec_id").alias("word_id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    vec = index.select("term", "word_id").join(vec, "word_id").select("term", "vector")
    got = lookups.attach_vectors(index.select("term"), vec, 64)
    total = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x)
    return lookups.vector_coverage(got.withColumn("t", total)).withColumn(
        "checksum", F.round(got.agg(F.sum(total).alias("s")).scalar(), 4)
    ).withColumn("pct_found", F.round("pct_found", 6))


_FCOLS = """review_id, business_id, stars, useful, funny, cool, review_length_words, round(vader_compound, 6) AS vader_compound,
  round(sentiment_star_divergence, 6) AS sentiment_star_divergence, suspicious, {t}, suspicious_label"""


def _feature_columns(f):
    return rounded(f.select("review_id", "business_id", *FEATURES, "suspicious", "suspicious_label"), "vader_compound", "sentiment_star_divergence")


@query("feature_matrix", "SELECT " + _FCOLS.format(t="topic_id, is_topic_outlier") + " FROM tfeat", "tfeat")
def _(spark, sf):
    return _feature_columns(text_features(spark, sf))


@query("feature_matrix_no_topics", "SELECT " + _FCOLS.format(t="-1 AS topic_id, 1 AS is_topic_outlier") + " FROM tfeat", "tfeat")
def _(spark, sf):
    return _feature_columns(features.feature_matrix(scored_text(spark, sf), need=("stars",)))


@query("feature_matrix_volume", """SELECT topic_id, is_topic_outlier, suspicious_label, count(*) AS n, CAST(sum(review_length_words) AS BIGINT) AS words,
  round(sum(vader_compound), 4) AS compound FROM nfeat GROUP BY ALL""", "nfeat")
def _(spark, sf):
    return rounded(number_features(spark, sf).groupBy("topic_id", "is_topic_outlier", "suspicious_label").agg(
        F.count("*").alias("n"), F.sum("review_length_words").alias("words"), F.sum("vader_compound").alias("compound")
    ), "compound", digits=4)

