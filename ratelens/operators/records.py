"""Signed per-business records: build, sign, verify."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.config import ANCHOR_COUNT, ANCHOR_LIMITATION, DATA_SOURCE, LIMITATIONS, MODELS, SCHEMA_VERSION, TENANT_ID
from ratelens.functions.bind import bind
from ratelens.functions.canonical import canonical_json, digests
from ratelens.functions.numbers import decimal_text, round_half_even_exact
from ratelens.operators.scoring import anchor_candidates, first_order_scores


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


_S, _D = T.StringType(), T.DoubleType()
_MODEL = _struct(name=_S, version=_S)

BODY_SCHEMA = _struct(
    schema_version=_S, tenant_id=_S, business_id=_S, computed_at=_S,
    input=_struct(review_count=T.LongType(), date_range=T.ArrayType(_S), data_source=_S),
    scores=_struct(raw_rating=_D, adjusted_rating=_D, manipulation_delta=_D, suspicious_review_pct=_D),
    evidence=_struct(mean_divergence=_D, topic_outlier_pct=_D, label_agreement_rate=_D, mean_suspicion_score=_D),
    models=_struct(sentiment=_MODEL, topic=_MODEL, classifier=_struct(name=_S, version=_S, label_proxy=_S)),
    limitations=T.ArrayType(_S),
)
RECORD_SCHEMA = T.StructType([*BODY_SCHEMA.fields, T.StructField("dual_hash", _struct(sha256=_S, sha512=_S), True)])


def business_evidence() -> dict[str, Column]:
    """Aggregates a record needs beside the trust score, to be computed in the same grouping."""
    return {
        "date_min": F.min("date"), "date_max": F.max("date"),
        "mean_divergence": F.avg("sentiment_star_divergence"),
        "topic_outlier_pct": F.avg(F.col("is_topic_outlier").cast("double")),
    }


def build_records(covered: DataFrame, computed_at: str, *, agreement_rate: Column | None = None,
                  tenant: str = TENANT_ID, schema_version: str = SCHEMA_VERSION, data_source: str = DATA_SOURCE,
                  models: dict = MODELS, limitations: Sequence[str] = LIMITATIONS,
                  extra_limitations: Sequence[str] = ()) -> DataFrame:
    """One unsigned record per covered business. Numbers are carried as their final text.

    `computed_at` is a job parameter, so a rerun gives the same bytes.
    """
    def num(c: str, digits: int) -> Column:
        return F.expr(decimal_text(round_half_even_exact(c, digits), digits))

    def model(m: dict) -> Column:
        return F.struct(*[F.lit(v).alias(k) for k, v in m.items()])

    text = [*limitations, *extra_limitations]
    if agreement_rate is None:
        rate = F.lit(None).cast("string")
    else:
        covered, rate = covered.withColumn("_rate", agreement_rate), num("_rate", 6)
    return covered.select(
        F.lit(schema_version).alias("schema_version"), F.lit(tenant).alias("tenant_id"), "business_id",
        F.lit(computed_at).alias("computed_at"),
        F.struct(
            F.col("review_count").cast("string").alias("review_count"),
            F.array(F.date_format("date_min", "yyyy-MM-dd"), F.date_format("date_max", "yyyy-MM-dd")).alias("date_range"),
            F.lit(data_source).alias("data_source"),
        ).alias("input"),
        F.struct(
            num("raw_avg_stars", 3).alias("raw_rating"), num("adjusted_stars", 3).alias("adjusted_rating"),
            num("manipulation_delta", 3).alias("manipulation_delta"), num("suspicion_pct", 2).alias("suspicious_review_pct"),
        ).alias("scores"),
        F.struct(
            num("mean_divergence", 4).alias("mean_divergence"), num("topic_outlier_pct", 4).alias("topic_outlier_pct"),
            rate.alias("label_agreement_rate"), num("mean_suspicion_score", 4).alias("mean_suspicion_score"),
        ).alias("evidence"),
        F.struct(*[model(m).alias(k) for k, m in models.items()]).alias("models"),
        F.array(*[F.lit(x) for x in text]).alias("limitations"),
    )


def anchor_records(reviews: DataFrame, computed_at: str, k: int = ANCHOR_COUNT, **options) -> DataFrame:
    """Unsigned first-order records of the k most reviewed, well rated businesses.

    Only the divergence flag is known at this point: topic and label evidence is null, the flag's share stands for the
    suspicion score, and the record says so in a limitation of its own.
    """
    picked = anchor_candidates(reviews, k).select("business_id")
    flags = reviews.join(picked, "business_id", "left_semi")
    first = first_order_scores(flags).select(
        "business_id", "review_count", "raw_avg_stars", "adjusted_stars",
        (F.col("raw_avg_stars") - F.col("adjusted_stars")).alias("manipulation_delta"),
        F.col("suspicious_review_pct").alias("suspicion_pct"), (F.col("suspicious_review_pct") / 100.0).alias("mean_suspicion_score"),
        "mean_divergence", F.lit(None).cast("double").alias("topic_outlier_pct"), "date_min", "date_max",
    )
    return build_records(first, computed_at, extra_limitations=(ANCHOR_LIMITATION,), **options)


def body_text(schema: T.StructType = BODY_SCHEMA) -> Column:
    """Canonical JSON of a record without its signature."""
    return F.expr(canonical_json(schema))


def sign_records(records: DataFrame, schema: T.StructType = BODY_SCHEMA) -> DataFrame:
    """Add the two digests; an existing signature is replaced."""
    return records.withColumn("dual_hash", F.expr(digests(canonical_json(schema))))


def documents(signed: DataFrame, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """Key and JSON document of every record, as written to a store."""
    return signed.select("business_id", F.expr(canonical_json(schema)).alias("value"))


def verify_records(signed: DataFrame, schema: T.StructType = BODY_SCHEMA, document: str = "document") -> DataFrame:
    """Add `verified`: both stored digests are there and equal the recomputed ones, and nothing else was stored.

    Digests are recomputed from the fields of the schema. If the stored text is there, it must also hold just these fields
    with these types: an added or removed field or a number turned into a text is a mismatch. Order of keys and blanks do
    not matter.
    """
    same = "now.sha256 = dual_hash.sha256 and now.sha512 = dual_hash.sha512"
    good = F.expr(f"coalesce({bind(digests(canonical_json(schema)), 'now', same)}, false)")
    if document in signed.columns:
        whole = T.StructType([*schema.fields, RECORD_SCHEMA["dual_hash"]])
        stored, read = F.try_parse_json(document), F.try_parse_json(F.expr(canonical_json(whole)))
        good = good & F.coalesce(F.to_json(stored) == F.to_json(read), F.lit(False))
    return signed.withColumn("verified", good)


def typed(raw: DataFrame, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """Numbers of a raw record table cast to their types, for filtering."""
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def event_envelope(df: DataFrame, event_type: str, ts: str, payload: T.StructType, tenant: str = TENANT_ID) -> DataFrame:
    """Wrap rows as events: type, time, tenant, digest of the payload, then the payload itself."""
    has_tenant = "tenant_id" in df.columns
    return df.select(
        F.lit(event_type).alias("receipt_type"), F.lit(ts).alias("ts"),
        (F.coalesce(F.col("tenant_id"), F.lit(tenant)) if has_tenant else F.lit(tenant)).alias("tenant_id"),
        F.expr(digests(canonical_json(payload))).alias("payload_hash"),
        *[f.name for f in payload.fields if f.name != "tenant_id"],
    )


def verification_anomalies(verified: DataFrame) -> DataFrame:
    """One row per record that fails verification, with expected and actual digest."""
    # Metric, classification and action names of an anomaly.
    return verified.filter(~F.col("verified")).select(
        F.lit("receipt_verify").alias("metric"), F.lit(-1).alias("delta"), F.lit("violation").alias("classification"),
        F.lit("halt").alias("action"), "business_id",
        F.col("dual_hash.sha256").alias("expected_sha256"), F.sha2(body_text(), 256).alias("actual_sha256"),
    )


def balance_anomaly(features: DataFrame, label: str = "suspicious_label") -> DataFrame:
    """One row when the label has a single class (no model can be fitted), else none."""
    return features.agg(F.sum(label).alias("n_positive"), F.count("*").alias("n")).filter(
        (F.col("n_positive") == 0) | (F.col("n_positive") == F.col("n"))
    ).select(
        F.lit("classifier_class_balance").alias("metric"), F.lit(-1).alias("delta"),
        F.lit("degradation").alias("classification"), F.lit("alert").alias("action"), "n_positive",
    )


def merkle_root(df: DataFrame, digest: str) -> DataFrame:
    """Root over the digests in ascending order; an odd last node is paired with itself.

    Positions come from counts per hash slice, so no task ranks the whole batch; each level halves the rows.
    """
    leaves = df.select(F.col(digest).alias("h")).withColumn("b", F.substring("h", 1, 3))
    per = leaves.groupBy("b").agg(F.count("*").alias("c"))
    start = per.withColumn("start", F.sum("c").over(Window.orderBy("b")) - F.col("c"))  # at most 4096 rows
    placed = leaves.join(F.broadcast(start.select("b", "start")), "b")
    level = placed.select("h", (F.col("start") + F.row_number().over(Window.partitionBy("b").orderBy("h")) - 1).alias("pos"))
    n = df.count()
    rows = n
    while rows > 1:
        pair = F.concat(F.min_by("h", "pos"), F.max_by("h", "pos"))
        level = level.groupBy(F.floor(F.col("pos") / 2).alias("p")).agg(F.sha2(pair, 256).alias("h")).select("h", F.col("p").alias("pos"))
        rows = (rows + 1) // 2
    return level.select(F.col("h").alias("merkle_root"), F.lit(n).cast("long").alias("n_leaves"))
