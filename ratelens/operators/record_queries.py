"""Questions asked of a record store: filter, verify, classify, summarise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.config import HYBRID_OUTLIER, OPEN_DELTA, OPEN_SUSPICION
from ratelens.functions.text import preview
from ratelens.operators.records import verify_records


def matching(store: DataFrame, *, business_id: str | None = None, min_delta: float | None = None,
             max_delta: float | None = None, min_suspicion_pct: float | None = None,
             date_after: str | None = None, limitation: str | None = None) -> DataFrame:
    """Records meeting every given bound. Bounds are inclusive, a null metric fails a given bound, and
    the date bound compares ISO text. Conditions are plain column predicates: on a store of Parquet files
    (record_store.read_store) they reach the scan."""
    delta, pct = F.col("scores.manipulation_delta"), F.col("scores.suspicious_review_pct")
    if business_id:
        store = store.filter(F.col("business_id") == business_id)
    if min_delta is not None:
        store = store.filter(delta >= float(min_delta))
    if max_delta is not None:
        store = store.filter(delta <= float(max_delta))
    if min_suspicion_pct is not None:
        store = store.filter(pct >= float(min_suspicion_pct))
    if date_after:
        store = store.filter(F.coalesce("computed_at", F.lit("")) >= date_after)
    if limitation:
        store = store.filter(F.array_contains("limitations", limitation))
    return store


def query_records(store: DataFrame, limit: int = 20, **bounds) -> DataFrame:
    """The first matches by gap, largest first (a missing gap counts 0)."""
    return matching(store, **bounds).orderBy(
        F.coalesce("scores.manipulation_delta", F.lit(0.0)).desc(), "business_id"
    ).limit(limit)


def query_summary(store: DataFrame, limit: int = 20, **bounds) -> DataFrame:
    """Records in the store, matches, and how many a limited answer returns."""
    matched = matching(store, **bounds).agg(F.count("*").alias("n")).scalar()
    return store.agg(F.count("*").alias("total_in_store")).select(
        "total_in_store", matched.alias("match_count"), F.least(F.lit(limit).cast("long"), matched).alias("returned")
    )


def verify_chain(raw: DataFrame, ids: DataFrame | Sequence[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Status per id: verified, MISMATCH, or missing when the store has no such record."""
    checked = verify_records(raw).select("business_id", "verified", "dual_hash")
    if ids is None:
        joined = checked
    else:
        table = ids if isinstance(ids, DataFrame) else spark.createDataFrame([(i,) for i in ids], "business_id string")
        joined = table.join(checked, "business_id", "left")
    short = lambda c: preview(F.coalesce(c, F.lit("")), 16)
    known = F.col("verified").isNotNull()
    return joined.select(
        "business_id",
        F.when(~known, "missing").when(F.col("verified"), "verified").otherwise("MISMATCH").alias("status"),
        F.when(known, short(F.col("dual_hash.sha256"))).alias("sha256"),
        F.when(known, short(F.col("dual_hash.sha512"))).alias("sha512"),
    )


def verify_summary(results: DataFrame) -> DataFrame:
    ok = F.col("status") == "verified"
    return results.agg(
        F.count("*").alias("total_checked"), F.count_if(ok).alias("verified"), F.count_if(~ok).alias("failed")
    )


def classify(store: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """OPEN: large gap and high suspicion; HYBRID: mostly topic outliers; CLOSED otherwise."""
    joined = store.withColumn("_known", F.lit(True))
    if ids is not None:
        joined = ids.join(joined, "business_id", "left")
    e = F.coalesce(F.col("scores.manipulation_delta"), F.lit(0.0))
    a = F.coalesce(F.col("evidence.mean_suspicion_score"), F.lit(0.0))
    t = F.coalesce(F.col("evidence.topic_outlier_pct"), F.lit(0.0))
    label = (
        F.when(F.col("_known").isNull(), "no_receipt")
        .when((F.abs(e) >= OPEN_DELTA) & (a > OPEN_SUSPICION), "OPEN")
        .when(t > HYBRID_OUTLIER, "HYBRID").otherwise("CLOSED")
    )
    return joined.select(
        "business_id", label.alias("topology"),
        F.round(e, 4).alias("e_delta"), F.round(a, 4).alias("a_suspicion"), F.round(t, 4).alias("t_outlier"),
    )
