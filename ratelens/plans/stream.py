"""Streaming refresh (inventory 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelens.operators import scoring
from ratelens.plans.aggregates import _TRUST, _TRUST_COLS
from ratelens.plans.registry import query, view
from ratelens.plans.views import rounded, scored_numbers, table, trust_sql
from ratelens.session import scratch_path
from ratelens.streaming import day_windows, refresh


view("strust", trust_sql("(SELECT *, 1 AS is_topic_outlier FROM rns)"), "rns")


@query("stream_trust_score", _TRUST.format("strust"), "strust")
def _(spark, sf):
    """Reviews arrive as files; the refreshed scores must equal the batch aggregation of all of them."""
    path = scratch_path(spark, "arrivals")
    scored = scoring.label_as_score(scored_numbers(spark, sf).withColumn("suspicious_label", F.col("suspicious")))
    arriving = scored.select("review_id", "business_id", "stars", "suspicion_score")
    arriving.repartition(4, "review_id").write.parquet(path)
    stream = spark.readStream.schema(arriving.schema).option("maxFilesPerTrigger", 2).parquet(path)
    refresh.run_refresh(stream, f"{path}-state", f"{path}-checkpoint")
    return rounded(refresh.read_refreshed(spark, f"{path}-state"), *_TRUST_COLS)


@query("stream_daily_counts", "SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL")
def _(spark, sf):
    """Day counts per user from several batches, in which events arrive in no order of time."""
    path = scratch_path(spark, "events")
    ev = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    ev.repartition(4, F.xxhash64("user_id", "ts")).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    refresh.run_daily_counts(stream, f"{path}/state", f"{path}/checkpoint")
    return refresh.read_daily_counts(spark, f"{path}/state")


@query("stream_day_windows", """+p AS (SELECT user_id, ts, CASE WHEN hash3 < 2 THEN 3 WHEN ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) THEN 1 ELSE 2 END AS part
    FROM (SELECT user_id, ts, event_id % 10 AS hash3 FROM events)),
  m AS (SELECT part, max(max(ts)) OVER (ORDER BY part ROWS UNBOUNDED PRECEDING EXCLUDE CURRENT ROW) AS seen FROM p GROUP BY part),
  l AS (SELECT user_id, ts::DATE AS day, coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= date_trunc('milliseconds', seen) - INTERVAL 2 DAY, false) AS late FROM p JOIN m USING (part))
  SELECT user_id, day, count(*) AS n, count(*) FILTER (WHERE late) AS n_late FROM l GROUP BY ALL""".replace("+p", "WITH p", 1))
def _(spark, sf):
    """Days close under a watermark of two days; a fifth of the events arrives when most days are closed, and counts as late."""
    path = scratch_path(spark, "day-windows")
    ev = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    half = ev.agg((F.unix_micros(F.min("ts")) + (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 2)).scalar()
    part = F.when(F.col("event_id") % 10 < 2, 3).when(F.unix_micros("ts") < half, 1).otherwise(2)
    for k in (1, 2, 3):
        ev.filter(part == k).select("user_id", "ts").write.mode("append").parquet(f"{path}/in")
        day_windows.run(lambda: spark.readStream.schema("user_id long, ts timestamp").parquet(f"{path}/in"), path, "2 days")
    return day_windows.read(spark, path).select("user_id", "day", "n", "n_late")
