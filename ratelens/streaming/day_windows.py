"""Event-time day counts: a state store that holds the open days only, and a defined way for rows that come too late.

Two queries read the same arrivals. One is a windowed aggregation under a watermark: a day is written, once, when the
watermark has passed its end, and leaves the state; rows of a day that is closed are not in it. The other adds up whatever
arrives, per batch. Their difference is what came late, and their sum is the batch result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratelens.streaming.refresh import read_daily_counts, run_daily_counts

_CLOSED = "day date, n long"


def close_days(stream: DataFrame, path: str, checkpoint: str, delay: str, entity: str = "user_id", ts: str = "ts") -> StreamingQuery:
    """Write the counts of days that end before the watermark (greatest time seen less `delay`); what has arrived, then stop.

    Each batch has a folder, so a replayed one overwrites itself. Rows without a time have no day and are in no count.
    """
    days = stream.filter(F.col(ts).isNotNull()).withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("w"), F.col(entity)).agg(F.count("*").alias("n"))

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.select(entity, F.to_date("w.start").alias("day"), "n").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    q = days.writeStream.outputMode("append").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run(arrivals: Callable[[], DataFrame], path: str, delay: str, entity: str = "user_id", ts: str = "ts") -> StreamingQuery:
    """Both queries over what has arrived since the last call. `arrivals` makes the stream; returns the one with the state.

    Days are closed first: what arrives in between is then counted as arrived, and never the other way round.
    """
    closing = close_days(arrivals(), f"{path}/closed", f"{path}/checkpoint-closed", delay, entity, ts)
    run_daily_counts(arrivals().filter(F.col(ts).isNotNull()), f"{path}/arrived", f"{path}/checkpoint-arrived", entity, ts)
    return closing


def read(spark: SparkSession, path: str, entity: str = "user_id") -> DataFrame:
    """Rows (entity, day, n, n_late, closed): all rows of the day, those of them that came after it was closed, and whether it is.

    Days up to the last one that was written for anyone are closed. An open day has no late rows.
    """
    arrived = read_daily_counts(spark, f"{path}/arrived", entity).withColumnRenamed("n", "_all")
    closed = spark.read.schema(f"{entity} {arrived.schema[entity].dataType.simpleString()}, {_CLOSED}").parquet(f"{path}/closed")
    until = closed.agg(F.max("day")).scalar()
    in_time = closed.groupBy(F.col(entity).alias("_entity"), F.col("day").alias("_day")).agg(F.sum("n").alias("_in_time"))
    both = arrived.join(in_time, F.col(entity).eqNullSafe(F.col("_entity")) & (F.col("day") == F.col("_day")), "left")
    done = F.coalesce(F.col("day") <= until, F.lit(False))
    late = F.when(done, F.col("_all") - F.coalesce("_in_time", F.lit(0))).otherwise(0)
    return both.select(entity, "day", F.col("_all").alias("n"), late.alias("n_late"), done.alias("closed"))
