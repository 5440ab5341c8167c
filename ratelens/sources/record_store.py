"""Record stores: folders of JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.canonical import raw_schema
from ratelens.operators.records import RECORD_SCHEMA, documents, typed


def write_records(signed: DataFrame, path: str, one_per_key: bool = False) -> None:
    """Write signed records as JSON lines, or as one folder per business."""
    docs = documents(signed)
    if one_per_key:
        docs.write.mode("overwrite").partitionBy("business_id").text(path)
    else:
        docs.select("value").write.mode("overwrite").text(path)


def read_records(spark: SparkSession, path: str, schema: T.StructType = RECORD_SCHEMA, multiline: bool = False,
                 key: str = "business_id") -> DataFrame:
    """All readable records, one per key: the latest `computed_at`, then the last file, then the greatest text.

    Unreadable documents have no key and are skipped. Numbers stay as text so digests can be recomputed;
    use records.typed() to filter on them. `document` is the stored text, which verification reads in full.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("wholetext", multiline).text(path)
    raw = lines.select(F.from_json("value", raw_schema(schema)).alias("r"), F.col("value").alias("document"), F.col("_metadata.file_path").alias("_file"))
    raw = raw.filter(F.col(f"r.{key}").isNotNull())
    order = F.struct(F.coalesce("r.computed_at", F.lit("")), "_file", "document") if "computed_at" in schema.names else F.struct("_file", "document")
    last = raw.groupBy(F.col(f"r.{key}").alias("_key")).agg(F.max_by(F.struct("r", "document"), order).alias("x"))
    return last.select(*[F.col(f"x.r.{f.name}").alias(f.name) for f in schema.fields], F.col("x.document").alias("document"))


def write_store(records: DataFrame, path: str) -> None:
    """Write records (as read_records gives them: the latest of each key) as a typed Parquet store.

    Sorted by the gap, so that row groups have narrow ranges and bounds on the metrics skip them in the scan.
    """
    typed(records).repartitionByRange(F.col("scores.manipulation_delta")).sortWithinPartitions("scores.manipulation_delta").write.mode("overwrite").parquet(path)


def read_store(spark: SparkSession, path: str, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def append_events(events: DataFrame, path: str) -> None:
    """Append event envelopes as JSON lines; null fields are written."""
    events.write.mode("append").option("ignoreNullFields", False).json(path)
