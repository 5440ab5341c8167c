"""Word vectors as text lines: the word, then its components, separated by blanks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", " ")
    return spark.read.text(path).select(
        F.get(parts, F.lit(0)).alias("term"),
        F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda x: x.cast("float")).alias("vector"),
    )


def write_vectors(df: DataFrame, term: str, vector: str, path: str) -> None:
    line = F.concat_ws(" ", F.col(term).cast("string"), F.array_join(F.transform(vector, lambda x: x.cast("string")), " "))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated lexicon: word, mean valence, further columns ignored."""
    parts = F.split("value", "\t")
    return spark.read.text(path).select(
        F.get(parts, F.lit(0)).alias("term"), F.get(parts, F.lit(1)).cast("double").alias("valence")
    )
