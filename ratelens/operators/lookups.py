"""Joins used as lookups, and the check for accidental fan-out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_aggregates(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join of two per-key aggregates (both sides hold one row per key)."""
    return left.join(right, key)


def densify(counts: DataFrame, spine: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """All key combinations of the spine; those without a count get 0."""
    return spine.join(counts, list(keys), "left").withColumn(value, F.coalesce(F.col(value), F.lit(0)).cast("long"))


def fanout_audit(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Size a join would have, from per-key counts only. The join itself never runs.

    One union and one grouped count: a key holding a third of all rows costs one row per task.
    """
    both = left.select(F.col(key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.col(key).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per = both.filter(F.col("k").isNotNull()).groupBy("k").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return per.agg(
        F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"),
        F.count_if(F.col("l") > 0).alias("left_keys"), F.count_if(F.col("r") > 0).alias("right_keys"),
        F.count_if(F.col("r") > 1).alias("duplicate_right_keys"),
        F.sum(F.col("l") * F.col("r")).alias("join_rows"),
        (F.max("r") <= 1).alias("right_key_unique"),
    )


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first in the given order. An aggregate, so it combines before the shuffle."""
    rest = [c for c in df.columns if c != key]
    picked = F.min_by(F.struct(*rest), F.struct(*order)).alias("r")
    return df.groupBy(key).agg(picked).select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def lookup_first(left: DataFrame, cache: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join to the first cached row of each key; null columns when the key is unknown."""
    return left.join(first_per_key(cache, key, order).select(key, *columns), key, "left")


def lookup_default(left: DataFrame, table: DataFrame, key: str, value: str, default: float = 0.0) -> DataFrame:
    """Left join of a key -> value table with a default for absent keys."""
    return left.join(table.select(key, value), key, "left").withColumn(
        value, F.coalesce(F.col(value), F.lit(default))
    )


def members(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the key table."""
    return df.join(keys.select(key), key, "left_semi")


def attach_vectors(terms: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """Vector per term; terms without one get zeros. `found` says which."""
    return terms.join(vectors, "term", "left").withColumn("found", F.col("vector").isNotNull()).withColumn(
        "vector", F.coalesce(F.col("vector"), F.array_repeat(F.lit(0.0), dim))
    )


def vector_coverage(attached: DataFrame) -> DataFrame:
    return attached.agg(
        F.count("*").alias("n_terms"), F.count_if("found").alias("n_found"),
        F.count_if(~F.col("found")).alias("n_missing"),
        (F.avg(F.col("found").cast("double")) * 100.0).alias("pct_found"),
    )
