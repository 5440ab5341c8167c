"""Schema checks, typed projection and removal of rows with broken ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.config import INVALID_IDS, REVIEW_COLUMNS, TENANT_ID


def missing_columns(df: DataFrame, required: Sequence[str] = REVIEW_COLUMNS) -> list[str]:
    """Required column names that the frame lacks (a driver-side schema difference)."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Sequence[str] = REVIEW_COLUMNS) -> DataFrame:
    gap = missing_columns(df, required)
    if gap:
        raise ValueError(f"review table lacks columns {gap}; it has {df.columns}")
    return df


def typed_reviews(df: DataFrame, date_format: str = "M/d/yyyy H:mm") -> DataFrame:
    """Text columns to their types: counts as int (bad input fails), date parsed or null."""
    ints = {c: F.col(c).cast("int") for c in ("stars", "useful", "funny", "cool")}
    when = F.try_to_timestamp(F.col("date").cast("string"), F.lit(date_format)).cast("timestamp_ntz")
    return require_columns(df).withColumns({**ints, "date": when})


def _invalid(column: str, tokens: Sequence[str]):
    return F.coalesce(F.col(column).isin(*tokens), F.lit(False))


def drop_invalid_ids(df: DataFrame, tokens: Sequence[str] = INVALID_IDS) -> DataFrame:
    """Keep rows whose review id and business id are both usable; null ids are kept."""
    return df.filter(~_invalid("review_id", tokens) & ~_invalid("business_id", tokens))


def corruption_report(df: DataFrame, tokens: Sequence[str] = INVALID_IDS) -> DataFrame:
    """Rows with a broken id per column, in either column, and the rows left."""
    bad_r, bad_b = _invalid("review_id", tokens), _invalid("business_id", tokens)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(bad_b).alias("bad_business_id"),
        F.count_if(bad_r).alias("bad_review_id"),
        F.count_if(bad_b | bad_r).alias("bad_either"),
        F.count_if(~(bad_b | bad_r)).alias("n_clean"),
    )


def row_count_expectation(df: DataFrame, expected: int, label: str) -> DataFrame:
    """Expected against actual row count as one row."""
    return df.agg(F.count("*").alias("actual")).select(
        F.lit(label).alias("expectation"),
        F.lit(expected).cast("long").alias("expected"),
        "actual",
        (F.col("actual") == F.lit(expected)).alias("ok"),
    )


def require_row_count(df: DataFrame, expected: int, label: str = "rows") -> DataFrame:
    """Strict load: fail the job unless the table has the expected number of rows.

    The check is one aggregate read as a scalar subquery, so it runs with the query that uses the rows.
    """
    actual = df.agg(F.count("*").alias("n")).scalar()
    problem = F.concat(F.lit(f"{label}: expected {expected} rows, found "), actual.cast("string"))
    return df.filter(F.when(actual == expected, True).otherwise(F.raise_error(problem).cast("boolean")))


def ingest_event(df: DataFrame, source: str, tenant: str = TENANT_ID) -> DataFrame:
    """One event row describing a load."""
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit("ingest").alias("receipt_type"),
        F.lit(tenant).alias("tenant_id"),
        F.lit("csv").alias("source_type"),
        F.lit(source).alias("source_path"),
        "row_count",
    )
