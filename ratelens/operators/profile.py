"""Corpus profile: summaries, counts, means per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.text import word_count, words


def corpus_summary(reviews: DataFrame) -> DataFrame:
    """One row describing the review table. The median runs over word counts, a small value domain."""
    n = reviews.withColumn("_w", word_count(F.col("text")))
    return n.agg(
        F.count("*").alias("n_reviews"),
        F.count_distinct("business_id").alias("n_businesses"),
        F.count_distinct("user_id").alias("n_users"),
        F.avg("stars").alias("mean_stars"),
        F.avg("_w").alias("mean_words"),
        F.median("_w").alias("median_words"),
        F.max("_w").cast("long").alias("max_words"),
        F.avg("useful").alias("mean_useful"),
        F.date_format(F.min("date"), "yyyy-MM-dd").alias("date_min"),
        F.date_format(F.max("date"), "yyyy-MM-dd").alias("date_max"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def approx_distinct_counts(df: DataFrame, columns: Sequence[str], rsd: float = 0.02) -> DataFrame:
    """Sketch-based variant: one pass, no shuffle of values."""
    return df.agg(*[F.approx_count_distinct(c, rsd).alias(f"n_{c}") for c in columns])


def token_vocab_size(df: DataFrame, text: str = "text") -> DataFrame:
    """Total and distinct lower-cased white-space tokens."""
    per_doc = df.select(F.explode(words(F.lower(F.col(text)))).alias("t"))
    # Count per token first: the shuffle then carries one row per token and task, not one per occurrence.
    return per_doc.groupBy("t").count().agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("n_tokens"), F.count("*").alias("vocabulary")
    )


def value_counts(df: DataFrame, *keys: str, ordered: bool = True) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.orderBy(*keys) if ordered else counts


def mean_by(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(name), F.count(value).alias("n"))


def date_range_by(df: DataFrame, key: str = "business_id", date: str = "date") -> DataFrame:
    return df.groupBy(key).agg(F.min(date).alias("date_min"), F.max(date).alias("date_max"))


def share_over(df: DataFrame, flag: Column) -> DataFrame:
    """Rows, flagged rows and their percentage."""
    f = flag.cast("double")
    return df.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(flag.cast("long")), F.lit(0)).alias("n_flagged"),
        (F.avg(f) * 100.0).alias("pct"),
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Count and share of each label; the total is a scalar subquery over the small count table."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.select(label, "n", (F.col("n") / total.cast("double")).alias("share"))


def schema_report(df: DataFrame) -> DataFrame:
    """Column names and types as rows, with the row count of the table."""
    fields = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"))
        for i, f in enumerate(df.schema.fields)
    ])
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.inline(fields))


def null_counts(df: DataFrame) -> DataFrame:
    """Null count of every column, one row per column, from a single aggregate."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in df.columns])
    return one.select(F.inline(pairs))


def describe_string(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, most frequent value (ties: smallest) and its frequency for text columns.

    The columns are unpivoted and counted per (column, value) before anything else is compared.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in columns
    ])).alias("s")).select("s.*").filter(F.col("v").isNotNull())
    counts = long.groupBy("column_name", "v").agg(F.count("*").alias("n"))
    top = F.min_by(F.struct("v", "n"), F.struct((-F.col("n")).alias("k"), "v"))
    return counts.groupBy("column_name").agg(
        F.sum("n").alias("n_values"), F.count("*").alias("n_unique"), top.alias("t")
    ).select("column_name", "n_values", "n_unique", F.col("t.v").alias("top_value"), F.col("t.n").alias("freq"))


def length_stats(df: DataFrame, text: str = "text") -> DataFrame:
    w = df.select(word_count(F.col(text)).alias("w"))
    return w.agg(
        F.avg("w").alias("mean_words"), F.median("w").alias("median_words"),
        F.min("w").cast("long").alias("min_words"), F.max("w").cast("long").alias("max_words"),
        F.stddev_samp("w").alias("std_words"),
    )


def monthly_volume(df: DataFrame, date: str = "date") -> DataFrame:
    """Reviews per calendar month; months without reviews between the first and the last count 0."""
    counts = df.filter(F.col(date).isNotNull()).groupBy(F.trunc(F.to_date(date), "month").alias("month")).agg(
        F.count("*").alias("n")
    )
    spine = counts.agg(F.min("month").alias("a"), F.max("month").alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month")
    )
    return spine.join(counts, "month", "left").select(
        F.last_day("month").alias("month_end"), F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def category_monthly(df: DataFrame, category: str, date: str = "date") -> DataFrame:
    return df.groupBy(F.trunc(F.to_date(date), "month").alias("month"), category).agg(F.count("*").alias("n"))


def busy_days(events: DataFrame, entity: str = "user_id", ts: str = "ts", pct: float = 0.95) -> DataFrame:
    """Days on which an entity's event count is above its own percentile over all days of its span.

    Quiet days count 0. They are never generated: with the number of days and the sorted busy-day counts
    known per entity, the percentile of the zero-filled series follows from the positions. An entity has
    at most one count per calendar day, so the sorted array is bounded by the length of the calendar.
    """
    daily = events.groupBy(entity, F.to_date(ts).alias("day")).agg(F.count("*").alias("n"))
    per = daily.groupBy(entity).agg(
        F.min("day").alias("a"), F.max("day").alias("b"), F.array_sort(F.collect_list("n")).alias("ns"),
        F.collect_list(F.struct("day", "n")).alias("days"),
    )
    span = F.datediff("b", "a") + 1
    pos = (F.col("span") - 1) * F.lit(pct)
    zeros = F.col("span") - F.size("ns")

    def at(i: Column) -> Column:
        return F.when(i < zeros, F.lit(0)).otherwise(F.get("ns", (i - zeros).cast("int"))).cast("double")

    lo, hi = F.floor(pos), F.ceil(pos)
    limit = at(lo) + (at(hi) - at(lo)) * (pos - lo)
    return (
        per.withColumn("span", span).withColumn("limit_n", limit)
        .select(entity, "limit_n", F.inline("days"))
        .filter(F.col("n") > F.col("limit_n"))
        .select(entity, "day", "n", "limit_n")
    )
