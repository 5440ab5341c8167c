"""Classifier evaluation as aggregates over (truth, prediction)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.numbers import safe_ratio

METRICS = ("accuracy", "precision", "recall", "f1")


def confusion_matrix(df: DataFrame, truth: str, pred: str, classes: Sequence[int]) -> DataFrame:
    """Every (truth, prediction) cell, zeros included; a missing prediction counts as class -1."""
    cells = df.groupBy(F.col(truth).alias("y_true"), F.coalesce(F.col(pred), F.lit(-1)).alias("y_pred")).agg(
        F.count("*").alias("n")
    )
    grid = [F.struct(F.lit(a).alias("y_true"), F.lit(b).alias("y_pred")) for a in classes for b in classes]
    spine = cells.agg(F.sum("n").alias("total")).select(F.inline(F.array(*grid)))
    return spine.join(cells, ["y_true", "y_pred"], "left").select(
        "y_true", "y_pred", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def _binary(df: DataFrame, y: Column, p: Column, keys: Sequence[str] = ()) -> DataFrame:
    counts = df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if(y == p).alias("hit"),
    )
    return counts.select(
        *keys, "n",
        safe_ratio(F.col("hit"), F.col("n")).alias("accuracy"),
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        safe_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def binary_metrics(df: DataFrame, truth: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; empty denominators give 0."""
    return _binary(df, F.col(truth), F.col(pred), keys)


def valid_only_metrics(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """The same over rows that have a prediction, with the number of rows before the filter."""
    flagged = df.withColumn("_ok", F.col(pred).isNotNull())
    total = df.agg(F.count("*").alias("t")).scalar()
    return binary_metrics(flagged.filter("_ok"), truth, pred).withColumn("n_total", total)


def classification_report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means."""
    pairs = df.groupBy(F.col(truth).alias("y"), F.col(pred).alias("p")).agg(F.count("*").alias("n"))
    sides = pairs.select(F.inline(F.array(
        F.struct(F.col("y").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")),
    )))
    per = sides.filter(F.col("c").isNotNull()).groupBy("c").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    ).select(
        F.col("c").cast("string").alias("class"),
        safe_ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("support")).alias("recall"),
        safe_ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "support", "tp",
    )
    n = F.sum("support").cast("double")
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    weighted = per.agg(
        F.lit("weighted avg").alias("class"),
        *[(F.sum(F.col(m) * F.col("support")) / n).alias(m) for m in ("precision", "recall", "f1")],
        F.sum("support").alias("support"),
    )
    hit = F.sum("tp").cast("double") / n
    accuracy = per.agg(F.lit("accuracy").alias("class"), hit.alias("precision"), hit.alias("recall"),
                       hit.alias("f1"), F.sum("support").alias("support"))
    return per.drop("tp").unionByName(accuracy).unionByName(macro).unionByName(weighted)


def unpivot_metrics(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.unpivot(list(keys), list(METRICS), "metric", "value")


def metric_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Change of each metric between two one-row runs."""
    b = unpivot_metrics(before).withColumnRenamed("value", "before")
    a = unpivot_metrics(after).withColumnRenamed("value", "after")
    return b.join(a, "metric").select("metric", "before", "after", (F.col("after") - F.col("before")).alias("delta"))


def scoreboard(runs: DataFrame) -> DataFrame:
    """Runs with the distance of their accuracy to the best one."""
    best = runs.agg(F.max("accuracy").alias("m")).scalar()
    return runs.select(
        "run", "accuracy", "f1", (best - F.col("accuracy")).alias("gap_to_best"), (F.col("accuracy") == best).alias("is_best")
    )


def agreement_rate(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.avg(F.col(flag).cast("double")).alias("agreement_rate"))


def log_loss(df: DataFrame, truth: Column, prob: Column, eps: float = 1e-15) -> DataFrame:
    p = F.greatest(F.lit(eps), F.least(F.lit(1.0 - eps), prob))
    y = truth.cast("double")
    return df.agg(F.count("*").alias("n"), F.avg(-(y * F.ln(p) + (1.0 - y) * F.ln(1.0 - p))).alias("log_loss"))


def mse_r2(df: DataFrame, truth: Column, pred: Column) -> DataFrame:
    """Mean squared error and R squared from one pass of mergeable moments."""
    y, e = truth.cast("double"), truth.cast("double") - pred.cast("double")
    return df.agg(
        F.count("*").alias("n"), F.avg(e * e).alias("mse"), F.var_pop(y).alias("_v")
    ).select("n", "mse", (1.0 - F.col("mse") / F.nullif(F.col("_v"), F.lit(0.0))).alias("r2"))
