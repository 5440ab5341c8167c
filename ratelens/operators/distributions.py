"""Histograms, exact quantiles and box-plot statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: Column, bins: int, upper: float | None = None,
              bounds: tuple[float, float] | None = None, group: str | None = None) -> DataFrame:
    """Equal-width bins between minimum and maximum (last bin closed), optionally clipped above.

    The bounds are one scalar subquery unless given, so the input is read twice: write costly values
    (such as text lengths) to a table first. Empty bins are kept with count 0.
    """
    x = F.least(value.cast("double"), F.lit(float(upper))) if upper is not None else value.cast("double")
    keep = [group] if group else []
    data = df.select(*keep, x.alias("x")).filter(F.col("x").isNotNull())
    if bounds:
        ends = F.struct(F.lit(float(bounds[0])).alias("lo"), F.lit(float(bounds[1])).alias("hi"))
    else:
        ends = data.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("m")).scalar()
    data = data.withColumn("_m", ends).select(*keep, "x", "_m.lo", "_m.hi")
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    slot = F.when(F.col("hi") <= F.col("lo"), 0).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    ).cast("int")
    counts = data.groupBy(*keep, slot.alias("bin"), "lo", "hi").agg(F.count("*").alias("n"))
    ends = counts.groupBy(*keep).agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    spine = ends.select(*keep, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = spine.join(counts.drop("lo", "hi"), [*keep, "bin"], "left")
    return full.select(
        *keep, "bin",
        (F.col("lo") + width * F.col("bin")).alias("bin_lo"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float],
                    bounded_groups: bool = False) -> DataFrame:
    """Linear-interpolated quantiles, exact for any number of distinct values and any group size.

    A sketch proposes cut points close to each wanted rank; rows are counted between the cuts, which
    tells exactly in which narrow slice the rank lies; only values inside those slices are sorted, after
    equal values have been counted together. The result does not depend on the sketch's accuracy.
    The input is read several times: write costly values to a table first.
    `bounded_groups` says that the number of groups is fixed by the caller (such as a list of columns), so
    the tables with a few rows per group are broadcast; otherwise joins go by key.
    """
    small = F.broadcast if bounded_groups or not groups else (lambda t: t)
    keys = list(groups) or ["_all"]
    data = (df if groups else df.withColumn("_all", F.lit(1))).select(*keys, F.col(value).cast("double").alias("v"))
    data = data.filter(F.col("v").isNotNull())
    near = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-2e-3, -2e-4, 2e-4, 2e-3)})
    cuts = data.groupBy(*keys).agg(
        F.percentile_approx("v", F.array(*[F.lit(p) for p in near]), F.lit(10000)).alias("cuts"),
        F.count("*").alias("n"),
    )
    below = [(F.get("cuts", F.lit(i)) <= F.col("v")).cast("int") for i in range(len(near))]
    sliced = data.join(small(cuts.select(*keys, "cuts")), keys).withColumn("slice", sum(below[1:], below[0])).drop("cuts")
    per_slice = sliced.groupBy(*keys, "slice").agg(F.count("*").alias("c"))
    order = Window.partitionBy(*keys).orderBy("slice")
    starts = per_slice.withColumn("start", F.sum("c").over(order) - F.col("c"))
    wanted = cuts.select(*keys, "n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
    wanted = wanted.withColumn("pos", F.col("p") * (F.col("n") - 1))
    ranks = wanted.select(
        *keys, "p", "pos", F.explode(F.array_distinct(F.array(F.floor("pos"), F.ceil("pos")))).alias("rank")
    )
    located = ranks.join(starts, keys).filter(
        (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("c"))
    ).select(*keys, "slice", "start", "p", "pos", "rank")
    inside = sliced.join(small(located.select(*keys, "slice", "start").distinct()), [*keys, "slice"])
    valued = inside.groupBy(*keys, "slice", "start", "v").agg(F.count("*").alias("c"))
    run = Window.partitionBy(*keys, "slice").orderBy("v")
    valued = valued.withColumn("upto", F.col("start") + F.sum("c").over(run))
    found = located.alias("l").join(valued.drop("start"), [*keys, "slice"]).filter(
        (F.col("rank") >= F.col("upto") - F.col("c")) & (F.col("rank") < F.col("upto"))
    )
    out = found.groupBy(*keys, "p", "pos").agg(F.min_by("v", "rank").alias("a"), F.max_by("v", "rank").alias("b"))
    out = out.select(
        *keys, "p", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("pos") - F.floor("pos"))).alias("q")
    )
    return out if groups else out.drop("_all")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles and max, one row per column."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns
    ])).alias("s")).select("s.*")
    base = long.groupBy("column_name").agg(
        F.count("v").alias("n_values"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    q = exact_quantiles(long, ["column_name"], "v", [0.25, 0.5, 0.75], bounded_groups=True)
    wide = q.groupBy("column_name").agg(*[
        F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    ])
    return base.join(wide, "column_name", "left").select(
        "column_name", "n_values", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def boxplot(df: DataFrame, group: str, value: str, bounded_groups: bool = False) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and the number of points beyond."""
    q = exact_quantiles(df, [group], value, [0.25, 0.5, 0.75], bounded_groups).groupBy(group).agg(*[
        F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "med"), (0.75, "q3"))
    ])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    q = q.withColumns({"low": F.col("q1") - reach, "high": F.col("q3") + reach})
    v = F.col(value).cast("double")
    inside = (v >= F.col("low")) & (v <= F.col("high"))
    q = F.broadcast(q) if bounded_groups else q
    return df.select(group, value).join(q, group).groupBy(group, "q1", "med", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
    )
