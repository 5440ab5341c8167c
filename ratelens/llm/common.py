"""Helpers shared by the corpus operators: tables, slices of a hash range, ranks without a hot window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Slices of the hash range that ranks are counted in. Fixed, so that a plan is the same at every size.
SLICES = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slice_of(key: Column, slices: int = SLICES) -> Column:
    """Slice of a hash key: an even cut of the unsigned high bits, so that slice order is key order."""
    return F.floor((F.shiftright(key, 32) + F.lit(2**31)) * F.lit(slices) / F.lit(2**32)).cast("int")


def ranked(df: DataFrame, groups: list[str], key: str, ties: list[str], name: str = "rank", slices: int = SLICES, size: str | None = None) -> DataFrame:
    """Add the 0-based rank of every row within its group, ordered by a 64-bit hash column and then `ties`.

    With `size`, a row stands for as many rows as this column says, and the rank is that of its first one.

    Rows are counted per (group, slice of the hash range); a rank is the rows in earlier slices plus the rank inside the
    slice. A group that holds a third of all rows is sorted by many tasks. Group columns must not be null.
    """
    cut = df.withColumn("_slice", slice_of(F.col(key), slices))
    keys = [*groups, "_slice"]
    counts = cut.groupBy(*keys).agg((F.sum(size) if size else F.count(F.lit(1))).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    order = Window.partitionBy(*keys).orderBy(key, *ties)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(size).over(earlier), F.lit(0)) if size else F.row_number().over(order) - 1
    return cut.withColumn("_inside", inside).join(starts, keys).withColumn(name, F.col("_start") + F.col("_inside")).drop("_slice", "_start", "_inside")
