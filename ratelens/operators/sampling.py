"""Repeatable samples and splits: rows are ordered by a hash of their key and a seed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.config import SEED

PREFIX = 4  # hex digits, 65 536 slices of the hash range


def hash_order(key: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """The first n rows in hash order (all rows when there are fewer), by a threshold on the hash: no row is shuffled but
    those of the one slice of the hash range that holds the boundary."""
    one = df.withColumn("_all", F.lit(0))
    return _first_of_class(one, "_all", key, lambda total: F.least(total, F.lit(n).cast("long")), seed).filter("_first").drop("_all", "_first")


def fraction_sample(df: DataFrame, key: str, fraction: float, seed: int = SEED) -> DataFrame:
    """About a fraction of the rows, without any sort or shuffle."""
    slot = F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("long")
    return df.filter(slot < int(fraction * 16 ** 8))


def entity_sample(df: DataFrame, entity: str, n: int, seed: int = SEED) -> DataFrame:
    """All rows of n entities."""
    picked = hash_sample(df.select(entity).distinct().filter(F.col(entity).isNotNull()), entity, n, seed)
    return df.join(picked, entity, "left_semi")


def balanced_sample(df: DataFrame, label: str, classes: Sequence[int], n: int, key: str, seed: int = SEED) -> DataFrame:
    """n / len(classes) rows of each class, or no rows at all when a class is too small."""
    each = n // len(classes)
    wanted = df.filter(F.col(label).isin(*classes))
    picked = _first_of_class(wanted, label, key, lambda total: F.least(total, F.lit(each).cast("long")), seed).filter("_first").drop("_first")
    enough = wanted.groupBy(label).agg(F.count("*").alias("c")).filter(F.col("c") >= each).agg(F.count("*").alias("n")).scalar()
    return picked.filter(enough == len(set(classes)))


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Add `split` ('test' / 'train'): per class, the first ceil(share * n) rows in hash order are the test set.

    Exact without ranking whole classes: rows are counted per slice of the hash range, the counts say in
    which slice the boundary of a class falls, and only that slice is ranked to find the boundary hash.
    """
    first = _first_of_class(df, label, key, lambda total: F.ceil(total * F.lit(test_share)), seed)
    return first.withColumn("split", F.when(F.col("_first"), "test").otherwise("train")).drop("_first")


def _first_of_class(df: DataFrame, label: str, key: str, wanted: Callable[[Column], Column], seed: int) -> DataFrame:
    """Add `_first`: whether a row is among the first wanted(class size) of its class in hash order."""
    h = df.withColumn("_h", hash_order(key, seed)).withColumn("_b", F.substring("_h", 1, PREFIX))
    per_slice = h.groupBy(label, "_b").agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy(label).orderBy("_b"))
    total = F.sum("c").over(Window.partitionBy(label))
    edge = per_slice.withColumns({"upto": upto, "k": wanted(total)}).filter(
        (F.col("k") > F.col("upto") - F.col("c")) & (F.col("k") <= F.col("upto"))
    ).select(F.col(label).alias("l"), F.struct(F.col("_b").alias("slice"), (F.col("k") - F.col("upto") + F.col("c")).alias("rank")).alias("v"))
    in_edge = h.select(label, key, "_h", "_b").withColumn("_e", F.try_element_at(_per_class(edge), F.col(label))).filter(F.col("_b") == F.col("_e.slice"))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", key))
    cut = in_edge.withColumn("_n", rank).filter(F.col("_n") == F.col("_e.rank")).select(
        F.col(label).alias("l"), F.struct(F.col("_h").alias("h"), F.col(key).alias("k")).alias("v")
    )
    staged = h.withColumn("_c", F.try_element_at(_per_class(cut), F.col(label)))
    before = F.struct(F.col("_h").alias("h"), F.col(key).alias("k")) <= F.col("_c")
    return staged.withColumn("_first", F.coalesce(before, F.lit(False))).drop("_h", "_b", "_c")


def _per_class(table: DataFrame) -> Column:
    """A (l, v) table with one row per class as a map in a scalar subquery.

    Joining on the class instead would shuffle all rows to as many tasks as there are classes.
    """
    return table.agg(F.map_from_entries(F.collect_list(F.struct("l", "v"))).alias("m")).scalar()


def split_report(split: DataFrame, label: str) -> DataFrame:
    """Rows per split and class, with the class share inside the split."""
    counts = split.groupBy("split", label).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("split")).cast("double"))


def misclassified(df: DataFrame, truth: str, pred: str, key: str, n: int = 3) -> DataFrame:
    """First n wrong predictions in hash order; rows without a prediction are not errors."""
    return hash_sample(df.filter(F.col(pred).isNotNull() & (F.col(pred) != F.col(truth))), key, n)
