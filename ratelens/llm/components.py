"""Connected components by contraction: distributed, a few rounds for any shape of graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.session import materialise


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Links (a, b) to rows (id, comp): comp is the smallest id that can be reached. Only ids with a link are returned.

    In the first round each b joins one of its a, so that links written from the centres of stars leave little but links
    between centres. In later rounds each id joins its neighbour with the smallest hash, if that is smaller than its own;
    hashes change with the round, so that chains and stars shrink alike. What is left are links between what was joined.
    """
    left = links.select("a", "b").filter("a <> b")
    maps: list[DataFrame] = []
    for step in range(most_rounds):
        def rank(c: str, step: int = step) -> Column:
            return F.struct(F.xxhash64(F.lit(step), c).alias("h"), F.col(c).alias("id"))

        pairs = left.select(F.col("b").alias("id"), rank("a").alias("near"), F.lit(False).alias("centre"))
        back = rank("b") if step else F.lit(None).cast("struct<h:bigint,id:bigint>")
        both = pairs.union(left.select("a", back, F.lit(True)))
        least = both.groupBy("id").agg(F.min("near").alias("near"), F.max("centre").alias("centre"))
        free = F.lit(step == 0) & ~F.col("centre")
        to = F.when(free, F.col("near")["id"]).otherwise(F.least("near", rank("id"))["id"])
        maps.append(materialise(least.select("id", to.alias("to")), "contraction"))
        ends = maps[-1]
        moved = left.join(ends.select(F.col("id").alias("b"), F.col("to").alias("b2")), "b")
        moved = moved.join(ends.select(F.col("id").alias("a"), F.col("to").alias("a2")), "a").filter("a2 <> b2")
        left = materialise(moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "links")
        if left.isEmpty():
            break
    else:
        raise ValueError("components are not done")
    # Follow the contractions from the last to the first. An id that is not in a later one was a root there.
    at = maps[-1]
    for earlier in reversed(maps[:-1]):
        later = at.select(F.col("id").alias("to"), F.col("to").alias("root"))
        at = earlier.join(later, "to", "left").select("id", F.coalesce("root", "to").alias("to"))
    at = at.select("id", "to")
    smallest = at.groupBy("to").agg(F.min("id").alias("comp"))
    return materialise(at.join(smallest, "to").select("id", "comp"), "components")
