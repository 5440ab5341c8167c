"""Mixing sources to target weights by Pfair scheduling.

A source's documents are put in a keyed random order and cut into blocks. The size of a block grows with the square root of
all rows, so that the number of blocks does too (24 million blocks of 4096 for 10^11 documents). Block k of a source of weight w (of a total of 1) is
released at floor(k / w) and due at ceil((k + 1) / w); in every slot, the released block that is due first is taken. So after
any number of slots each source is less than one block away from its target. Windows follow from the weights themselves and
not from slots of a frame, so no rounding adds up.

Ranks and turns are worked out on a narrow table of row hashes; whole rows cross one exchange, to meet them. Rows that repeat a
key are told apart by all their columns, and equal rows are placed each.

All rows are kept. When a source runs out, the others go on in their windows and slots in which none is released are empty. A
null source is a source of its own. An empty table gives no rows. Input columns named `block`, `turn` or `place` are replaced;
others keep their names and values.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.llm.common import ranked
from ratelens.session import materialise, scratch_path

#: Least number of documents in a block.
BLOCK = 8
#: Blocks grow with the square root of the rows: a block holds about one document for so many rows of that root.
ROOT_SHARE = 64
#: Blocks that the driver schedules before it writes them.
FRAME = 1_000_000
#: A window's end this near to a whole slot, as a share, is that slot: weights are doubles.
_NEAR = 1e-13


def source_key(source: Column) -> Column:
    """Name of a source that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def frame_slots(weights: DataFrame, frame: int = 1000) -> DataFrame:
    """Rows (key, weight) to one row of arrays: keys in order and their whole slots of a frame, the largest remainders rounded up.

    A summary of a mixture for readers; turns are not made from it.
    """
    listed = weights.agg(F.array_sort(F.collect_list(F.struct("key", "weight"))).alias("all"), F.sum("weight").alias("total")).filter("total > 0")
    share = F.transform("all", lambda s: F.struct(s["key"].alias("key"), F.round(s["weight"] / F.col("total") * frame, 9).alias("share")))
    ready = listed.select(share.alias("all"))
    spare = F.lit(frame) - F.aggregate("all", F.lit(0).cast("bigint"), lambda a, s: a + F.floor(s["share"]))
    by_rest = F.array_sort(F.transform("all", lambda s: F.struct((F.floor(s["share"]) - s["share"]).alias("rest"), s["key"].alias("key"))))
    ready = ready.select("all", F.transform(F.slice(by_rest, F.lit(1), spare.cast("int")), lambda s: s["key"]).alias("up"))
    extra = lambda s: F.when(F.array_contains(F.col("up"), s["key"]), 1).otherwise(0)
    return ready.select(
        F.transform("all", lambda s: s["key"]).alias("keys"),
        F.transform("all", lambda s: (F.floor(s["share"]) + extra(s)).cast("int")).alias("slots"),
    )


def schedule(weights: list[float], blocks: list[int]) -> Iterator[tuple[int, int, int]]:
    """(source, block, turn) of all blocks in order of turns: earliest deadline first among the released blocks."""
    total = math.fsum(weights)
    every = [total / w for w in weights]  # slots between two blocks

    def release(i: int, k: int) -> int:
        x = k * every[i]
        return math.floor(x + x * _NEAR)

    def due(i: int, k: int) -> int:
        x = (k + 1) * every[i]
        return math.ceil(x - x * _NEAR)

    waiting = [(0, i, 0) for i, n in enumerate(blocks) if n]  # in order of release
    ready: list[tuple[int, int, int]] = []  # in order of deadline
    turn = 0
    while waiting or ready:
        if not ready and waiting[0][0] > turn:
            turn = waiting[0][0]
        while waiting and waiting[0][0] <= turn:
            _, i, k = heappop(waiting)
            heappush(ready, (due(i, k), i, k))
        _, i, k = heappop(ready)
        yield i, k, turn
        if k + 1 < blocks[i]:
            heappush(waiting, (release(i, k + 1), i, k + 1))
        turn += 1


def block_size(rows: int) -> int:
    """Documents per block: the largest power of two that is at most the root of the rows over ROOT_SHARE, but not below BLOCK."""
    return max(BLOCK, 1 << max(0, (math.isqrt(max(rows, 0)) // ROOT_SHARE).bit_length() - 1))


def balanced_weights(docs: DataFrame, source: str = "source", power: float = 0.5) -> DataFrame:
    """Weights (key, weight) that flatten the sizes of the sources: rows to the given power."""
    return docs.groupBy(source_key(F.col(source)).alias("key")).agg(F.pow(F.count(F.lit(1)), F.lit(power)).alias("weight"))


def block_turns(sources: DataFrame, block: int = BLOCK, frame: int = FRAME) -> DataFrame:
    """Rows (key, weight, n): one per source, to rows (key, block, turn): one per block.

    The driver holds one row per source and `frame` blocks at a time; a frame goes on where the one before it ended.
    """
    spark = sources.sparkSession
    held = sorted((r["key"], r["weight"], r["n"]) for r in sources.select("key", "weight", "n").collect())
    known = [w for _, w, _ in held if w and w > 0]
    weights = [w if w and w > 0 else min(known, default=1.0) for _, w, _ in held]
    path, kind = scratch_path(spark, "turns"), "source int, block long, turn long"

    def write(*cols: array) -> None:
        part = pa.table({c: pa.array(memoryview(v)) for c, v in zip(("source", "block", "turn"), cols)})
        spark.createDataFrame(part, kind).write.mode("append").parquet(path)

    cols = array("i"), array("q"), array("q")
    put = [c.append for c in cols]
    for i, k, turn in schedule(weights, [-(-n // block) for _, _, n in held]):
        put[0](i)
        put[1](k)
        put[2](turn)
        if len(cols[0]) >= frame:
            write(*cols)
            for c in cols:
                del c[:]
    write(*cols)
    names = spark.createDataFrame([(i, k) for i, (k, _, _) in enumerate(held)], "source int, key string")
    return spark.read.schema(kind).parquet(path).join(F.broadcast(names), "source").select("key", "block", "turn")


def mix(docs: DataFrame, weights: DataFrame, source: str = "source", key: str = "doc_id", seed: int = 0, block: int | None = None, frame: int = FRAME) -> DataFrame:
    """Add `block` (number in its source), `turn` (slot from the start, one source each) and `place` (within the block).

    weights: rows (key, weight), key as of source_key; sources that have no weight get the least of the others. Ordering by
    turn and place gives the mixture. block: documents per block, by default as block_size says for all rows.
    """
    kept = [c for c in docs.columns if c not in ("block", "turn", "place")]
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    own, whole = F.col(f"c{kept.index(key)}"), [F.col(f"c{i}") for i in range(len(kept))]
    order = F.when(own.isNull(), F.xxhash64(F.lit(seed), *whole)).otherwise(F.xxhash64(F.lit(seed), own))
    rows = plain.select("*", source_key(F.col(f"c{kept.index(source)}")).alias("_source"), order.alias("_order"), F.xxhash64(F.lit(~seed), *whole).alias("_row"))
    # One narrow row for all rows that are equal: _source, _order and _row are 128 bits of hash within a source.
    identity = ["_source", "_order", "_row"]
    narrow = materialise(rows.groupBy(*identity).agg(F.count(F.lit(1)).alias("_copies")), "mixture-rows")
    present = narrow.groupBy(F.col("_source").alias("key")).agg(F.sum("_copies").alias("n"))
    if block is None:
        block = block_size(narrow.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0])
    known = present.join(weights.select("key", F.col("weight").cast("double").alias("weight")), "key", "left")
    turns = block_turns(known, block, frame).withColumnRenamed("key", "_source")
    starts = ranked(narrow, ["_source"], "_order", ["_row"], "_first", size="_copies")
    ranks = starts.select(*identity, F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_copies") - 1)).alias("_rank"))
    placed = ranks.withColumn("block", F.floor(F.col("_rank") / F.lit(block))).join(turns, ["_source", "block"])
    placed = placed.select(*identity, "block", "turn", (F.col("_rank") % block).cast("int").alias("place"))
    one = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*identity).orderBy(F.lit(0)))).filter("_n = 1").drop("_n")
    out = one.join(placed, identity)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "block", "turn", "place")
