"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Every row belongs to a source partition (a slice of a keyed hash, so the same after a lost task). For a uniform random
permutation cut into shards, the number of rows that partition p sends to shard s follows a hypergeometric law. The matrix
of these numbers is drawn first, with exact row and column sums; then each partition permutes its rows and deals them out
by its line of the matrix, rows are exchanged, and each shard permutes what it got.

Rows whose keys are null or equal are placed like any others; equal rows may swap places. An empty table gives no rows.
Columns named `shard` or `slot` in the input are replaced.

`write_shards` does this for whole documents: a narrow table of row hashes is dealt out, documents cross one exchange to meet
their shard and slot, and every task writes a file for each shard it has rows of, in order of their slots. So a shard is
written by many tasks, and its files are to be merged by `slot`.
"""

from __future__ import annotations

import random
from math import exp, lgamma

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.common import ranked, slice_of
from ratelens.session import materialise

#: Source partitions at least, and rows of a source partition; the matrix has a line for each.
PARTITIONS, PARTITION_ROWS = 1024, 1_000_000


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Number of good balls among `draws` balls drawn without replacement, by inversion from the mode outwards."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def choose(n: int, k: int) -> float:
        return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)

    peak = exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    left = rng.random() - peak
    up, down, p_up, p_down = mode, mode, peak, peak
    while left > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
        if p_up < 1e-300 and p_down < 1e-300:
            break
    return mode


def communication_matrix(partition_rows: list[int], shard_rows: list[int], seed: int) -> list[list[int]]:
    """Random matrix with the given row and column sums, distributed as by a uniform permutation."""
    rng, left, out = random.Random(seed), list(shard_rows), []
    for n in partition_rows:
        line, draws, rest = [], n, sum(left)
        for s, size in enumerate(left):
            rest -= size
            got = hypergeometric(rng, size, rest, draws)
            line.append(got)
            left[s] -= got
            draws -= got
        out.append(line)
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def uniform_shards(df: DataFrame, keys: list[str], shards: int, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """Add `shard` (0 to shards - 1, sizes at most one apart) and `slot` (0-based place in the shard) to every row.

    `keys` are the columns that tell rows apart. The input is written once to the shared folder; pass narrow rows.
    """
    spark = df.sparkSession
    rows = materialise(df.drop("shard", "slot"), "shard-rows")
    named = {c: f"c{i}" for i, c in enumerate(rows.columns)}
    plain = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in named.items()])
    partitions = partitions or max(PARTITIONS, -(-rows.count() // PARTITION_ROWS))
    # Rows are numbered as they lie in the written files, so that many equal keys are spread like others.
    plain = plain.withColumn("_n", F.monotonically_increasing_id())
    ids = [*(named[k] for k in keys), "_n"]
    dealt = plain.select("*", slice_of(F.xxhash64(F.lit(seed), *ids), partitions).alias("_part"), F.xxhash64(F.lit(seed + 1), *ids).alias("_first"))
    counts = dict(dealt.groupBy("_part").count().collect())  # at most `partitions` rows
    per_part = [counts.get(p, 0) for p in range(partitions)]
    matrix = communication_matrix(per_part, shard_sizes(sum(per_part), shards), seed)
    lines = []
    for p, line in enumerate(matrix):
        ends, total = [], 0
        for n in line:
            total += n
            ends.append(total)
        lines.append((p, ends))
    kind = T.StructType([T.StructField("_line", T.IntegerType()), T.StructField("_ends", T.ArrayType(T.LongType()))])
    plan = F.broadcast(spark.createDataFrame(lines, kind))  # `partitions` lines of `shards` numbers
    rank = F.row_number().over(Window.partitionBy("_part").orderBy("_first", *ids)) - 1
    sent = dealt.withColumn("_rank", rank).join(plan, F.col("_part") == F.col("_line"))
    shard = F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))).cast("int")
    placed = sent.select(*named.values(), "_n", shard.alias("shard"), F.xxhash64(F.lit(seed + 2), *ids).alias("_second"))
    out = ranked(placed, ["shard"], "_second", ids, "slot")
    return out.select(*[F.col(n).alias(c) for c, n in named.items()], "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = 0) -> None:
    """Write whole rows by shard: folders shard=0 to shards - 1 under `path`, in them files in order of `slot`."""
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    whole = [F.col(f"c{i}") for i in range(len(kept))]
    rows = plain.select("*", F.xxhash64(F.lit(seed), *whole).alias("_a"), F.xxhash64(F.lit(~seed), *whole).alias("_b"))
    dealt = uniform_shards(rows.select("_a", "_b"), ["_a", "_b"], shards, seed)
    one = rows.withColumn("_i", F.row_number().over(Window.partitionBy("_a", "_b").orderBy(F.lit(0)))).filter("_i = 1").drop("_i")
    out = one.join(dealt, ["_a", "_b"]).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "shard", "slot")
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The rows of written shards with `shard` and `slot`."""
    return spark.read.parquet(path)
