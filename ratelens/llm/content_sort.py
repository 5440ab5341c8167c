"""Exact duplicates by sorting on content.

Rows are range-partitioned on their normalised bytes by sampled splitters, sorted externally, and equal texts come to lie next
to each other; neighbours are compared in full, and each run of equal texts keeps one row. A splitter is the first bytes of a
text and then its hash, so a sample stays small however long the texts are, and a beginning that many texts share is divided.

A text with very many rows, or very many bytes in its copies, is dealt over several salts of the row's id. Each salt is sorted
on its own and hands on one row, and these few rows are compared in full once more. Which texts those are is found by a count
of hashes, pre-aggregated before its shuffle; there can only be a few for each partition.

A null text counts as an empty one, and empty texts are equal. Rows that repeat an id are rows of their own: of equal text and
id one stays. A null id stays only if all rows of its text have none. An empty table gives no rows. Only the id and the text are
read; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.session import materialise

#: Bytes of a text that a splitter holds; its hash follows.
HEAD = 32
#: Bytes of text for each range, and for each salt of a text with many copies.
RANGE_BYTES, RUN_BYTES = 128 << 20, 32 << 20
#: A text has many copies if it holds more than 1 / HOT of a range's share of the rows.
HOT = 4


def _prepared(docs: DataFrame, key: str, text: str, normalise: Callable[[Column], Column] | None) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    plain = docs.select(F.col(key).cast("long").alias("id"), (normalise(body) if normalise else body).alias("text"))
    return plain.withColumn("hash", F.xxhash64("text"))


def mark(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "largest", normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """Every row as (key, keep_id, group_size, kept, text_sha256): the row of its text that stays, and whether it is this one.

    keep: `largest` or `smallest` id. normalise: an expression on the text, such as `F.lower`; equal is what is identical after it.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be 'largest' or 'smallest'")
    best, order = (F.max, F.desc_nulls_last("id")) if keep == "largest" else (F.min, F.asc_nulls_last("id"))
    rows = _prepared(docs, key, text, normalise)
    spark = docs.sparkSession
    sizes = materialise(rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")), "text-sizes")
    n, total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / RANGE_BYTES))
    many = max(1, math.ceil(n / (HOT * parts)))
    need = F.ceil(F.greatest(F.col("n") / many, F.col("bytes") / RUN_BYTES)).cast("int")
    hot = sizes.filter((F.col("n") > many) | (F.col("bytes") > RUN_BYTES)).select("hash", need.alias("salts"))
    # At most HOT * parts texts pass the first bound and total / RUN_BYTES <= HOT * parts the second.
    dealt = rows.join(F.broadcast(hot), "hash", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), F.col("salts")), F.lit(0)))
    dealt = dealt.withColumn("head", F.substring(F.col("text").cast("binary"), 1, HEAD))
    ranges = ["head", "hash", "salt"]
    sorted_rows = dealt.repartitionByRange(parts, *ranges)
    # The range partitioning serves the windows, which sort by (head, hash, salt, text, id) and compare whole texts of neighbours.
    run = Window.partitionBy(*ranges, "text")
    first = run.orderBy(order)
    runs = sorted_rows.select(
        "id", "text", "hash", "salts", F.first("id").over(first).alias("best"), F.row_number().over(first).alias("place"), F.count(F.lit(1)).over(run).alias("size"),
    )
    head_of_salt = F.col("salts").isNotNull() & (F.col("place") == 1)
    runs = runs.select("id", "best", "place", "size", F.sha2("text", 256).alias("digest"), F.when(head_of_salt, F.col("text")).alias("again"))
    runs = materialise(runs, "content-runs")
    # One row a salt of a hot text; whole texts are compared again.
    whole = runs.filter(F.col("again").isNotNull()).groupBy("again").agg(F.min("digest").alias("digest"), best("best").alias("all_best"), F.sum("size").alias("all_size"))
    out = runs.join(F.broadcast(whole.select("digest", "all_best", "all_size")), "digest", "left")  # one row a hot text
    found = F.col("all_size").isNotNull()
    keep_id = F.when(found, F.col("all_best")).otherwise(F.col("best"))
    return out.select(
        F.col("id").alias(key), keep_id.alias("keep_id"), F.coalesce("all_size", "size").alias("group_size"),
        (F.col("id").eqNullSafe(keep_id) & (F.col("place") == 1)).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def distinct_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "largest", normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """Ids of the rows that stay, one for each different text: a table to join the documents with."""
    return mark(docs, key, text, keep, normalise).filter("kept").select(key)
