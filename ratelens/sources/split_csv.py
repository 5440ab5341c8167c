"""CSV files with quoted text over several lines, read by as many tasks as a file has splits.

Lines come from Spark's text source, which cuts a file at any line. Whether a line begins inside quotes is the parity of the
quote characters before it in its file (a doubled quote counts twice and changes nothing). A split is cut again into pieces of
a bounded number of lines, so that the exchange that orders lines deals pieces and not whole splits. Quotes are counted per piece,
added up over the pieces of a file (one row each), and then line by line inside a piece. Lines of one record are put together
inside their piece; only the records that cross the border of two pieces are joined over an exchange of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPLIT = ["file", "split"]
#: Lines of a piece.
PIECE_LINES = 8192


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, split, at, line, quotes): lines of all files by pieces of their splits; `at` orders those of one piece."""
    at = F.monotonically_increasing_id()  # the number of a task over that of its line, in 33 bits
    piece = F.floor(at.bitwiseAND((1 << 33) - 1) / PIECE_LINES).cast("long")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("start"), piece.alias("piece")).alias("split"), at.alias("at"),
        F.col("value").alias("line"), (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, number, record): the records of every file, numbered from 0 in file order, their text as it stands.

    A carriage return before the end of a record belongs to the line end. Empty lines outside quotes are no records. A quote
    that is never closed makes the rest of its file one record, as for any reader.
    """
    lines = _lines(spark, path)
    # Quotes and record starts of a piece, the latter for either state at its first line.
    inside = Window.partitionBy(*_SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(inside), F.lit(0)) % 2
    blank = F.col("line").isin("", "\r")
    marked = lines.select("*", odd.alias("odd"), blank.alias("blank"))
    splits = marked.groupBy(*_SPLIT).agg(
        F.sum("quotes").alias("quotes"), F.count_if((F.col("odd") == 0) & ~F.col("blank")).alias("even"), F.count_if((F.col("odd") == 1) & ~F.col("blank")).alias("uneven"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    states = splits.withColumn("open", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    starts = F.when(F.col("open") == 0, F.col("even")).otherwise(F.col("uneven"))
    states = states.select(*_SPLIT, "open", F.coalesce(F.sum(starts).over(before), F.lit(0)).alias("first"))

    begins = ((F.col("odd") + F.col("open")) % 2 == 0)
    upto = Window.partitionBy(*_SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = marked.join(states, _SPLIT).filter(~(begins & F.col("blank")))
    numbered = placed.withColumn("number", F.col("first") + F.sum(begins.cast("long")).over(upto) - 1)
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n")
    parts = numbered.groupBy(*_SPLIT, "number", "first").agg(whole.alias("text"), F.sum("quotes").alias("quotes"))
    # A part is a whole record if it begins in its piece and its quotes are closed there.
    complete = (F.col("number") >= F.col("first")) & (F.col("quotes") % 2 == 0)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "text"))), lambda x: x["text"]), "\n")
    crossing = parts.filter(~complete).groupBy("file", "number").agg(joined.alias("text"))
    out = parts.filter(complete).select("file", "number", "text").unionAll(crossing.select("file", "number", "text"))
    return out.select("file", "number", F.regexp_replace("text", r"\r\z", "").alias("record"))


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of CSV files with a header each, as the multi-line reader of one task a file gives them.

    Line ends inside quotes stay as they are written (the other reader turns them into the line end of the file).
    """
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    rows = read_records(spark, path).filter(F.col("number") > 0)
    return rows.select(F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("r")).select("r.*")
