"""Corpus preparation from raw documents to packed sequences: stages that each apply one corpus operator.

Every stage gets what the one before it kept, as columns of `documents`, and works on all of it. Its result is written before
the next stage is called; then the scratch tables that the earlier one has left behind are deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm import chosen_path, langid, mixing, packing, pii
from ratelens.llm.queries import PII_KEY, word_bpe
from ratelens.session import drop_scratch, materialise, noted_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Columns that all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Rows of a batch between Spark and Python. Rows are whole texts: 10,000 of them, as by default, fill buffers that an executor keeps.
BATCH_ROWS = 1000

#: Scratch tables of the stages called so far, by application.
_LEFT: dict[str, list[str]] = {}


def _tidy(stage: Stage) -> Stage:
    """A stage that first deletes the scratch tables of earlier ones, unless the rows that it is given still come from them."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        left = _LEFT.setdefault(spark.sparkContext.applicationId, [])
        read = "\n".join(docs.inputFiles())
        unused = [p for p in left if p.rsplit("/", 1)[-1] not in read]
        drop_scratch(spark, unused)
        left[:] = [p for p in left if p not in unused]
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)  # stays set, as the result is worked out later
        with noted_scratch() as notes:
            out = stage(spark, docs, sf_dir)
        left.extend(notes)
        return out

    return run_stage


@_tidy
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain; `lang` becomes the language found. Rows with a null id stay out of the model only."""
    model = langid.fit(docs)
    return langid.identify(docs.select(*COLUMNS), model).filter(~F.col("rejected")).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


@_tidy
def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id. Null ids are kept as they are."""
    found = chosen_path.near_duplicates(docs, percent=80)
    return chosen_path.only(docs.select(*COLUMNS), found.filter(~F.col("kept")), "doc_id", "left_anti").select(*COLUMNS)


@_tidy
def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; `n_chars` counts the new text."""
    done = pii.pseudonymise(docs.select(*COLUMNS), key=PII_KEY)
    return done.withColumn("n_chars", F.when(F.col("entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


@_tidy
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of a mixture in which sources weigh as the square root of their size."""
    plain = docs.select(*COLUMNS)
    return mixing.mix(plain, mixing.balanced_weights(plain), seed=2).orderBy("turn", "place").select(*COLUMNS)


@_tidy
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, taken in the order in which the mixture was written."""
    try:
        ordered = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        ordered.columns  # resolves the names
    except AnalysisException:  # not read from files: partitions in order
        at = F.monotonically_increasing_id()
        ordered = docs.select("*", F.lpad(F.shiftright(at, 33).cast("string"), 10, "0").alias("_file"), at.bitwiseAND(F.lit(2**33 - 1)).alias("_row"))
    return packing.pack(ordered, word_bpe(), end_id=0, capacity=2048, order=(F.col("_file"), F.col("_row")))


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("duplicates", duplicates),
    ("private", private),
    ("mixture", mixture),
    ("pack", pack),
]

#: Compression, similarity joins, token ids and best-fit planning are not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
