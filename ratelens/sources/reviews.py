"""Review tables as CSV, and optional inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ratelens.config import REVIEW_COLUMNS
from ratelens.operators.cleaning import drop_invalid_ids, require_columns, require_row_count, typed_reviews

RAW_REVIEWS = T.StructType([T.StructField(c, T.StringType(), True) for c in REVIEW_COLUMNS])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """CSV with a header and quoted text that may span lines.

    A multi-line file cannot be split, so large tables should come as many files (or be stored as
    Parquet once after this read).
    """
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", multiline).option("escape", '"')
        .option("enforceSchema", False).csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a folder of CSV files with header; one file per partition."""
    (
        df.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", False)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", '""').csv(path)
    )


def load_reviews(spark: SparkSession, path: str, *, clean: bool = False, expected_rows: int | None = None,
                 date_format: str = "M/d/yyyy H:mm") -> DataFrame:
    """Typed review table; `clean` drops rows with broken ids, `expected_rows` makes the load strict."""
    df = typed_reviews(require_columns(read_csv(spark, path, RAW_REVIEWS)), date_format)
    if clean:
        df = drop_invalid_ids(df)
    return require_row_count(df, expected_rows, "reviews") if expected_rows is not None else df


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def read_optional_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, bool]:
    """The table, or an empty one of the same schema when the path does not exist."""
    if path_exists(spark, path):
        return read_csv(spark, path, schema), True
    return spark.createDataFrame([], schema), False
