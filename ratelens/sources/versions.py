"""Tables that are replaced or added to while others read them: Parquet folders under a log of versions.

A version is a small JSON file that lists the folders making up the table. It is created under a number that must not
exist yet, after its data is written. So a writer that fails leaves the versions as they were, readers of a version go on
reading it, and of two writers who saw the same version one is told to look again.

Rows of a later version replace those of earlier ones with the same key (`read` with `key`). `compact` writes them as one
folder; `vacuum` deletes folders that only old versions name.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.session import drop_scratch

_LOG = "_versions"


class Conflict(Exception):
    """Another writer has added the version that this one was going to add."""


def _fs(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def latest(spark: SparkSession, root: str) -> int:
    """Number of the last version; 0 if there is none."""
    place, fs = _fs(spark, f"{root}/{_LOG}")
    if not fs.exists(place):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """{"version", "folders", "schema", "marks"} of a version, the last one by default. Version 0 has nothing."""
    version = latest(spark, root) if version is None else version
    if version == 0:
        return {"version": 0, "folders": [], "schema": None, "marks": {}}
    return json.loads(spark.read.option("wholetext", True).text(f"{root}/{_LOG}/{version:012d}.json").first()[0])


def _publish(spark: SparkSession, root: str, entry: dict) -> int:
    """Write a version's file in full under a name of its own, then give it its number if that is still free."""
    place, fs = _fs(spark, f"{root}/{_LOG}/{entry['version']:012d}.json")
    draft, _ = _fs(spark, f"{root}/{_LOG}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
    finally:
        out.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, place, options)  # refuses a name that exists
    except Py4JJavaError as failed:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(failed.java_exception):
            raise Conflict(f"version {entry['version']} of {root} exists") from None
        raise
    return entry["version"]


def commit(df: DataFrame, root: str, *, replace: bool, seen: int | None = None, mark: tuple[str, int] | None = None) -> int:
    """Add a version that holds `df`, in place of what was there or beside it, and return its number.

    seen: the version that `df` was made from; if there is a newer one by now, Conflict is raised and nothing changes.
    mark: (name of a writer, its batch number); a batch that is in the log already is not added again.
    """
    spark = df.sparkSession
    old = manifest(spark, root, seen)
    if mark and old["marks"].get(mark[0], -1) >= mark[1]:
        return old["version"]
    folder = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    marks = old["marks"] | ({mark[0]: mark[1]} if mark else {})
    folders = [folder] if replace else [*old["folders"], folder]
    return _publish(spark, root, {"version": old["version"] + 1, "folders": folders, "schema": df.schema.json(), "marks": marks})


def read(spark: SparkSession, root: str, *, key: str | None = None, version: int | None = None) -> DataFrame:
    """Rows of a version. With `key`, one row per key: that of the folder added last (equal keys in one folder: the greatest row).

    A null key is a key. Only the folders of the version are read.
    """
    from pyspark.sql.types import StructType

    held = manifest(spark, root, version)
    if not held["folders"]:
        raise ValueError(f"{root} has no version yet")
    schema = StructType.fromJson(json.loads(held["schema"]))
    rows = spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in held["folders"]])
    if key is None or len(held["folders"]) == 1:
        return rows
    # Folders are told apart by name; their order in the log comes as an array of the names.
    order = F.array_position(F.array(*[F.lit(f) for f in held["folders"]]), F.regexp_extract("_metadata.file_path", r"/(data-[0-9a-f]{32})/[^/]*\z", 1))
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    last = rows.select(F.col(f"`{key}`").alias("_key"), order.alias("_order"), row.alias("_row"))
    return last.groupBy("_key").agg(F.max_by("_row", F.struct("_order", "_row")).alias("_row")).select("_row.*")


def upsert(df: DataFrame, root: str, key: str, *, mark: tuple[str, int] | None = None, compact_after: int = 16) -> int:
    """Add rows that replace those with the same key. A table of more than `compact_after` folders is written as one.

    Rows of `df` with one key: the greatest one counts.
    """
    spark = df.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    one = df.select(F.col(f"`{key}`").alias("_key"), row.alias("_row")).groupBy("_key").agg(F.max("_row").alias("_row")).select("_row.*")
    version = commit(one, root, replace=False, mark=mark)
    return compact(spark, root, key) if len(manifest(spark, root, version)["folders"]) > compact_after else version


def compact(spark: SparkSession, root: str, key: str | None = None) -> int:
    """The last version as one folder. Older versions stay readable."""
    seen = latest(spark, root)
    return commit(read(spark, root, key=key, version=seen), root, replace=True, seen=seen)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete data that none of the last `keep` versions names, and the files of older versions. Returns how many folders went.

    Not to be run while another writer is at work: its folder is in no version yet.
    """
    last = latest(spark, root)
    kept = range(max(1, last - keep + 1), last + 1)
    named = {f for v in kept for f in manifest(spark, root, v)["folders"]}
    place, fs = _fs(spark, root)
    gone = [n for n in (s.getPath().getName() for s in fs.listStatus(place)) if n.startswith("data-") and n not in named]
    place, _ = _fs(spark, f"{root}/{_LOG}")
    old = [n for n in (s.getPath().getName() for s in fs.listStatus(place)) if n.endswith(".json") and not n.startswith(".") and int(n.removesuffix(".json")) < kept.start]
    drop_scratch(spark, [f"{root}/{_LOG}/{n}" for n in old] + [f"{root}/{n}" for n in gone])
    return len(gone)
