"""Session helper and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Temporary folders of local sessions, by application: the setting itself cannot be changed in a running session.
_LOCAL_ROOTS: dict[str, str] = {}
#: Lists that take note of new scratch paths (see noted_scratch).
_NOTES: list[list[str]] = []


def get_session(app: str = "ratelens", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """Session with the settings the plans assume (AQE on, UTC, skew-join splitting on)."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a temporary one only for local sessions."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="ratelens-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    for notes in _NOTES:
        notes.append(path)
    return path


@contextmanager
def noted_scratch() -> Iterator[list[str]]:
    """The scratch paths that are made inside the block, for whoever knows when they are no longer read."""
    notes: list[str] = []
    _NOTES.append(notes)
    try:
        yield notes
    finally:
        _NOTES[:] = [n for n in _NOTES if n is not notes]


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables in the shared folder. Nothing may read them any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the scratch folder and read it back, so that several passes do not recompute it.

    Unlike a cache it survives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
