"""Written intermediate tables, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from maskwright.sources.files import remove

SETTING = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. A local session without one gets a folder of its own."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="maskwright-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write a frame once and read it back.

    Used where two outputs come from one scan. Unlike a cache it survives lost executors, and
    a reader takes only the columns it needs. The table may hold original values: give a
    ``path`` in a protected place if the shared folder is not one.
    """
    target = path or new_path(df.sparkSession, name)
    df.write.mode("error").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


@contextmanager
def staged(df: DataFrame, name: str = "stage", path: str | None = None) -> Iterator[DataFrame]:
    """A staged table that is deleted at the end, whether what reads it has worked or not."""
    target = path or new_path(df.sparkSession, name)
    try:
        yield stage(df, name, target)
    finally:
        remove(df.sparkSession, target)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of each finished query go at once, not when the driver happens to
    collect its garbage. For steps that are written tables, so that no later one reads those files."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
