"""Session settings the operators rely on at scale, and the folder for intermediate tables."""

from __future__ import annotations

import uuid

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings, all changeable on a running session.
SETTINGS = {
    # re-plan joins and partition counts from the sizes seen after each shuffle
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split a hot key's partition in every join, even if that costs one more shuffle downstream
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings and return the session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate data: ``spark.checkpoint.dir``, else one beneath the warehouse.

    Both are settings of the cluster that name storage every executor reaches; no temp folder is used.
    """
    return (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/calloom-checkpoints"
    )


_scope: ContextVar[str] = ContextVar("scope", default="")


def stage_folder(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/calloom-stages/{spark.sparkContext.applicationId}{_scope.get()}"


# An execution's shuffle files go as it ends. Else they stay until the driver happens to collect its garbage, and the
# disk holds those of all steps so far.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_stage(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write a table that is read again, free what was shuffled for it, and go on from the written copy."""
    spark = df.sparkSession
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path, **options)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def stage(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the checkpoint folder and go on from the written copy.

    For results that are read several times below: they are computed once, later steps read only the
    columns they need, and a lost executor costs no more than reading again. For results of a long chain of
    shuffles too: the disk holds one step's shuffle files at a time.
    """
    return write_stage(df, f"{stage_folder(df.sparkSession)}/{uuid.uuid4().hex}")


def stage_of(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """``stage(build())``, without the intermediate tables that ``build`` makes: they go once the result is written.

    The result may stay long, so it is packed tighter than those.
    """
    path = f"{stage_folder(spark)}/{uuid.uuid4().hex}"
    with staged(spark):
        return write_stage(build(), path, compression="zstd")


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path, files = _path(spark, folder)
    return files.exists(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path, files = _path(spark, folder)
    files.delete(path, True)


def drop_stages(spark: SparkSession) -> None:
    """Remove this application's intermediate tables, once nothing that was built on them is read any more."""
    drop_folder(spark, stage_folder(spark))


@contextmanager
def staged(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside go into a folder of their own, which is removed at the end."""
    before = _scope.set(f"{_scope.get()}/{uuid.uuid4().hex}")
    try:
        yield
    finally:
        drop_stages(spark)
        _scope.reset(before)
