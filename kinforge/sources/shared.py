"""Tables between the steps of a plan, in the folder that all executors share.

A staged table is Parquet below ``spark.checkpoint.dir``: it cuts the lineage, survives the loss of an
executor and is read by column. It is removed when the application ends, or at the end of the ``scope`` it was
staged in. Only in local mode may that setting be unset; then a folder of this process's own is set once for the
session. On a cluster an unset setting raises, as executors would write to disks that others can't read.
"""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: The paths staged in each open scope, the innermost last.
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="kinforge-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        folder = f"file://{own}"
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def file_system(spark: SparkSession, path: str) -> tuple:
    """The file system of a path and the path as it takes it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that goes with the innermost scope, or else with the application."""
    path = f"{shared_folder(spark)}/kinforge/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    files, at = file_system(spark, path)
    files.deleteOnExit(at)
    return path


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """What is staged within is removed at the end: nothing that is read later may depend on it."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            files, at = file_system(spark, path)
            files.delete(at, True)
            files.cancelDeleteOnExit(at)


def scoped(function: Callable) -> Callable:
    """A function whose first argument is the session, in a scope of its own."""

    @functools.wraps(function)
    def run(spark: SparkSession, *args, **kwargs):
        with scope(spark):
            return function(spark, *args, **kwargs)

    return run


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a query that is run within goes at its end, and not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, True)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df and return it as read back; its rows are computed once, however often they are used."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
