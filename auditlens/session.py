"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

FOLDER_SETTING = "spark.checkpoint.dir"

# Folders of local sessions, removed when the process ends.
_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def use_utc(spark: SparkSession) -> SparkSession:
    """Days are UTC days, so the session has to read and cut timestamps in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see. Only a local session may fall back to a folder of its own."""
    context = spark.sparkContext
    folder = spark.conf.get(FOLDER_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {FOLDER_SETTING} to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.TemporaryDirectory(prefix="auditlens-")
    return _local_folders[context.applicationId].name


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several branches read to the shared folder, and read it back.

    Cuts the lineage: the branches scan columnar files and do not repeat the work above, and a
    lost executor costs a re-read only. The files stay until the caller has read its results and
    calls `drop_settled`.
    """
    spark = df.sparkSession
    path = f"{_settled_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _settled_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/auditlens/{spark.sparkContext.applicationId}"


def drop_settled(spark: SparkSession) -> None:
    """Delete what this application settled. Call it when all results are written."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(_settled_folder(spark))
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def side_by_side(*tasks: Callable[[], Result]) -> list[Result]:
    """Run tasks that each start Spark jobs and do not need each other at the same time."""
    spark = SparkSession.active()
    with ThreadPoolExecutor(len(tasks)) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        return [run.result() for run in runs]
