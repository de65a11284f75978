"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import urlsplit

from pyspark import SparkContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


_folders: set[str] = set()
_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder of the warehouse.

    Either is a place that all executors see, never one machine's temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if urlsplit(warehouse).scheme in ("", "file") and not _on_one_machine(spark):
        warnings.warn(
            f"spark.checkpoint.dir is not set; {warehouse} must be a folder that all executors share",
            stacklevel=2,
        )
    return warehouse + "/_staging"


def _on_one_machine(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "local").startswith("local")


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below the folder of the running job or the application."""
    folder = _job_folder.get() or _application_folder(spark)
    return f"{folder}/meterlake-{uuid.uuid4().hex}/{label}"


def _application_folder(spark: SparkSession) -> str:
    """Holds what lazily read results need; deleted when the application ends."""
    folder = f"{shared_folder(spark)}/meterlake-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_remove_at_end, folder)
    return folder


def _remove_at_end(folder: str) -> None:
    context = SparkContext._active_spark_context
    if context is not None and context._jvm is not None:
        remove(SparkSession(context), folder)
    elif not urlsplit(folder).scheme or folder.startswith("file:"):
        shutil.rmtree(urlsplit(folder).path, ignore_errors=True)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """For a job that stores its results: tables staged meanwhile are deleted at its end."""
    folder = f"{_job_folder.get() or shared_folder(spark)}/meterlake-{uuid.uuid4().hex}"
    token = _job_folder.set(folder)
    try:
        yield folder
    finally:
        _job_folder.reset(token)
        remove(spark, folder)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the true
    size of the table for its choice of join.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``stage`` and the number of rows, observed while writing."""
    observation = Observation(label)
    stored = stage(df.observe(observation, F.count(F.lit(1)).alias("rows")), label)
    return stored, observation.get["rows"]
