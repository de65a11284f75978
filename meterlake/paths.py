"""Rules about paths, shared by jobs and configured sources."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def let_workers_import(spark: SparkSession) -> None:
    """Put this library on the path of Python workers that start on the same machine.

    On a cluster the library is installed there, or given to ``spark-submit --py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{paths}:{root}".lstrip(":")


def refuse_overlap(*paths: str) -> None:
    """No job may overwrite what it reads."""
    folders = [path.rstrip("/") + "/" for path in paths]
    for i, one in enumerate(folders):
        for other in folders[i + 1 :]:
            if one.startswith(other) or other.startswith(one):
                raise ValueError(f"paths overlap: {one!r} and {other!r}")
