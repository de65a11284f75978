"""Rows dealt to writing tasks by the directories they go to, not by their bytes alone.

Opening and closing a file costs as much as writing many rows, so a task with few bytes may
still have very much to do. Adaptive execution sees bytes only and would give thousands of
small directories to one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.staging import stage

#: Directories that one task writes, at most about.
DIRECTORIES_PER_TASK = 500
#: Rows that one task sorts and writes, at most about: encoded files may be far smaller than rows.
ROWS_PER_TASK = 1_000_000
#: A directory with less than this part of a task's rows is dealt by its hash.
SMALL = 8
#: Names the task that a row is dealt to.
TASK = "_task"
#: Directories with more rows are broadcast up to this many.
MOST_BROADCAST = 100_000


def stored_bytes(spark: SparkSession, folder: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(path).getLength()


def advisory_bytes(spark: SparkSession) -> int:
    """What the session takes for a good size of a task."""
    return bytes_set(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def bytes_set(spark: SparkSession, name: str) -> int:
    """A size among the session's settings, which may say 64MB."""
    size = spark.conf.get(name)
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def _same(columns: Sequence[str], other: DataFrame) -> Column:
    pairs = [F.col(name).eqNullSafe(other[f"_hot_{name}"]) for name in columns]
    return reduce(lambda a, b: a & b, pairs)


def _numbered(large: DataFrame, columns: Sequence[str], cut_at: int, per_task: int) -> DataFrame:
    """Large directories with their first row in a row of all, and the pieces they are cut into.

    Their number is bounded by that of the tasks, so one window may run over them.
    """
    order = Window.orderBy(F.desc("_rows"), *columns)
    before = F.sum("_rows").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = SMALL * F.ceil(F.col("_rows") / per_task)
    return large.select(
        *[F.col(name).alias(f"_hot_{name}") for name in columns],
        F.col("_rows").alias("_size"),
        F.coalesce(before, F.lit(0)).alias("_start"),
        F.when(F.col("_rows") > cut_at, parts).otherwise(1).alias("_pieces"),
    )


def dealt(
    stored: DataFrame, columns: Sequence[str], size: int = 0, *, partitions: int | None = None
) -> tuple[DataFrame, int]:
    """``stored`` rows with the task that should write each (``TASK``), and how many tasks.

    Rows of a directory come together and many small directories share a task. Large ones are
    laid end to end and dealt to tasks by where they start, so no two of them meet by chance; a
    directory with more rows than a task should have is cut. What a task should have follows
    from rows and from ``size``, the bytes of all. Rows are dealt to pieces by their place in the stored files, so a
    task that is tried again sends them the same way, and equal rows may part. There are at
    least as many tasks as cores, unless there are fewer directories; ``partitions`` sets
    their number.
    """
    spark = stored.sparkSession
    counts = stage(
        stored.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")), "directories"
    )
    directories, rows, largest = counts.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0)), F.max("_rows")
    ).first()
    cut_at = max(1, min(ROWS_PER_TASK, rows * advisory_bytes(spark) // max(1, size)))
    cores = min(directories, spark.sparkContext.defaultParallelism)
    per_task = max(1, min(cut_at, -(-rows // (partitions or max(1, cores)))))
    if not rows or largest * SMALL <= per_task:
        few = max(1, -(-rows // per_task), -(-directories // DIRECTORIES_PER_TASK))
        tasks = partitions or few
        return stored.withColumn(TASK, F.pmod(F.hash(*columns), F.lit(tasks))), tasks
    is_large = F.col("_rows") * SMALL > per_task
    many, large_rows = counts.filter(is_large).agg(F.count(F.lit(1)), F.sum("_rows")).first()
    first = -(-large_rows // per_task)  # tasks of large directories, before those of small ones
    others = max(-(-(rows - large_rows) // per_task), -(-(directories - many) // DIRECTORIES_PER_TASK))
    large = _numbered(counts.filter(is_large), columns, cut_at, per_task)
    if many <= MOST_BROADCAST:
        large = F.broadcast(large)
    piece = F.pmod(F.xxhash64("_place"), F.col("_pieces"))
    row = F.col("_start") + F.floor(piece * F.col("_size") / F.col("_pieces"))
    small = F.lit(first) + F.pmod(F.xxhash64(*columns), F.lit(max(1, others)))
    task = F.when(F.col("_start").isNull(), small).otherwise(F.floor(row / per_task))
    tasks = partitions or first + others
    named = (
        stored.withColumn("_place", F.monotonically_increasing_id())
        .join(large, _same(columns, large), "left")
        .select(*stored.columns, F.pmod(task, F.lit(tasks)).cast("int").alias(TASK))
    )
    return named, tasks


def spread(
    stored: DataFrame, columns: Sequence[str], size: int, *, partitions: int | None = None
) -> DataFrame:
    """``stored`` rows, of ``size`` bytes in all, in tasks that are about equally long."""
    rows, tasks = dealt(stored, columns, size, partitions=partitions)
    return rows.repartitionById(tasks, TASK).drop(TASK)
