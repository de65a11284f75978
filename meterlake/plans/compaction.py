"""Silver in versions: batches are added, small files are packed, readers are never disturbed.

A store holds ``readings/home=<build>/<directories>``, where a build is one batch or one
packing, and versions that list their units: what a build holds in a directory, with files
and bytes. Readers follow the last published version. Files are never changed; those that
neither the published version nor the one before lists are deleted build by build.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.plans.incremental import NULL_DIRECTORY, directory_value
from meterlake.schema import SILVER, SILVER_PARTITIONS
from meterlake.sinks.balance import DIRECTORIES_PER_TASK, advisory_bytes
from meterlake.sinks.files import write_silver
from meterlake.sinks.gold import new_version, publish
from meterlake.sources.files import file_inventory
from meterlake.sources.tables import HOME, READINGS, UNITS, published_version, version_table
from meterlake.staging import job_folder, remove, stage

_STORED = T.StructType([*SILVER.fields, T.StructField(HOME, T.StringType())])
_SIZES = ("files", "bytes")


def _home_path(store: str, home: str) -> str:
    return f"{store.rstrip('/')}/{READINGS}/{HOME}={home}"


def directory_columns(units: DataFrame) -> list[str]:
    """The directory columns of a store, the same for all its builds."""
    return [name for name in units.columns if name not in (HOME, *_SIZES)]


def silver_units(spark: SparkSession, store: str) -> DataFrame | None:
    """home, directory columns (as text), files and bytes of the published version."""
    version = published_version(spark, store)
    return None if version is None else version_table(spark, version, UNITS)


def _listed(spark: SparkSession, store: str, home: str, columns: Sequence[str]) -> DataFrame:
    """The units of one build, by listing alone."""
    inner = F.concat(F.lit("/"), F.substring_index("path", f"/{HOME}={home}/", -1))
    files = file_inventory(spark, _home_path(store, home)).filter(
        F.col("path").endswith(".parquet") & (F.col("length") > 0)
    )
    return (
        files.select(*[directory_value(inner, name).alias(name) for name in columns], "length")
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        .select(F.lit(home).alias(HOME), *columns, *_SIZES)
    )


def _in_unit(columns: Sequence[str]) -> Column:
    """Whether a stored row lies in a unit; told by directory columns alone."""
    pairs = [F.col(HOME) == F.col(f"_{HOME}")]
    pairs += [
        F.coalesce(F.col(name).cast("string"), F.lit(NULL_DIRECTORY)) == F.col(f"_{name}")
        for name in columns
    ]
    return reduce(lambda a, b: a & b, pairs)


def _stored_rows(spark: SparkSession, store: str, homes: Sequence[str]) -> DataFrame:
    rows = spark.read.schema(_STORED).parquet(f"{store.rstrip('/')}/{READINGS}")
    return rows.filter(F.col(HOME).isin(list(homes)))


def _keys(units: DataFrame, *more: str) -> DataFrame:
    """The units as the other side of a join with rows, known as few to the optimizer."""
    names = [HOME, *directory_columns(units)]
    named = [F.col(name).alias(f"_{name}") for name in names]
    return units.filter(F.col("files") > 0).select(*named, *more)


def _home_names(units: DataFrame) -> list[str]:
    return sorted(row[0] for row in units.select(HOME).distinct().collect())


def read_silver_version(spark: SparkSession, store: str) -> DataFrame:
    """Silver rows of the published version.

    Builds that it does not use are left out when the query is planned. Units that were
    packed in builds it still uses go by a join on directory columns, from which Spark prunes
    directories while the query runs; filters on directory columns prune as ever.
    """
    units = silver_units(spark, store)
    if units is None:
        raise FileNotFoundError(f"{store}: no version was published")
    rows = _stored_rows(spark, store, _home_names(units))
    wanted = _in_unit(directory_columns(units))
    return rows.join(_keys(units), wanted, "left_semi").select(*SILVER.names)


def _publish_units(
    spark: SparkSession, store: str, units: DataFrame, before: str | None
) -> None:
    version = new_version(store)
    try:
        units.write.parquet(f"{version}/{UNITS}")
        publish(spark, store, version, after=before)
    except BaseException:
        remove(spark, version)
        raise


def add_silver(
    typed: DataFrame,
    store: str,
    *,
    partition_by: Sequence[str] = SILVER_PARTITIONS,
    **write_options,
) -> dict[str, int]:
    """Clean a batch and publish a version with it; returns the cleaning counts.

    All or nothing: if anything fails, or another version is published meanwhile, the batch's
    files are deleted and an error tells so. A batch without good rows changes nothing for
    readers. ``write_options`` go to ``write_silver``.
    """
    spark = typed.sparkSession
    before = published_version(spark, store)
    units = None if before is None else version_table(spark, before, UNITS)
    columns = list(partition_by)
    if not columns:
        raise ValueError("a store of silver needs directory columns")
    if units is not None and directory_columns(units) != columns:
        raise ValueError(f"{store}: its directories are {directory_columns(units)}")
    home = uuid.uuid4().hex
    path = _home_path(store, home)
    try:
        counts = write_silver(typed, path, partition_by=columns, **write_options)
        added = _listed(spark, store, home, columns)
        _publish_units(spark, store, added if units is None else units.unionByName(added), before)
    except BaseException:
        remove(spark, path)
        raise
    return counts


def crowded_units(units: DataFrame, target_bytes: int) -> DataFrame:
    """Units worth packing, each with ``pieces``, the files its directory will have for them.

    A unit is small if its files have less than half the target on average. The small units of
    a directory are packed if that at least halves their files, so a row is rewritten a
    number of times that grows with the logarithm of the batches only, and large files never.
    """
    columns = directory_columns(units)
    small = units.filter(F.col("bytes") * 2 < F.col("files") * target_bytes)
    pieces = F.ceil(F.sum("bytes") / target_bytes).alias("pieces")
    directories = (
        small.groupBy(*columns)
        .agg(F.sum("files").alias("_files"), pieces)
        .filter((F.col("_files") >= 2) & (F.col("pieces") * 2 <= F.col("_files")))
        .drop("_files")
    )
    return small.join(directories, columns)


def compact_silver(
    spark: SparkSession, store: str, *, target_bytes: int | None = None
) -> dict[str, int]:
    """Pack the small files of each directory into files of about ``target_bytes``.

    The listing of the published version says which units are crowded; only they are read.
    A directory's rows are dealt to as many files as its bytes ask for, by the file and the
    place in it that a row comes from: a task that is tried again deals them the same way, and
    neither a large directory nor many equal rows end in one task. Tasks follow from bytes and
    directories. The rows are counted before and after, then a version with the packed files in
    place of the small ones is published whole. Readers of the version before go on reading
    its files, which stay until the next version.

    ``target_bytes`` is the session's advisory partition size unless given. Returns the
    number of directories packed, their files before and after, and their rows.
    """
    before = published_version(spark, store)
    if before is None:
        raise FileNotFoundError(f"{store}: no version was published")
    units = version_table(spark, before, UNITS)
    columns = directory_columns(units)
    home = uuid.uuid4().hex
    path = _home_path(store, home)
    with job_folder(spark):
        packed = stage(crowded_units(units, target_bytes or advisory_bytes(spark)), "packed")
        directories, files, size, pieces = (
            packed.groupBy(*columns, "pieces")
            .agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))
            .agg(F.count(F.lit(1)), F.sum("files"), F.sum("bytes"), F.sum("pieces"))
            .first()
        )
        if not directories:
            return {"directories": 0, "files_before": 0, "files_after": 0, "rows": 0}
        stored = _stored_rows(spark, store, _home_names(packed))
        expected = stored.join(_keys(packed), _in_unit(columns), "left_semi").count()
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        tasks = max(
            -(-size // advisory_bytes(spark)),
            -(-pieces // DIRECTORIES_PER_TASK),
            min(pieces, spark.sparkContext.defaultParallelism),
        )
        observation = Observation("packed")
        try:
            (
                stored.withColumn("_place", place)
                .join(_keys(packed, "pieces"), _in_unit(columns))
                .withColumn("_piece", F.pmod("_place", "pieces"))
                .repartition(tasks, *columns, "_piece")
                .select(*SILVER.names)
                .observe(observation, F.count(F.lit(1)).alias("rows"))
                .write.partitionBy(*columns)
                .parquet(path)
            )
            written = observation.get["rows"]
            if written != expected:
                raise RuntimeError(f"{store}: {expected} rows to pack, {written} written")
            added = stage(_listed(spark, store, home, columns), "added")
            left = units.join(packed.select(HOME, *columns), [HOME, *columns], "left_anti")
            _publish_units(spark, store, left.unionByName(added), before)
        except BaseException:
            remove(spark, path)
            raise
        after = added.agg(F.sum("files")).first()[0]
    return {"directories": directories, "files_before": files, "files_after": after, "rows": written}
