"""Gold brought up to date from the silver directories that changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators import gold as star
from meterlake.operators.quality import verify_gold
from meterlake.paths import refuse_overlap
from meterlake.plans.jobs import known_dimensions
from meterlake.schema import GOLD
from meterlake.sinks.balance import TASK, dealt
from meterlake.sinks.files import write_parquet
from meterlake.sinks.gold import new_version, publish
from meterlake.sources.files import file_inventory
from meterlake.sources.tables import (
    FACTS,
    HOME,
    SLICE,
    SOURCES,
    gold_path,
    published_version,
    read_gold_table,
    read_silver,
    version_sources,
)
from meterlake.staging import job_folder, remove, stage

#: Directory columns of silver that make a slice, unless others are named.
MONTHS = ("year", "month")
#: Slices that are told apart in a filter; where more changed, silver is read as a whole.
MOST_SLICES = 1_000
#: What Spark names the directory of a null.
NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"

_FILE = ["path", "length", "modificationTime"]


def _joined(values: Sequence[Column]) -> Column:
    return F.concat_ws(",", *values)


def slice_of_row(slice_by: Sequence[str]) -> Column:
    """The slice of a silver row, from directory columns alone."""
    return _joined(
        [F.coalesce(F.col(name).cast("string"), F.lit(NULL_DIRECTORY)) for name in slice_by]
    )


def directory_value(path: Column, name: str) -> Column:
    """What the directory ``name=…`` of a file's path says, without its escapes."""
    written = F.regexp_extract(path, f"/{name}=([^/]*)/", 1)
    return F.url_decode(F.regexp_replace(written, r"\+", "%2B"))


def slice_of_path(slice_by: Sequence[str]) -> Column:
    """The slice of a silver file, from the directories that it lies in."""
    return _joined([directory_value(F.col("path"), name) for name in slice_by])


def silver_files(spark: SparkSession, silver_path: str, slice_by: Sequence[str]) -> DataFrame:
    """path, length, modificationTime and slice of every file of silver, by listing alone."""
    files = file_inventory(spark, silver_path).filter(F.col("path").endswith(".parquet"))
    return files.withColumn(SLICE, slice_of_path(slice_by))


def changed_slices(now: DataFrame, before: DataFrame | None) -> list[str]:
    """Slices with files that came, went or changed; at most as many as there are slices."""
    if before is None:
        return sorted(row[0] for row in now.select(SLICE).distinct().collect())
    known = before.select(*_FILE, SLICE)
    came = now.join(known, [*_FILE, SLICE], "left_anti")
    went = known.join(now, [*_FILE, SLICE], "left_anti")
    either = came.select(SLICE).unionByName(went.select(SLICE)).distinct()
    return sorted(row[0] for row in either.collect())


def changed_rows(silver: DataFrame, slice_by: Sequence[str], slices: Sequence[str]) -> DataFrame:
    """The rows of some slices; other directories are not read."""
    rows = silver.withColumn(SLICE, slice_of_row(slice_by))
    if len(slices) > MOST_SLICES:
        wanted = silver.sparkSession.createDataFrame([(s,) for s in slices], f"{SLICE} string")
        return rows.join(wanted, SLICE, "left_semi")
    return rows.filter(slice_of_row(slice_by).isin(list(slices)))


def update_gold(
    spark: SparkSession,
    silver_path: str,
    gold_dir: str,
    *,
    slice_by: Sequence[str] = MONTHS,
    verify: bool = True,
) -> dict[str, int]:
    """Bring gold up to date with silver; returns the rows written per table, and the slices.

    A slice is what silver has in one combination of ``slice_by``, some of its directory
    columns. The version that readers see knows the silver files that it was built from; a
    listing tells which slices differ. Only their rows are read, verified and written; members
    keep their keys, so the facts of all other slices still join and stay where they are.
    The new version names for each slice the build that wrote its facts, and is published as
    a whole, or not at all if anything fails. The first update builds everything.
    """
    refuse_overlap(silver_path, gold_dir)
    version = new_version(gold_dir)
    home = version.rsplit("/", 1)[1]
    facts = f"{gold_dir.rstrip('/')}/{FACTS}"
    published = published_version(spark, gold_dir)
    before = version_sources(spark, published) if published else None
    with job_folder(spark):
        now = stage(silver_files(spark, silver_path, slice_by), "sources")
        slices = changed_slices(now, before)
        if published and before is not None and not slices:
            return {"slices": 0, **{table: 0 for table in GOLD}}
        try:
            rows = changed_rows(read_silver(spark, silver_path), slice_by, slices)
            known = known_dimensions(spark, gold_dir)
            written = {
                table: write_parquet(dimension, gold_path(version, table))
                for table, dimension in star.dimensions(rows, known).items()
            }
            stored = {table: read_gold_table(spark, version, table) for table in written}
            # silver is stored, so its rows are dealt to tasks there, and keep them through the joins
            named, tasks = dealt(rows, [SLICE])
            fact = star.faktentabelle(named, *stored.values(), carry=[SLICE, TASK])
            own = f"{facts}/{HOME}={home}"
            (
                fact.repartitionById(tasks, TASK)
                .drop(TASK)
                .write.mode("overwrite")
                .partitionBy(SLICE)
                .parquet(own)
            )
            stored["faktentabelle"] = (
                spark.read.schema(GOLD["faktentabelle"]).parquet(own)
                if slices
                else spark.createDataFrame([], GOLD["faktentabelle"])
            )
            written["faktentabelle"] = stored["faktentabelle"].count()
            if verify:
                _verify(stored, rows)
            _name_homes(now, before, slices, home).write.parquet(f"{version}/{SOURCES}")
            publish(spark, gold_dir, version)
        except BaseException:
            remove(spark, version)
            remove(spark, f"{facts}/{HOME}={home}")
            raise
    return {"slices": len(slices), **written}


def _verify(gold: dict[str, DataFrame], rows: DataFrame) -> None:
    checks = verify_gold(gold, rows).collect()
    failed = [check.check_name for check in checks if not check.passed]
    if failed:
        raise RuntimeError(f"gold does not match silver: {failed}")


def _name_homes(
    now: DataFrame, before: DataFrame | None, slices: Sequence[str], home: str
) -> DataFrame:
    """Every silver file with the build that wrote the facts of its slice."""
    if before is None:
        return now.withColumn(HOME, F.lit(home))
    changed = now.sparkSession.createDataFrame([(s, home) for s in slices], f"{SLICE} string, {HOME} string")
    kept = before.select(SLICE, HOME).distinct().join(changed, SLICE, "left_anti")
    return now.join(kept.unionByName(changed), SLICE)
