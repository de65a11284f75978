"""The jobs, from path to path. Any failure ends the job and the chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.operators import gold as star
from meterlake.operators.quality import DIMENSION_KEYS, verify_gold
from meterlake.operators.quarantine import typed_with_faults
from meterlake.operators.sensor import bucket_averages
from meterlake.operators.silver import typed, typed_raw
from meterlake.paths import refuse_overlap
from meterlake.schema import GOLD_INPUT
from meterlake.sinks.balance import bytes_set
from meterlake.sinks.database import export_checked, export_once
from meterlake.sinks.files import write_csv, write_parquet, write_silver
from meterlake.sinks.gold import new_version, publish
from meterlake.sinks.load_record import append_load_record
from meterlake.sources.files import read_bronze, read_header_csv, read_measurement_file
from meterlake.sources.tables import (
    gold_path,
    published_version,
    read_gold,
    read_gold_table,
    read_silver,
)
from meterlake.staging import job_folder, remove, stage


def bronze_to_silver_job(
    spark: SparkSession,
    bronze_root: str,
    silver_path: str,
    *,
    rejects_path: str | None = None,
    **write_options,
) -> dict[str, int]:
    """Returns the cleaning counts of the run.

    With ``rejects_path``, cells that were lost and rows that were dropped are stored there,
    from the same reading of the files.
    """
    refuse_overlap(bronze_root, silver_path, *([rejects_path] if rejects_path else []))
    if rejects_path is None:
        return write_silver(typed(read_bronze(spark, bronze_root)), silver_path, **write_options)
    rows = typed_with_faults(read_bronze(spark, bronze_root, with_file=True))
    return write_silver(rows, silver_path, rejects_path=rejects_path, **write_options)


def known_dimensions(spark: SparkSession, gold_dir: str) -> dict[str, DataFrame]:
    """The dimensions of the published version, whose members keep their keys."""
    version = published_version(spark, gold_dir)
    if version is None:
        return {}
    return {table: read_gold_table(spark, version, table) for table in DIMENSION_KEYS}


#: Files from which on a table may be stored anew before it is read several times.
MANY_FILES = 1_000


def read_once(silver: DataFrame) -> DataFrame:
    """What gold takes from ``silver``; stored in few files, where opening all of them takes longer
    than reading them, by what the session says that a file costs to open."""
    found = silver._jdf.inputFiles()
    rows = silver.select(*GOLD_INPUT)
    if len(found) < MANY_FILES:
        return rows
    spark = silver.sparkSession
    size = silver._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if size > len(found) * bytes_set(spark, "spark.sql.files.openCostInBytes"):
        return rows
    return stage(rows, "gold_input")


def build_gold(
    silver: DataFrame, gold_dir: str, *, verify: bool = True, keep_keys: bool = True
) -> dict[str, int]:
    """Write all four tables as a new version, verify them, then publish the version.

    The fact joins the stored dimensions. Until the end readers see the version before, and
    they go on doing so if anything fails; the new one is deleted then. Returns the rows
    written per table.

    Silver in many small files is opened twice: to store what gold takes from it, and to verify
    the tables, by the files themselves.

    Members of the version before keep their keys, also those that silver has no more, so
    facts copied earlier still join; ``keep_keys=False`` numbers all members anew.
    """
    spark = silver.sparkSession
    version = new_version(gold_dir)
    try:
        with job_folder(spark):
            known = known_dimensions(spark, gold_dir) if keep_keys else {}
            read = read_once(silver)
            rows = {
                table: write_parquet(dimension, gold_path(version, table))
                for table, dimension in star.dimensions(read, known).items()
            }
            stored = [read_gold_table(spark, version, table) for table in rows]
            fact = star.faktentabelle(read, *stored)
            rows["faktentabelle"] = write_parquet(fact, gold_path(version, "faktentabelle"))
            checks = verify_gold(read_gold(spark, version), silver).collect() if verify else []
        failed = [check.check_name for check in checks if not check.passed]
        if failed:
            raise RuntimeError(f"gold does not match silver: {failed}")
        publish(spark, gold_dir, version)
    except BaseException:
        remove(spark, version)
        raise
    return rows


def silver_to_gold_job(spark: SparkSession, silver_path: str, gold_dir: str) -> dict[str, int]:
    refuse_overlap(silver_path, gold_dir)
    return build_gold(read_silver(spark, silver_path), gold_dir)


def export_gold_job(
    spark: SparkSession,
    gold_dir: str,
    url: str,
    *,
    properties: dict[str, str] | None = None,
    schema: str = "public",
    once: bool = False,
    **options,
) -> dict[str, int]:
    """Copy the gold tables to ``<schema>.<table>``; returns the rows per table.

    With ``once`` the tables change together, when all have arrived, and the version of gold
    names the load: an export that is started again sends nothing twice (``export_once``).
    """
    if once:
        version = published_version(spark, gold_dir)
        if version is None:
            raise ValueError(f"{gold_dir}: only published versions are exported once")
        named = {f"{schema}.{table}": df for table, df in read_gold(spark, version).items()}
        rows = export_once(named, url, load_id=version, properties=properties, **options)
        return {table.removeprefix(f"{schema}."): count for table, count in rows.items()}
    return {
        table: export_checked(df, url, f"{schema}.{table}", properties=properties, **options)
        for table, df in read_gold(spark, gold_dir).items()
    }


def run_chain(
    spark: SparkSession,
    bronze_root: str,
    silver_path: str,
    gold_dir: str,
    *,
    jdbc_url: str | None = None,
    jdbc_properties: dict[str, str] | None = None,
    **write_options,
) -> dict[str, dict[str, int]]:
    """Bronze to silver to gold, then to the database if one is named.

    ``write_options`` go to ``write_silver``.
    """
    refuse_overlap(bronze_root, silver_path, gold_dir)
    done = {
        "silver": bronze_to_silver_job(spark, bronze_root, silver_path, **write_options),
        "gold": silver_to_gold_job(spark, silver_path, gold_dir),
    }
    if jdbc_url:
        done["database"] = export_gold_job(
            spark, gold_dir, jdbc_url, properties=jdbc_properties
        )
    return done


def load_measurement_file(
    spark: SparkSession,
    csv_path: str,
    url: str,
    records_path: str,
    *,
    table: str = "testdaten",
    properties: dict[str, str] | None = None,
) -> int:
    """One measurement file into one database table, with a load record."""
    df = typed_raw(read_measurement_file(spark, csv_path))
    rows = export_checked(df, url, table, properties=properties)
    append_load_record(spark, records_path, table, rows)
    return rows


def sensor_job(
    spark: SparkSession,
    csv_path: str,
    csv_copy: str,
    parquet_copy: str,
    averages_path: str,
) -> DataFrame:
    """Copy raw sensor CSV to CSV and Parquet, average the Parquet copy, store that."""
    refuse_overlap(csv_path, csv_copy, parquet_copy, averages_path)
    raw = read_header_csv(spark, csv_path)
    write_csv(raw, csv_copy)
    written = write_parquet(raw, parquet_copy)
    copy = spark.read.parquet(parquet_copy)
    if copy.count() != written:
        raise RuntimeError(f"{parquet_copy}: {written} rows written, {copy.count()} read")
    write_parquet(bucket_averages(copy), averages_path)
    return spark.read.parquet(averages_path)
