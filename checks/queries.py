"""The registered queries: operators applied to the given tables as a whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import event_measurements, event_sensor, lineitem_measurements
from meterlake.operators import gold as star
from meterlake.operators import quality, silver
from meterlake.operators.explore import explore, fill_gaps
from meterlake.operators.partials import Partials, explore_stored, partials
from meterlake.operators.prune import readings_where
from meterlake.operators.report import module_month_report
from meterlake.operators.sensor import add_bucket, bucket_averages
from meterlake.plans import jobs
from meterlake.plans.compaction import (
    add_silver,
    compact_silver,
    read_silver_version,
    silver_units,
)
from meterlake.plans.incremental import update_gold
from meterlake.schema import BRONZE_PARTITIONS, MEASUREMENT_NAMES, SILVER
from meterlake.sinks import (
    append_load_record,
    read_load_records,
    write_csv,
    write_data,
    write_parquet,
    write_silver,
)
from meterlake.sources import (
    file_inventory,
    read_bronze,
    read_data,
    read_gold,
    read_header_csv,
    read_measurement_file,
    read_silver,
)
from meterlake.staging import new_path
from meterlake.streaming import start_silver_stream

Query = Callable[[SparkSession, str], DataFrame]

#: Directory columns that keep files large where meters have few readings a month.
MONTHLY = ["modul", "intervall", "year", "month"]


# --- inputs shared by several queries ---------------------------------------


def event_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.bronze_to_silver(event_measurements(spark, sf_dir)).select(*SILVER.names)


def bronze_tree(measurements: DataFrame) -> str:
    """The bronze tree on disk."""
    root = new_path(measurements.sparkSession, "bronze")
    write_csv(
        measurements,
        root,
        partition_by=["modul", "intervall"],
        header="true",
        sep=";",
    )
    return root


def event_tree(spark: SparkSession, sf_dir: str) -> str:
    return bronze_tree(event_measurements(spark, sf_dir))


def event_file(spark: SparkSession, sf_dir: str) -> str:
    """Measurement files without directory columns, written from ``events``."""
    path = new_path(spark, "measurements")
    rows = event_measurements(spark, sf_dir).select(*MEASUREMENT_NAMES)
    write_csv(rows, path, header="true", sep=";")
    return path


def stored_silver(typed: DataFrame) -> DataFrame:
    """The silver table, written as by the job, in directories of few columns."""
    path = new_path(typed.sparkSession, "silver")
    write_silver(typed, path, partition_by=BRONZE_PARTITIONS)
    return read_silver(typed.sparkSession, path)


def event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_silver(silver.typed(event_measurements(spark, sf_dir)))


def lineitem_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_silver(silver.typed(lineitem_measurements(spark, sf_dir)))


def both_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, lineitems = event_measurements(spark, sf_dir), lineitem_measurements(spark, sf_dir)
    return silver.typed(events.unionByName(lineitems))


def stored_gold(silver_table: DataFrame) -> dict[str, DataFrame]:
    spark = silver_table.sparkSession
    gold_dir = new_path(spark, "gold")
    jobs.build_gold(silver_table, gold_dir)
    return read_gold(spark, gold_dir)


# --- silver ------------------------------------------------------------------


def silver_typed(spark, sf_dir):
    return silver.typed(event_measurements(spark, sf_dir))


def silver_clean(spark, sf_dir):
    return silver.clean(silver.typed(event_measurements(spark, sf_dir)))


def cleaning_report(spark, sf_dir):
    return silver.cleaning_report(silver.typed(event_measurements(spark, sf_dir)))


def cleaning_report_lineitem(spark, sf_dir):
    return silver.cleaning_report(silver.typed(lineitem_measurements(spark, sf_dir)))


def duplicate_rows(spark, sf_dir):
    return silver.duplicate_rows(event_silver(spark, sf_dir))


def rejected_cells(spark, sf_dir):
    """Every cell that was lost and every row that was dropped, from the one reading of the files."""
    rejected = new_path(spark, "rejects")
    jobs.bronze_to_silver_job(
        spark,
        event_tree(spark, sf_dir),
        new_path(spark, "silver"),
        rejects_path=rejected,
        partition_by=BRONZE_PARTITIONS,
    )
    cells = spark.read.parquet(rejected)
    return cells.withColumn("has_file", F.col("file").endswith(".csv")).drop("file")


def silver_profile(spark, sf_dir):
    return quality.profile_table(event_silver(spark, sf_dir))


# --- gold --------------------------------------------------------------------


def dim_modul(spark, sf_dir):
    return star.dim_modul(event_silver(spark, sf_dir))


def dim_zeit(spark, sf_dir):
    return star.dim_zeit(event_silver(spark, sf_dir))


def dim_messung(spark, sf_dir):
    return star.dim_messung(event_silver(spark, sf_dir))


def join_modul(spark, sf_dir):
    rows = event_table(spark, sf_dir)
    joined = star.join_modul(rows, star.dim_modul(rows))
    return joined.select("modul_Id", "modul", "valuedate", "value")


def join_zeit(spark, sf_dir):
    rows = event_table(spark, sf_dir)
    joined = star.join_zeit(rows, star.dim_zeit(rows))
    return joined.select("zeit_Id", "valuedate", "intervall", "value")


def join_messung(spark, sf_dir):
    rows = event_table(spark, sf_dir)
    joined = star.join_messung(rows, star.dim_messung(rows))
    return joined.select("messung_Id", "messung_einheit", "messung_typ", "value")


def fact_star_join(spark, sf_dir):
    return star.silver_to_gold(event_table(spark, sf_dir))["faktentabelle"]


def fact_star_join_lineitem(spark, sf_dir):
    return star.silver_to_gold(lineitem_table(spark, sf_dir))["faktentabelle"]


def fact_no_fanout(spark, sf_dir):
    """Fact rows per interval equal silver rows per interval, shared times or not."""
    rows = event_table(spark, sf_dir)
    gold = star.silver_to_gold(rows)
    times = gold["dim_zeit"].select(F.col("zeit_Id").alias("FK_zeit_Id"), "intervall")
    facts = (
        gold["faktentabelle"]
        .join(times, "FK_zeit_Id")
        .groupBy("intervall")
        .agg(F.count(F.lit(1)).alias("fact_rows"))
    )
    return rows.groupBy("intervall").agg(F.count(F.lit(1)).alias("silver_rows")).join(
        facts, "intervall"
    )


def gold_verify(spark, sf_dir):
    rows = event_table(spark, sf_dir)
    return quality.verify_gold(stored_gold(rows), rows)


def keys_after_new_members(spark, sf_dir):
    """Members of a first build keep their keys when a second one brings new members."""
    gold_dir = new_path(spark, "gold")
    jobs.build_gold(event_table(spark, sf_dir), gold_dir)
    jobs.build_gold(stored_silver(both_tables(spark, sf_dir)), gold_dir)
    gold = read_gold(spark, gold_dir)
    members = {
        "dim_modul": ("modul_Id", F.col("modul_name")),
        "dim_messung": ("messung_Id", F.col("messung_bezeichnung")),
        "dim_zeit": ("zeit_Id", F.concat_ws(" ", F.col("timestamp").cast("string"), "intervall")),
    }
    named = [
        gold[table].select(
            F.lit(table).alias("table_name"), F.col(key).alias("key"), name.alias("member")
        )
        for table, (key, name) in members.items()
    ]
    return reduce(DataFrame.unionByName, named)


def gold_incremental(spark, sf_dir):
    """Gold of the events, then brought up to date after the rows of lineitem came to silver."""
    path, gold_dir = new_path(spark, "silver"), new_path(spark, "gold")
    for rows in (event_measurements(spark, sf_dir), lineitem_measurements(spark, sf_dir)):
        write_silver(silver.typed(rows), path, mode="append", partition_by=["year", "month"])
        update_gold(spark, path, gold_dir)
    return module_month_report(read_gold(spark, gold_dir))


def silver_of_members(spark, sf_dir):
    """Readings of some modules and months, from the directories that hold them."""
    path = new_path(spark, "silver")
    typed = silver.typed(event_measurements(spark, sf_dir))
    write_silver(typed, path, partition_by=["modul", "year", "month"])
    rows = read_silver(spark, path)
    gold = stored_gold(rows)
    return readings_where(
        rows, gold, modul="modul_name LIKE 'Nutzungsgrad%'", zeit="jahr = 2024 AND monat % 2 = 1"
    )


def gold_preview(table: str) -> Query:
    def first_rows(spark, sf_dir):
        return quality.preview(stored_gold(event_table(spark, sf_dir))[table])

    return first_rows


def gold_table_counts(spark, sf_dir):
    gold = stored_gold(event_table(spark, sf_dir))
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in gold.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def module_month(spark, sf_dir):
    rows = event_table(spark, sf_dir)
    return module_month_report(stored_gold(rows))


def module_month_lineitem(spark, sf_dir):
    rows = lineitem_table(spark, sf_dir)
    return module_month_report(stored_gold(rows))


# --- explore and sensor --------------------------------------------------------


def _dataset(spark, sf_dir):
    return silver.typed_raw(event_measurements(spark, sf_dir))


def explore_groups_1000(spark, sf_dir):
    columns = ["VALUEDATE", "VALUE", "STATE_VAL", "AVG", "TEXT"]
    return explore(_dataset(spark, sf_dir), columns, row_limit=1000)


def explore_count(spark, sf_dir):
    return explore(_dataset(spark, sf_dir), ["MESS_ID"], metrics={"count": "COUNT(*)"})


def explore_all_groups(spark, sf_dir):
    """Every group of many: the counts add up to all rows."""
    return explore(
        _dataset(spark, sf_dir), ["VALUEDATE", "VALUE"], metrics={"count": "COUNT(*)"}
    )


def explore_total(spark, sf_dir):
    return explore(_dataset(spark, sf_dir), metrics={"count": "COUNT(*)"})


def explore_filtered(spark, sf_dir):
    return explore(
        event_silver(spark, sf_dir),
        ["modul", "intervall"],
        metrics={"count": "COUNT(*)", "max_value": F.max("value")},
        filters=["value > 50", F.col("messung_typ") != "Gas"],
        order_by_metric="count",
    )


def explore_day_grain(spark, sf_dir):
    return explore(
        event_silver(spark, sf_dir),
        ["valuedate", "messung_typ"],
        metrics={"count": "COUNT(*)"},
        time_column="valuedate",
        grain="P1D",
    )


def explore_hour_grain(spark, sf_dir):
    return explore(
        event_silver(spark, sf_dir),
        ["valuedate", "messung_typ"],
        metrics={"count": "COUNT(*)", "max_value": F.max("value")},
        time_column="valuedate",
        grain="PT1H",
    )


def explore_week_gaps(spark, sf_dir):
    """Readings of each meter per week, with the weeks in which it had none."""
    weeks = explore(
        event_silver(spark, sf_dir),
        ["mess_id", "valuedate"],
        metrics={"count": "COUNT(*)", "max_value": F.max("value")},
        time_column="valuedate",
        grain="P1W",
    )
    return fill_gaps(weeks, "valuedate", "P1W", within=["mess_id"], empty={"count": 0})


def explore_third_page(spark, sf_dir):
    """The third 500 groups, reached from page to page by the last row of the page before."""
    columns, last = ["VALUEDATE", "VALUE"], None
    rows = _dataset(spark, sf_dir)
    for _ in range(3):
        page = explore(
            rows, columns, metrics={"count": "COUNT(*)"}, row_limit=500, after=last
        )
        found = page.tail(1)
        last = [found[0][name] for name in columns] if found else last
    return page


def explore_from_partials(spark, sf_dir):
    """Coarser groups from stored partial aggregates of all rows."""
    rows, path = event_silver(spark, sf_dir), new_path(spark, "partials")
    by, measures = ["modul", "intervall", "messung_typ", "year", "month"], ["value"]
    write_parquet(partials(rows, by, measures), path)
    metrics = {
        "count": ("count", "*"),
        "sum_value": ("sum", "value"),
        "least": ("min", "value"),
        "largest": ("max", "value"),
        "avg_value": ("avg", "value"),
    }
    stored = Partials(spark.read.parquet(path), by, measures)
    answer = explore_stored(
        rows, [stored], ["messung_typ", "month"], metrics, {"intervall": F.col("intervall") != "15_min"}
    )
    return answer.withColumns(
        {name: F.round(name, 4) for name in ("sum_value", "avg_value")}
    )


def sensor_bucket_avg(spark, sf_dir):
    return bucket_averages(event_sensor(spark, sf_dir))


def sensor_buckets(spark, sf_dir):
    return add_bucket(event_sensor(spark, sf_dir))


def sensor_first_buckets(spark, sf_dir):
    return quality.preview(bucket_averages(event_sensor(spark, sf_dir)), 10)


def sensor_job(spark, sf_dir):
    source = new_path(spark, "sensor")
    write_csv(event_sensor(spark, sf_dir), source, header="true")
    return jobs.sensor_job(
        spark, source, new_path(spark, "csv"), new_path(spark, "parquet"), new_path(spark, "agg")
    )


# --- sources and sinks ---------------------------------------------------------


def csv_tree_roundtrip(spark, sf_dir):
    return silver.typed(read_bronze(spark, event_tree(spark, sf_dir)))


def csv_file_scan(spark, sf_dir):
    return silver.typed_raw(read_measurement_file(spark, event_file(spark, sf_dir)))


def config_read(spark, sf_dir):
    config = {
        "source": {
            "path": event_file(spark, sf_dir),
            "format": "csv",
            "options": {"header": "true", "delimiter": ";", "inferSchema": "false"},
        },
        "schema": {name: "string" for name in MEASUREMENT_NAMES},
    }
    return silver.typed_raw(read_data(spark, config))


def config_write(spark, sf_dir):
    path = new_path(spark, "configured")
    config = {
        "source": {"path": sf_dir, "format": "parquet"},
        "destination": {"path": path, "format": "parquet", "partitionBy": ["year", "month"]},
    }
    write_data(event_silver(spark, sf_dir), config)
    return spark.read.schema(SILVER).parquet(path).select(*SILVER.names)


def parquet_partition_roundtrip(spark, sf_dir):
    path = new_path(spark, "silver")
    write_silver(silver.typed(event_measurements(spark, sf_dir)), path)
    return read_silver(spark, path)


def parquet_partition_lineitem(spark, sf_dir):
    """Silver of the larger table, in directories by module, interval and month."""
    path = new_path(spark, "silver")
    typed = silver.typed(lineitem_measurements(spark, sf_dir))
    write_silver(typed, path, partition_by=MONTHLY)
    return read_silver(spark, path)


def silver_dynamic_overwrite(spark, sf_dir):
    """Only the partitions of the daily interval are replaced, with doubled values."""
    path = new_path(spark, "silver")
    rows = silver.typed(event_measurements(spark, sf_dir))
    write_silver(rows, path)
    daily = rows.filter(F.col("intervall") == "Täglich")
    doubled = daily.withColumn("value", F.col("value") * 2)
    write_silver(doubled, path, partition_overwrite="dynamic")
    return read_silver(spark, path)


def parquet_flat_roundtrip(spark, sf_dir):
    return stored_gold(event_table(spark, sf_dir))["dim_zeit"]


def parquet_readback_count(spark, sf_dir):
    path = new_path(spark, "copy")
    write_parquet(silver.typed(event_measurements(spark, sf_dir)), path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))


def parquet_compact(spark, sf_dir):
    """Many small tasks write few files; how many follows from bytes, not from a number."""
    path = new_path(spark, "compact")
    rows = silver.typed(event_measurements(spark, sf_dir)).repartition(200)
    write_parquet(rows, path, compact=True)
    files = file_inventory(spark, path).filter(F.col("path").endswith(".parquet"))
    advisory = 64 * 1024 * 1024
    few = F.count(F.lit(1)) <= 1 + F.ceil(F.sum("length") / F.lit(advisory)) * 4
    written = files.agg(few.alias("few_files"))
    return (
        spark.read.parquet(path)
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("few_files", F.lit(written.first()[0]))
    )


def _thirds(measurements: DataFrame) -> list[DataFrame]:
    """All rows, as batches by the first, second and last third of a month."""
    third = F.substring("VALUEDATE", 1, 2)
    numbered = measurements.withColumn(
        "_third", F.when(third < "11", 0).when(third < "21", 1).otherwise(2)
    )
    return [numbered.filter(F.col("_third") == n).drop("_third") for n in range(3)]


def _packed_store(spark, measurements: DataFrame) -> tuple[str, DataFrame]:
    """A store that got three batches and was packed, and its units before."""
    store = new_path(spark, "store")
    for rows in _thirds(measurements):
        add_silver(silver.typed(rows), store, partition_by=BRONZE_PARTITIONS)
    units = silver_units(spark, store)
    compact_silver(spark, store)
    return store, units


def silver_packed(spark, sf_dir):
    """Silver of the events in batches, after their small files were packed."""
    store, _ = _packed_store(spark, event_measurements(spark, sf_dir))
    return read_silver_version(spark, store)


def silver_packed_files(spark, sf_dir):
    """Units of each directory of the larger table before and after packing, and its rows."""
    store, before = _packed_store(spark, lineitem_measurements(spark, sf_dir))
    number = F.count(F.lit(1))
    rows = read_silver_version(spark, store).groupBy(*BRONZE_PARTITIONS).agg(number.alias("rows"))
    for units, name in ((before, "units_before"), (silver_units(spark, store), "units_after")):
        counts = units.groupBy(*BRONZE_PARTITIONS).agg(number.alias(name))
        rows = rows.join(counts, [*BRONZE_PARTITIONS])
    return rows


def csv_roundtrip(spark, sf_dir):
    path = new_path(spark, "sensor")
    write_csv(event_sensor(spark, sf_dir), path, header="true")
    return read_header_csv(spark, path)


def file_inventory_query(spark, sf_dir):
    """The bronze tree by listing its files: directories, file types, bytes without headers."""
    files = file_inventory(spark, event_tree(spark, sf_dir)).filter(F.col("length") > 0)
    decoded = F.url_decode(F.regexp_replace("path", r"\+", "%2B"))
    header = len(";".join(MEASUREMENT_NAMES)) + 1
    return files.groupBy(
        F.regexp_extract(decoded, "modul=([^/]+)/", 1).alias("modul"),
        F.regexp_extract(decoded, "intervall=([^/]+)/", 1).alias("intervall"),
        F.regexp_extract("path", r"/part-[^/]*\.(\w+)$", 1).alias("file_type"),
    ).agg((F.sum("length") - header * F.count(F.lit(1))).alias("bytes"))


def load_record(spark, sf_dir):
    records = new_path(spark, "records")
    rows = write_parquet(_dataset(spark, sf_dir), new_path(spark, "testdaten"))
    append_load_record(spark, records, "testdaten", rows)
    return read_load_records(spark, records).select("table_name", "row_count")


def _chain(measurements: DataFrame, **write_options) -> DataFrame:
    """Bronze tree to silver to gold by path, then the report on stored gold."""
    spark = measurements.sparkSession
    root, gold_dir = bronze_tree(measurements), new_path(spark, "gold")
    jobs.run_chain(spark, root, new_path(spark, "silver"), gold_dir, **write_options)
    return module_month_report(read_gold(spark, gold_dir))


def job_chain(spark, sf_dir):
    """Silver in the default directories, one of their columns the meter."""
    return _chain(event_measurements(spark, sf_dir))


def job_chain_monthly(spark, sf_dir):
    return _chain(event_measurements(spark, sf_dir), partition_by=MONTHLY)


def job_chain_lineitem(spark, sf_dir):
    return _chain(lineitem_measurements(spark, sf_dir), partition_by=MONTHLY)


def stream_and_batch(spark, sf_dir):
    """Two intervals come by stream, the third by a batch write into the same table."""
    path = new_path(spark, "silver")
    rows = event_measurements(spark, sf_dir)
    daily = F.col("intervall") == "Täglich"
    stream = start_silver_stream(
        spark, bronze_tree(rows.filter(~daily)), path, new_path(spark, "progress")
    )
    stream.awaitTermination()
    write_silver(silver.typed(rows.filter(daily)), path, partition_overwrite="dynamic")
    return read_silver(spark, path)


def config_options(spark, sf_dir):
    """Valid options of source and destination that belong to no one format."""
    root, path = event_tree(spark, sf_dir), new_path(spark, "configured")
    config = {
        "source": {
            "path": root,
            "format": "csv",
            "options": {"header": "true", "sep": ";", "basePath": root},
        },
        "schema": {name: "string" for name in [*MEASUREMENT_NAMES, *BRONZE_PARTITIONS]},
        "destination": {
            "path": path,
            "format": "parquet",
            "options": {"maxRecordsPerFile": "1000", "parquet.block.size": "1048576"},
        },
    }
    write_data(silver.typed(read_data(spark, config)), config)
    return spark.read.parquet(path)


def landing_stream(spark, sf_dir):
    path = new_path(spark, "silver")
    stream = start_silver_stream(
        spark, event_tree(spark, sf_dir), path, new_path(spark, "progress")
    )
    stream.awaitTermination()
    return read_silver(spark, path)


QUERIES: dict[str, Query] = {
    "silver_typed": silver_typed,
    "silver_clean": silver_clean,
    "silver_partition_cols": event_silver,
    "cleaning_report": cleaning_report,
    "cleaning_report_lineitem": cleaning_report_lineitem,
    "duplicate_rows": duplicate_rows,
    "rejected_cells": rejected_cells,
    "silver_profile": silver_profile,
    "dim_modul": dim_modul,
    "dim_zeit": dim_zeit,
    "dim_messung": dim_messung,
    "join_modul": join_modul,
    "join_zeit": join_zeit,
    "join_messung": join_messung,
    "fact_star_join": fact_star_join,
    "fact_star_join_lineitem": fact_star_join_lineitem,
    "fact_no_fanout": fact_no_fanout,
    "gold_verify": gold_verify,
    "gold_table_counts": gold_table_counts,
    "keys_after_new_members": keys_after_new_members,
    "gold_incremental": gold_incremental,
    "silver_of_members": silver_of_members,
    "gold_preview_dim_modul": gold_preview("dim_modul"),
    "gold_preview_dim_zeit": gold_preview("dim_zeit"),
    "gold_preview_dim_messung": gold_preview("dim_messung"),
    "gold_preview_faktentabelle": gold_preview("faktentabelle"),
    "module_month_report": module_month,
    "module_month_report_lineitem": module_month_lineitem,
    "explore_groups_1000": explore_groups_1000,
    "explore_count": explore_count,
    "explore_all_groups": explore_all_groups,
    "explore_total": explore_total,
    "explore_filtered": explore_filtered,
    "explore_day_grain": explore_day_grain,
    "explore_hour_grain": explore_hour_grain,
    "explore_week_gaps": explore_week_gaps,
    "explore_third_page": explore_third_page,
    "explore_from_partials": explore_from_partials,
    "sensor_bucket_avg": sensor_bucket_avg,
    "sensor_buckets": sensor_buckets,
    "sensor_first_buckets": sensor_first_buckets,
    "sensor_job": sensor_job,
    "csv_tree_roundtrip": csv_tree_roundtrip,
    "csv_file_scan": csv_file_scan,
    "config_read": config_read,
    "config_write": config_write,
    "config_options": config_options,
    "parquet_partition_roundtrip": parquet_partition_roundtrip,
    "parquet_partition_lineitem": parquet_partition_lineitem,
    "silver_dynamic_overwrite": silver_dynamic_overwrite,
    "parquet_flat_roundtrip": parquet_flat_roundtrip,
    "parquet_readback_count": parquet_readback_count,
    "parquet_compact": parquet_compact,
    "silver_packed": silver_packed,
    "silver_packed_files": silver_packed_files,
    "csv_roundtrip": csv_roundtrip,
    "file_inventory": file_inventory_query,
    "load_record": load_record,
    "job_chain": job_chain,
    "job_chain_monthly": job_chain_monthly,
    "job_chain_lineitem": job_chain_lineitem,
    "landing_stream": landing_stream,
    "stream_and_batch": stream_and_batch,
}
