import shutil

import pytest
from conftest import measurement, rows_of, write_measurements
from pyspark.sql import functions as F

from checks import queries
from meterlake import staging
from meterlake.operators import silver
from meterlake.operators.quality import verify_gold
from meterlake.plans import jobs
from meterlake.schema import SILVER, SILVER_PARTITIONS
from meterlake.sources import read_bronze, read_gold, read_silver
from meterlake.sinks import write_silver
from meterlake.streaming import start_silver_stream
from meterlake.streaming.landing import append_once


def test_chain_twice_gives_equal_tables(spark, bronze_root, tmp_path):
    silver_path, gold_dir = str(tmp_path / "silver"), str(tmp_path / "gold")
    first = jobs.run_chain(spark, bronze_root, silver_path, gold_dir)
    tables = {name: rows_of(df) for name, df in read_gold(spark, gold_dir).items()}
    assert first["silver"]["rows_out"] == 8
    assert first["gold"] == {name: len(rows) for name, rows in tables.items()}
    assert jobs.run_chain(spark, bronze_root, silver_path, gold_dir) == first
    assert {name: rows_of(df) for name, df in read_gold(spark, gold_dir).items()} == tables


def test_a_failed_build_leaves_the_tables_before(spark, bronze_root, tmp_path, monkeypatch):
    silver_path, gold_dir = str(tmp_path / "silver"), str(tmp_path / "gold")
    jobs.run_chain(spark, bronze_root, silver_path, gold_dir)
    tables = {name: rows_of(df) for name, df in read_gold(spark, gold_dir).items()}
    write_measurements(tmp_path / "bronze", "AAA_M", "15_min", [measurement()], name="new.csv")
    write = jobs.write_parquet

    def failing(df, path, **options):
        if "faktentabelle" in path:
            raise OSError("no space")
        return write(df, path, **options)

    monkeypatch.setattr(jobs, "write_parquet", failing)
    with pytest.raises(OSError, match="no space"):
        jobs.run_chain(spark, bronze_root, silver_path, gold_dir)
    assert {name: rows_of(df) for name, df in read_gold(spark, gold_dir).items()} == tables
    monkeypatch.undo()

    def wrong(*tables):
        fact = faktentabelle(*tables)
        return fact.withColumn("FK_modul_Id", (F.col("FK_modul_Id") + 1) % 5)

    faktentabelle = jobs.star.faktentabelle
    monkeypatch.setattr(jobs.star, "faktentabelle", wrong)
    with pytest.raises(RuntimeError, match="members"):
        jobs.run_chain(spark, bronze_root, silver_path, gold_dir)
    assert {name: rows_of(df) for name, df in read_gold(spark, gold_dir).items()} == tables
    monkeypatch.undo()
    jobs.run_chain(spark, bronze_root, silver_path, gold_dir)
    jobs.run_chain(spark, bronze_root, silver_path, gold_dir)
    assert read_gold(spark, gold_dir)["dim_modul"].count() == len(tables["dim_modul"]) + 1
    assert len(list((tmp_path / "gold").glob("version-*"))) == 2


def test_jobs_leave_no_staged_tables(spark, bronze_root, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr(staging, "shared_folder", lambda spark: str(shared))
    jobs.run_chain(spark, bronze_root, str(tmp_path / "silver"), str(tmp_path / "gold"))
    assert not [path for path in shared.rglob("*") if path.is_file()]
    assert not list(shared.glob("meterlake-*"))


def test_a_failing_stage_stops_the_chain(spark, bronze_root, tmp_path):
    file = write_measurements(tmp_path / "bronze", "Bad_M", "15_min", [measurement()])
    file.write_text(file.read_text().replace("MESS_ID", "METER"))
    with pytest.raises(Exception, match="header does not conform"):
        jobs.run_chain(spark, bronze_root, str(tmp_path / "silver"), str(tmp_path / "gold"))
    assert not (tmp_path / "gold").exists()


def test_no_good_row_gives_empty_tables(spark, tmp_path):
    write_measurements(tmp_path / "bronze", "M", "15_min", [measurement(MESS_ID="x")])
    gold_dir = str(tmp_path / "gold")
    done = jobs.run_chain(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), gold_dir)
    assert done["silver"]["rows_in"] == done["silver"]["null_key_rows"] == 1
    assert set(done["gold"].values()) == {0}
    assert [df.count() for df in read_gold(spark, gold_dir).values()] == [0, 0, 0, 0]


def test_no_job_overwrites_its_input(spark, bronze_root, tmp_path):
    with pytest.raises(ValueError, match="overlap"):
        jobs.bronze_to_silver_job(spark, bronze_root, bronze_root + "/silver")
    with pytest.raises(ValueError, match="overlap"):
        jobs.run_chain(spark, bronze_root, str(tmp_path / "x"), str(tmp_path / "x/"))


def test_sensor_job(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/s.csv").write_text(
        "timesecs,humidity,temperature,flowrate\n0,1,2,3\n30,2,3,4\n60,9,9,9\n"
    )
    paths = [str(tmp_path / name) for name in ("raw", "csv", "parquet", "agg")]
    result = jobs.sensor_job(spark, *paths)
    assert rows_of(result) == [(1, 1.5, 2.5, 3.5), (2, 9.0, 9.0, 9.0)]
    assert spark.read.csv(paths[1]).count() == 3


def test_stream_equals_batch_and_takes_each_file_once(spark, bronze_root, tmp_path):
    landing = tmp_path / "landing"
    shutil.copytree(bronze_root, landing)
    path, checkpoint = str(tmp_path / "silver"), str(tmp_path / "progress")

    def run():
        start_silver_stream(
            spark, str(landing), path, checkpoint, max_files_per_trigger=2
        ).awaitTermination()
        return rows_of(read_silver(spark, path))

    def batch():
        bronze = read_bronze(spark, str(landing))
        return rows_of(silver.bronze_to_silver(bronze), *SILVER.names)

    assert run() == batch()
    assert not (tmp_path / "silver/_spark_metadata").exists()
    write_measurements(landing, "Strom_GOM_M1", "15_min", [measurement()], name="later.csv")
    assert run() == batch()
    assert run() == batch()


def test_a_batch_that_is_tried_again_lands_once(spark, bronze_root, tmp_path):
    typed = silver.typed(read_bronze(spark, bronze_root))
    path, waiting = str(tmp_path / "silver"), tmp_path / "waiting"
    columns = ["modul", "intervall"]
    write_silver(typed, str(waiting), partition_by=columns)
    files = sorted(waiting.rglob("part-*"))
    assert len(files) > 2
    target = tmp_path / "silver" / files[0].relative_to(waiting)
    target.parent.mkdir(parents=True)
    files[0].rename(target)  # an earlier try got this far
    for _ in range(2):
        append_once(typed, path, str(waiting), columns)
        assert read_silver(spark, path).count() == 8
    append_once(typed, path, str(tmp_path / "next"), columns)
    assert read_silver(spark, path).count() == 16


def test_new_directories_are_moved_whole(spark, tmp_path):
    """What the driver does for a batch follows from the directories that the table has, not from files."""
    rows = "modul string, intervall string, mess_id int, comp_level int, valuedate timestamp_ntz, value double, pvalue double"
    typed = spark.createDataFrame([], rows)
    for name in SILVER.names:
        if name not in typed.columns and name not in ("year", "month"):
            typed = typed.withColumn(name, F.lit(None).cast(SILVER[name].dataType))
    some = spark.range(60).select(
        F.lit("M").alias("modul"),
        F.when(F.col("id") % 2 == 0, "15_min").otherwise("Monatlich").alias("intervall"),
        F.col("id").cast("int").alias("mess_id"),
        F.lit(1).alias("comp_level"),
        F.lit("2022-01-02 03:04:05").cast("timestamp_ntz").alias("valuedate"),
        *[F.lit(1.0).alias(name) for name in ("value", "pvalue")],
    )
    typed = typed.unionByName(some, allowMissingColumns=True)
    path, first, second = (str(tmp_path / name) for name in ("silver", "first", "second"))
    half = typed.filter("mess_id < 30")
    append_once(half, path, first, SILVER_PARTITIONS)
    assert not list((tmp_path / "first").glob("modul=*"))  # one renaming, nothing left behind
    append_once(typed, path, second, SILVER_PARTITIONS)
    assert len(list((tmp_path / "second").rglob("mess_id=*"))) == 30  # those the table had
    assert not list((tmp_path / "second").rglob("part-*"))
    table = read_silver(spark, path)
    assert table.count() == 90
    assert table.groupBy("mess_id").count().filter("count = 1").count() == 30


def test_stream_and_batch_share_a_table(spark, bronze_root, tmp_path):
    path = str(tmp_path / "silver")
    start_silver_stream(spark, bronze_root, path, str(tmp_path / "p")).awaitTermination()
    more = silver.typed(read_bronze(spark, bronze_root)).filter("modul = '007'")
    write_silver(more.withColumn("modul", F.lit("other")), path, mode="append")
    assert read_silver(spark, path).count() == 9
    write_silver(more.withColumn("value", F.lit(1.0)), path, partition_overwrite="dynamic")
    rows = read_silver(spark, path)
    assert rows.count() == 9 and rows.filter("modul = '007'").first().value == 1.0


@pytest.mark.parametrize(
    "name, columns", [("job_chain", SILVER_PARTITIONS), ("job_chain_monthly", queries.MONTHLY)]
)
def test_chain_queries_write_the_default_and_the_monthly_directories(
    spark, monkeypatch, name, columns
):
    files = []

    def recorded(typed, path, **options):
        counts = write_silver(typed, path, **options)
        files.extend(spark.read.parquet(path).inputFiles())
        return counts

    monkeypatch.setattr(jobs, "write_silver", recorded)
    queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    parts = {tuple(p.split("=")[0] for p in f.split("/") if "=" in p) for f in files}
    assert parts == {tuple(columns)}


@pytest.mark.parametrize("name", ["module_month_report", "parquet_flat_roundtrip"])
def test_queries_on_stored_gold_verify_it(spark, monkeypatch, name):
    verified = []

    def recorded(gold, silver_table):
        verified.append(gold.keys())
        return verify_gold(gold, silver_table)

    monkeypatch.setattr(jobs, "verify_gold", recorded)
    queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(verified) == 1


def test_many_small_files_are_opened_once_for_gold(spark, bronze_root, tmp_path, monkeypatch):
    typed = silver.typed(read_bronze(spark, bronze_root))
    write_silver(typed, str(tmp_path / "silver"))
    rows = read_silver(spark, str(tmp_path / "silver"))
    direct = jobs.read_once(rows)
    assert set(direct.inputFiles()) == set(rows.inputFiles())
    monkeypatch.setattr(jobs, "MANY_FILES", 2)
    stored = jobs.read_once(rows)
    assert not set(stored.inputFiles()) & set(rows.inputFiles())
    assert rows_of(stored) == rows_of(direct)
    assert jobs.build_gold(rows, str(tmp_path / "gold"))["faktentabelle"] == 8
    checks = verify_gold(read_gold(spark, str(tmp_path / "gold")), rows)
    assert not set(checks.inputFiles()) & set(rows.inputFiles())  # silver was counted once, before
    assert all(check.passed for check in checks.collect())
