from datetime import datetime
from pathlib import Path

import pytest
from conftest import measurement, plan_of, rows_of, write_measurements
from pyspark.sql import functions as F

from meterlake.operators import silver
from meterlake.schema import SILVER
from meterlake.sinks import balance, files, write_silver
from meterlake.sources import read_bronze, read_silver

COUNTS = {
    "rows_in": 20, "null_key_rows": 7, "invalid_value_rows": 5, "rows_out": 8, "nan_rows": 1
}


def test_silver_types_and_order(spark, bronze_root):
    result = silver.bronze_to_silver(read_bronze(spark, bronze_root)).select(*SILVER.names)
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in SILVER
    ]


def test_clean_keeps_the_good_rows(spark, bronze_root):
    result = silver.bronze_to_silver(read_bronze(spark, bronze_root))
    kept = rows_of(result, "modul", "mess_id", "valuedate", "year", "month", "messung_typ")
    january = datetime(2022, 1, 31, 23)
    assert kept == sorted(
        [
            ("007", 180001, january, 2022, 1, "007"),
            ("Nutzungsgrad_GOM_M3_el", 17, january, 2022, 1, "Nutzungsgrad"),
            ("Nutzungsgrad_GOM_M3_el", 180001, january, 2022, 1, "Nutzungsgrad"),
            ("Strom_GOM_M1", 180001, datetime(2022, 3, 27, 2, 30), 2022, 3, "Strom"),
            ("Waermeabsatz_GOM_M", 180001, january, 2022, 1, "Waermeabsatz"),
            ("Waermeabsatz_GOM_M", 180001, january, 2022, 1, "Waermeabsatz"),
            ("Waermeabsatz_GOM_M", 180001, datetime(2022, 12, 31, 23), 2022, 12, "Waermeabsatz"),
            ("Waermeabsatz_GOM_M", 180002, january, 2022, 1, "Waermeabsatz"),
        ],
        key=repr,
    )


def test_report_and_duplicates(spark, bronze_root):
    typed = silver.typed(read_bronze(spark, bronze_root))
    assert silver.cleaning_report(typed).first().asDict() == COUNTS
    # the repeated (180001, 31.01.2022 23:00) of three modules
    assert silver.duplicate_rows(silver.clean(typed)).first()[0] == 3


def test_empty_input(spark, bronze_root):
    typed = silver.typed(read_bronze(spark, bronze_root).filter("modul = 'none'"))
    assert set(silver.cleaning_report(typed).first()) == {0}
    assert silver.duplicate_rows(silver.clean(typed)).first()[0] == 0


@pytest.mark.parametrize("options", [{}, {"rebalance": False}, {"partitions": 3}])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_write_reports_what_it_wrote(spark, settings, bronze_root, tmp_path, adaptive, options):
    typed = silver.typed(read_bronze(spark, bronze_root))
    path = str(tmp_path / "silver")
    with settings({"spark.sql.adaptive.enabled": adaptive}):
        assert write_silver(typed, path, **options) == COUNTS
        expected = silver.bronze_to_silver(read_bronze(spark, bronze_root))
        assert rows_of(read_silver(spark, path)) == rows_of(expected, *SILVER.names)
    assert (tmp_path / "silver/modul=007/intervall=15_min/mess_id=180001/year=2022/month=1").is_dir()


def test_fewer_directory_columns(spark, bronze_root, tmp_path):
    path = str(tmp_path / "silver")
    typed = silver.typed(read_bronze(spark, bronze_root))
    assert write_silver(typed, path, partition_by=["modul", "year"]) == COUNTS
    assert (tmp_path / "silver/modul=007/year=2022").is_dir()
    expected = silver.bronze_to_silver(read_bronze(spark, bronze_root))
    assert rows_of(read_silver(spark, path)) == rows_of(expected, *SILVER.names)


def test_static_and_dynamic_overwrite(spark, bronze_root, tmp_path):
    path = str(tmp_path / "silver")
    typed = silver.typed(read_bronze(spark, bronze_root))
    write_silver(typed, path)
    changed = typed.filter("modul = '007'").withColumn("value", F.lit(99.0))
    write_silver(changed, path, partition_overwrite="dynamic")
    values = dict(read_silver(spark, path).groupBy("modul").agg(F.max("value")).collect())
    assert values["007"] == 99.0 and len(values) == 4
    write_silver(changed, path)
    assert {row.modul for row in read_silver(spark, path).collect()} == {"007"}


def test_hot_partition_is_written_by_several_tasks(spark, settings, tmp_path):
    """One module, meter and month holds nearly all rows."""
    root = tmp_path / "bronze"
    rows = [
        measurement(VALUE=str(i), PVALUE=str(i * 7.77), VALUEDATE=f"{i % 28 + 1:02}.01.2022 00:00:00")
        for i in range(1, 20_001)
    ]
    for part in range(4):
        write_measurements(root, "Hot_M", "15_min", rows[part::4], name=f"{part}.csv")
    write_measurements(root, "Cold_M", "15_min", rows[:50])
    typed = silver.typed(read_bronze(spark, str(root)))
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.files.maxPartitionBytes": "256KB",
        "spark.sql.files.openCostInBytes": "1KB",
    }
    for adaptive in ("true", "false"):
        path = tmp_path / f"silver-{adaptive}"
        with settings({**small, "spark.sql.adaptive.enabled": adaptive}):
            counts = write_silver(typed, str(path), rebalance=adaptive == "true")
        hot = list(Path(path / "modul=Hot_M").rglob("*.parquet"))
        assert counts["rows_out"] == 20_050
        assert len(hot) > 2
        if adaptive == "true":
            assert len(list(Path(path / "modul=Cold_M").rglob("*.parquet"))) == 1


def test_tasks_follow_the_directories(spark, monkeypatch, tmp_path):
    """Few bytes in many directories are written by many tasks, each directory by one."""
    root = tmp_path / "bronze"
    rows = [measurement(MESS_ID=str(meter)) for meter in range(1, 241) for _ in range(2)]
    write_measurements(root, "M", "15_min", rows)
    tasks = []

    def recorded(*args, **options):
        dealt = balance.spread(*args, **options)
        tasks.append(dealt.rdd.getNumPartitions())
        return dealt

    monkeypatch.setattr(files, "spread", recorded)
    monkeypatch.setattr(balance, "DIRECTORIES_PER_TASK", 20)
    path = tmp_path / "silver"
    write_silver(silver.typed(read_bronze(spark, str(root))), str(path), partition_by=["mess_id"])
    assert tasks == [12]
    written = [len(list(folder.glob("*.parquet"))) for folder in path.glob("mess_id=*")]
    assert written == [1] * 240
    assert len({file.name.split("-")[1] for file in path.rglob("*.parquet")}) > 8


def test_equal_rows_of_a_hot_directory_part(spark, tmp_path):
    """A directory is cut by the place of rows, so even copies of one row go to several tasks."""
    rows = spark.range(4000).select(
        F.when(F.col("id") < 3000, None).otherwise(F.col("id") % 50).alias("name"),
        F.lit(1.5).alias("value"),
    )
    folder = str(tmp_path / "stored")
    rows.write.parquet(folder)
    dealt = balance.spread(spark.read.parquet(folder), ["name"], balance.advisory_bytes(spark) * 8)
    per_task = dealt.withColumn("task", F.spark_partition_id()).groupBy("name", "task").count()
    hot = [row["count"] for row in per_task.collect() if row["name"] is None]
    assert sum(hot) == 3000 and len(hot) > 2 and max(hot) < 2000
    assert per_task.filter("name is not null").count() == 50
    assert dealt.groupBy().sum("value").first()[0] == 6000


def _rows_per_task(spark, monkeypatch, tmp_path, rows, columns):
    monkeypatch.setattr(balance, "ROWS_PER_TASK", 1_000)
    folder = str(tmp_path / "stored")
    rows.write.parquet(folder)
    dealt = balance.spread(spark.read.parquet(folder), columns, 1)
    found = dealt.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).collect()
    return [row[1] for row in found]


def test_rows_that_take_few_bytes_are_cut_too(spark, monkeypatch, tmp_path):
    """One directory of many rows that are small once encoded is not one task's."""
    rows = spark.range(20_000).select(F.lit(2024).alias("year"), "id")
    sizes = _rows_per_task(spark, monkeypatch, tmp_path, rows, ["year"])
    assert sum(sizes) == 20_000 and len(sizes) >= 20 and max(sizes) < 1_500


def test_large_directories_do_not_meet_by_chance(spark, monkeypatch, tmp_path):
    """Twelve directories of a task's rows each: by their hash some task would get several."""
    rows = spark.range(12_000).select((F.col("id") % 12).alias("modul"), "id")
    sizes = _rows_per_task(spark, monkeypatch, tmp_path, rows, ["modul"])
    assert sum(sizes) == 12_000 and max(sizes) <= 2_000


def test_only_needed_columns_and_directories_are_read(spark, bronze_root, tmp_path):
    bronze = silver.bronze_to_silver(read_bronze(spark, bronze_root))
    plan = plan_of(bronze.filter("modul = '007'").select("value"))
    assert "PartitionFilters: [isnotnull(modul" in plan
    assert "ENTRYDATE" not in plan and "MINDATE" not in plan
    path = str(tmp_path / "silver")
    write_silver(silver.typed(read_bronze(spark, bronze_root)), path)
    stored = read_silver(spark, path).filter("modul = '007' and value > 1").select("value")
    plan = plan_of(stored)
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,1.0)]" in plan
    assert "ReadSchema: struct<value:double>" in plan
    assert [row.value for row in stored.collect()] == [3.0]
