"""Gold that follows silver: keys stay, only changed slices are read and written."""

import pytest
from conftest import measurement, rows_of, write_measurements
from pyspark.sql import functions as F

from meterlake.operators.keys import stable_key
from meterlake.operators.quality import inspect_gold, verify_gold
from meterlake.operators.silver import typed
from meterlake.plans import incremental, jobs
from meterlake.plans.incremental import changed_rows, silver_files, update_gold
from meterlake.sinks import balance, write_silver
from meterlake.sources import read_bronze, read_gold, read_silver

COLUMNS = ["modul", "year", "month"]


def by_name(gold):
    """Facts under the names of their members."""
    fact = gold["faktentabelle"]
    for table, fk, key in (
        ("dim_modul", "FK_modul_Id", "modul_Id"),
        ("dim_zeit", "FK_zeit_Id", "zeit_Id"),
        ("dim_messung", "FK_messung_Id", "messung_Id"),
    ):
        fact = fact.join(gold[table].withColumnRenamed(key, fk), fk)
    return rows_of(fact.drop("FK_modul_Id", "FK_zeit_Id", "FK_messung_Id"))


@pytest.fixture
def tables(spark, bronze_root, tmp_path):
    path, gold_dir = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_silver(typed(read_bronze(spark, bronze_root)), path, partition_by=COLUMNS)
    return path, gold_dir


def add(spark, tmp_path, path, modul, date, **options):
    root = tmp_path / f"more-{modul}-{date[:10]}"
    write_measurements(root, modul, "15_min", [measurement(VALUEDATE=date, VALUE="7")])
    write_silver(typed(read_bronze(spark, str(root))), path, partition_by=COLUMNS, **options)


def check(spark, path, gold_dir, tmp_path):
    gold, silver = read_gold(spark, gold_dir), read_silver(spark, path)
    full = str(tmp_path / "full")
    jobs.build_gold(silver, full)
    assert by_name(gold) == by_name(read_gold(spark, full))
    assert all(row.passed for row in verify_gold(gold, silver).collect())


def test_facts_of_one_slice_are_written_by_tasks_of_few_rows(spark, tmp_path, monkeypatch):
    """Facts take so few bytes that bytes alone would leave a month of any size to one task."""
    monkeypatch.setattr(balance, "ROWS_PER_TASK", 200)
    path, gold_dir = str(tmp_path / "silver"), str(tmp_path / "gold")
    rows = [measurement(MESS_ID=str(i % 7), VALUE=str(1 + i % 5)) for i in range(2000)]
    write_measurements(tmp_path / "bronze", "M", "15_min", rows)
    write_silver(typed(read_bronze(spark, str(tmp_path / "bronze"))), path, partition_by=COLUMNS)
    written = update_gold(spark, path, gold_dir)
    facts = list((tmp_path / "gold" / "facts").rglob("*.parquet"))
    held = [spark.read.parquet(str(file)).count() for file in facts]
    assert written["slices"] == 1 and sum(held) == written["faktentabelle"] == 2000
    assert len(held) >= 8 and max(held) < 400
    check(spark, path, gold_dir, tmp_path)


def test_updates_equal_full_builds(spark, tables, tmp_path):
    path, gold_dir = tables
    first = update_gold(spark, path, gold_dir)
    assert first["slices"] == 3 and first["faktentabelle"] == 8
    check(spark, path, gold_dir, tmp_path)
    keys = rows_of(read_gold(spark, gold_dir)["dim_modul"])
    facts = rows_of(read_gold(spark, gold_dir)["faktentabelle"])
    assert update_gold(spark, path, gold_dir)["slices"] == 0

    add(spark, tmp_path, path, "AAA_New", "05.06.2023 10:00:00", mode="append")
    now = silver_files(spark, path, ["year", "month"])
    assert now.filter("slice = '2023,6'").count() == 1
    done = update_gold(spark, path, gold_dir)
    assert done["slices"] == 1 and done["faktentabelle"] == 1
    check(spark, path, gold_dir, tmp_path)
    gold = read_gold(spark, gold_dir)
    assert set(keys) < set(rows_of(gold["dim_modul"]))
    assert set(facts) < set(rows_of(gold["faktentabelle"]))
    homes = list((tmp_path / "gold/facts").glob("home=*"))
    assert len(homes) == 2
    views, missing = inspect_gold(spark, gold_dir)
    assert not missing and views["faktentabelle"].preview.count() == 9

    for file in (tmp_path / "silver").rglob("*.parquet"):
        if "year=2023" not in str(file):
            file.write_bytes(b"cannot be read")
    rows = changed_rows(read_silver(spark, path), ["year", "month"], ["2023,6"])
    assert rows_of(rows, "modul", "value") == [("AAA_New", 7.0)]


def test_changed_and_vanished_directories(spark, tables, tmp_path):
    path, gold_dir = tables
    update_gold(spark, path, gold_dir)
    # the daily module's only month is written anew with other values
    add(spark, tmp_path, path, "Waermeabsatz_GOM_M", "01.12.2022 10:00:00",
        partition_overwrite="dynamic")
    assert update_gold(spark, path, gold_dir)["slices"] == 1
    check(spark, path, gold_dir, tmp_path)
    add(spark, tmp_path, path, "Only_M", "01.02.2020 10:00:00")  # replaces the whole table
    done = update_gold(spark, path, gold_dir)
    assert done["slices"] == 4 and done["faktentabelle"] == 1
    gold = read_gold(spark, gold_dir)
    assert gold["faktentabelle"].count() == 1
    assert gold["dim_modul"].count() == 5  # members that are gone keep their keys
    check(spark, path, gold_dir, tmp_path)
    update_gold(spark, path, gold_dir)
    assert len(list((tmp_path / "gold").glob("version-*"))) == 2


def test_a_failed_update_changes_nothing(spark, tables, tmp_path, monkeypatch):
    path, gold_dir = tables
    update_gold(spark, path, gold_dir)
    before = {name: rows_of(df) for name, df in read_gold(spark, gold_dir).items()}
    add(spark, tmp_path, path, "AAA_New", "05.06.2023 10:00:00", mode="append")
    fact = incremental.star.faktentabelle

    def wrong(*tables, **options):
        return fact(*tables, **options).withColumn("FK_modul_Id", F.lit(0).cast("long"))

    monkeypatch.setattr(incremental.star, "faktentabelle", wrong)
    with pytest.raises(RuntimeError, match="members"):
        update_gold(spark, path, gold_dir)
    assert {name: rows_of(df) for name, df in read_gold(spark, gold_dir).items()} == before
    assert len(list((tmp_path / "gold/facts").glob("home=*"))) == 1
    monkeypatch.undo()
    assert update_gold(spark, path, gold_dir)["slices"] == 1


def test_stable_keys(spark):
    known = spark.createDataFrame([(0, "b"), (1, None), (7, "gone")], "key long, name string")
    members = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "name string")
    got = rows_of(stable_key(members, ["name"], "key", known))
    assert got == [(0, "b"), (1, None), (7, "gone"), (8, "a"), (9, "c")]
    empty = known.limit(0)
    assert rows_of(stable_key(members, ["name"], "key", empty)) == [
        (0, None), (1, "a"), (2, "b"), (3, "c")
    ]


def test_keys_of_a_full_build_stay_unless_asked(spark, tables, tmp_path):
    path, gold_dir = tables
    jobs.build_gold(read_silver(spark, path), gold_dir)
    first = rows_of(read_gold(spark, gold_dir)["dim_modul"])
    add(spark, tmp_path, path, "AAA_New", "05.06.2023 10:00:00", mode="append")
    jobs.build_gold(read_silver(spark, path), gold_dir)
    assert rows_of(read_gold(spark, gold_dir)["dim_modul"]) == [*first, (4, "AAA_New")]
    jobs.build_gold(read_silver(spark, path), gold_dir, keep_keys=False)
    assert (0, "007") in first and (1, "AAA_New") in rows_of(read_gold(spark, gold_dir)["dim_modul"])
    assert not list((tmp_path / "gold").glob("_pointer*"))
