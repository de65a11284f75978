"""Versions of silver: batches, packed files, readers of the version before."""

import re
from pathlib import Path

import pytest
from conftest import measurement, plan_of, rows_of, write_measurements
from pyspark.sql import functions as F

from meterlake.operators.silver import typed
from meterlake.plans import compaction
from meterlake.plans.compaction import (
    add_silver,
    compact_silver,
    crowded_units,
    read_silver_version,
    silver_units,
)
from meterlake.schema import SILVER
from meterlake.sinks import write_silver
from meterlake.sources import read_bronze, read_silver

COLUMNS = ["modul", "year", "month"]
MODULES = ["Strom_GOM_M1", "a,b=c/ü %", "007"]


def batch(spark, tmp_path, number, rows=1, modules=MODULES):
    root = tmp_path / f"bronze-{number}"
    for modul in modules:
        cells = [
            measurement(MESS_ID=str(180_000 + number * 1000 + i), VALUE="7") for i in range(rows)
        ]
        folder = re.sub("[%=/]", lambda found: f"%{ord(found[0]):02X}", modul)
        write_measurements(root, folder, "15_min", cells)
    return typed(read_bronze(spark, str(root)))


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "store")
    for number in range(3):
        add_silver(batch(spark, tmp_path, number), path, partition_by=COLUMNS)
    return path


def files_on_disk(store):
    return {str(path) for path in Path(store).rglob("part-*.parquet") if "readings" in str(path)}


def test_batches_make_one_table(spark, store, tmp_path):
    plain = str(tmp_path / "plain")
    for number in range(3):
        rows = batch(spark, tmp_path, number)
        write_silver(rows, plain, mode="append", partition_by=COLUMNS)
    found = read_silver_version(spark, store)
    assert found.columns == SILVER.names
    assert rows_of(found) == rows_of(read_silver(spark, plain))
    assert set(MODULES) == {row[0] for row in found.select("modul").distinct().collect()}
    units = silver_units(spark, store)
    assert units.count() == 9 and units.agg(F.sum("files")).first()[0] == 9


def test_packing_keeps_rows_and_halves_files(spark, store):
    before = rows_of(read_silver_version(spark, store))
    done = compact_silver(spark, store)
    assert done == {"directories": 3, "files_before": 9, "files_after": 3, "rows": 9}
    assert rows_of(read_silver_version(spark, store)) == before
    assert silver_units(spark, store).count() == 3
    assert compact_silver(spark, store)["directories"] == 0


def test_readers_of_the_version_before_go_on(spark, store, tmp_path):
    old = read_silver_version(spark, store)
    before, small = rows_of(old), files_on_disk(store)
    compact_silver(spark, store)
    assert small < files_on_disk(store)
    assert rows_of(old) == before  # its files are still there
    add_silver(batch(spark, tmp_path, 3), store, partition_by=COLUMNS)
    assert not small & files_on_disk(store)  # two versions later they are gone
    assert len(rows_of(read_silver_version(spark, store))) == 12


def test_large_files_stay_and_large_directories_are_cut(spark, tmp_path):
    store = str(tmp_path / "store")
    add_silver(batch(spark, tmp_path, 0, 900, MODULES[:1]), store, partition_by=COLUMNS)
    size = silver_units(spark, store).first()["bytes"]
    for number in range(1, 9):
        add_silver(batch(spark, tmp_path, number, 900, MODULES[:1]), store, partition_by=COLUMNS)
    before = rows_of(read_silver_version(spark, store))
    assert compact_silver(spark, store, target_bytes=size)["directories"] == 0  # all large enough
    done = compact_silver(spark, store, target_bytes=3 * size)
    assert done["files_before"] == 9 and 2 <= done["files_after"] <= 3
    assert rows_of(read_silver_version(spark, store)) == before
    # a small batch more is not worth rewriting them
    add_silver(batch(spark, tmp_path, 9, 1, MODULES[:1]), store, partition_by=COLUMNS)
    assert compact_silver(spark, store, target_bytes=size)["directories"] == 0


def test_only_crowded_units_are_packed(spark):
    units = spark.createDataFrame(
        [("b1", "m", 4, 40), ("b2", "m", 4, 40), ("b3", "m", 1, 900), ("b1", "n", 1, 10),
         ("b1", "o", 2, 90), ("b2", "o", 1, 45)],
        "home string, modul string, files long, bytes long",
    )
    assert rows_of(crowded_units(units, 100), "home", "modul", "pieces") == [
        ("b1", "m", 1), ("b2", "m", 1)
    ]
    assert crowded_units(units.limit(0), 100).count() == 0


def test_a_build_published_meanwhile_is_not_undone(spark, store, tmp_path, monkeypatch):
    write = compaction._publish_units

    def late(spark, path, units, before):
        monkeypatch.setattr(compaction, "_publish_units", write)
        add_silver(batch(spark, tmp_path, 5), store, partition_by=COLUMNS)
        write(spark, path, units, before)

    monkeypatch.setattr(compaction, "_publish_units", late)
    with pytest.raises(RuntimeError, match="published meanwhile"):
        compact_silver(spark, store)
    assert len(rows_of(read_silver_version(spark, store))) == 12
    homes = {row[0] for row in silver_units(spark, store).select("home").distinct().collect()}
    assert {path.name for path in Path(store, "readings").iterdir()} == {f"home={h}" for h in homes}
    assert len(list(Path(store).glob("version-*"))) == 2


def test_a_failed_packing_changes_nothing(spark, store, monkeypatch):
    files, before = files_on_disk(store), rows_of(read_silver_version(spark, store))

    def fail(*_):
        raise OSError("disk")

    monkeypatch.setattr(compaction, "_listed", fail)
    with pytest.raises(OSError, match="disk"):
        compact_silver(spark, store)
    assert files_on_disk(store) == files
    assert rows_of(read_silver_version(spark, store)) == before


def test_empty_batches_missing_stores_and_other_columns(spark, store, tmp_path):
    before = rows_of(read_silver_version(spark, store))
    add_silver(batch(spark, tmp_path, 0).limit(0), store, partition_by=COLUMNS)
    assert rows_of(read_silver_version(spark, store)) == before
    with pytest.raises(ValueError, match="directories are"):
        add_silver(batch(spark, tmp_path, 0), store, partition_by=["modul"])
    with pytest.raises(ValueError, match="needs directory columns"):
        add_silver(batch(spark, tmp_path, 0), store, partition_by=[])
    empty = str(tmp_path / "empty")
    for reader in (read_silver_version, compact_silver):
        with pytest.raises(FileNotFoundError):
            reader(spark, empty)
    add_silver(batch(spark, tmp_path, 0).limit(0), empty, partition_by=COLUMNS)
    assert read_silver_version(spark, empty).count() == 0
    assert compact_silver(spark, empty)["directories"] == 0


def test_null_directories(spark, tmp_path):
    store = str(tmp_path / "store")
    for number in range(2):
        rows = batch(spark, tmp_path, number).withColumn(
            "modul", F.when(F.col("modul") != "007", F.col("modul"))
        )
        add_silver(rows, store, partition_by=COLUMNS)
    before = rows_of(read_silver_version(spark, store))
    assert len(before) == 6 and sum(row[0] is None for row in before) == 2
    assert compact_silver(spark, store)["files_after"] == 3
    assert rows_of(read_silver_version(spark, store)) == before


def test_directories_are_pruned_while_the_query_runs(spark, store, settings):
    with settings({"spark.sql.maxMetadataStringLength": "5000"}):
        plan = plan_of(read_silver_version(spark, store).filter("modul = '007'"))
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    filters = scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "dynamicpruning" in filters and "007" in filters
