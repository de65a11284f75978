"""Silver on a disk without Hadoop's native library, where tasks write the files themselves."""

from __future__ import annotations

import stat
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import measurement, plan_of, rows_of, write_measurements
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meterlake.operators import silver
from meterlake.schema import SILVER
from meterlake.sinks import disk, files, write_silver
from meterlake.sources import read_bronze, read_silver, tables

NAMES = "modul string, value double, id int"
COLUMNS = ["modul"]


@pytest.fixture(autouse=True)
def native_library_is_missing(spark, tmp_path):
    if disk.disk_folder(spark, str(tmp_path)) is None:
        pytest.skip("Spark's writer starts no processes here")


def write(rows, path, columns=COLUMNS, overwrite=True, dynamic=False, most=0):
    disk.write_directories(
        rows, str(path), columns, overwrite=overwrite, dynamic=dynamic, max_records_per_file=most
    )


def layout(path):
    """Directories and modes of files, without the parts of their names that are by chance."""
    return sorted(
        (str(file.parent.relative_to(path)), file.name[:6], file.suffix, stat.S_IMODE(file.stat().st_mode))
        for file in Path(path).rglob("*")
        if file.is_file()
    )


def test_no_process_is_started_for_a_directory(spark, bronze_root, tmp_path, monkeypatch):
    """Spark's writer, which starts five for each, is not asked to write directories."""
    asked = []
    writer = type(spark.range(1).write)
    original = writer.partitionBy
    monkeypatch.setattr(
        writer, "partitionBy", lambda self, *columns: asked.append(columns) or original(self, *columns)
    )
    typed = silver.typed(read_bronze(spark, bronze_root))
    write_silver(typed, str(tmp_path / "ours"))
    assert not asked
    monkeypatch.setattr(files, "disk_folder", lambda *args: None)
    write_silver(typed, str(tmp_path / "sparks"))
    assert asked
    ours, sparks = (read_silver(spark, str(tmp_path / name)) for name in ("ours", "sparks"))
    assert rows_of(ours) == rows_of(sparks) and ours.count() == 8
    assert set(layout(tmp_path / "ours")) == set(layout(tmp_path / "sparks"))
    for name in ("ours", "sparks"):
        for folder in (tmp_path / name).rglob("*=*"):
            assert stat.S_IMODE(folder.stat().st_mode) == 0o755


def test_schema_and_types_are_those_of_spark(spark, bronze_root, tmp_path, monkeypatch):
    typed = silver.typed(read_bronze(spark, bronze_root))
    write_silver(typed, str(tmp_path / "ours"))
    monkeypatch.setattr(files, "disk_folder", lambda *args: None)
    write_silver(typed, str(tmp_path / "sparks"))
    ours, sparks = (spark.read.parquet(str(tmp_path / name)) for name in ("ours", "sparks"))
    assert ours.schema == sparks.schema
    columns = sorted(ours.columns)
    assert rows_of(ours, *columns) == rows_of(sparks, *columns)


def test_names_of_directories(spark, tmp_path, monkeypatch):
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for start in range(1, 0xD800, 4096):
        text = "".join(map(chr, range(start, min(start + 4096, 0xD800))))
        assert disk._escaped(text) == escape(text)
    values = ["", None, "a/b", "ä=%25", "x:y*z", " ", "{[^", "Täglich", ".", "..", "__HIVE_DEFAULT_PARTITION__"]
    rows = spark.createDataFrame([(v, float(i), i) for i, v in enumerate(values)], NAMES)
    write(rows, tmp_path / "ours")
    rows.write.partitionBy("modul").parquet(str(tmp_path / "sparks"))
    folders = [{f.name for f in (tmp_path / n).glob("modul=*")} for n in ("ours", "sparks")]
    assert folders[0] == folders[1]
    ours, sparks = (spark.read.schema(NAMES).parquet(str(tmp_path / n)) for n in ("ours", "sparks"))
    assert rows_of(ours) == rows_of(sparks)


def test_what_is_replaced(spark, tmp_path):
    first = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 2)], NAMES)
    second = spark.createDataFrame([("b", 3.0, 3), ("c", 4.0, 4)], NAMES)

    def found(path):
        return [row[2] for row in rows_of(spark.read.schema(NAMES).parquet(str(path)), "id", "modul", "id")]

    for name, options, ids in (
        ("added", {"overwrite": False}, [1, 2, 3, 4]),
        ("static", {}, [3, 4]),
        ("dynamic", {"dynamic": True}, [1, 3, 4]),
    ):
        path = tmp_path / name
        write(first, path)
        write(second, path, **options)
        assert found(path) == ids
        assert sorted(p.name for p in path.iterdir() if "=" not in p.name) == ["._SUCCESS.crc", "_SUCCESS"]
    # rows of one directory from several tasks replace what was there, not each other
    many = spark.range(40).selectExpr("'b' as modul", "1.0 as value", "cast(id as int) as id").repartition(4)
    write(many, tmp_path / "dynamic", dynamic=True)
    assert sorted(found(tmp_path / "dynamic")) == sorted([1, 4, *range(40)])
    write(second.limit(0), tmp_path / "static")
    assert found(tmp_path / "static") == [] and (tmp_path / "static/_SUCCESS").exists()


def test_a_failed_job_leaves_no_rows(spark, tmp_path):
    rows = spark.range(100).selectExpr(
        "'a' as modul", "1.0 as value", "if(id = 99, raise_error('lost'), cast(id as int)) as id"
    )
    write(spark.createDataFrame([("a", 1.0, 1)], NAMES), tmp_path / "t")
    with pytest.raises(PySparkException, match="lost"):
        write(rows, tmp_path / "t", overwrite=False)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    assert not list((tmp_path / "t").glob("_waiting*"))


def test_only_the_attempt_that_spark_took_is_moved(spark, tmp_path):
    """What a lost attempt wrote is left behind, and moving twice does no harm."""
    rows = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 2)], NAMES).coalesce(1)
    taken = disk._move
    path = tmp_path / "t"

    def twice(target, batches):
        batches = list(batches)
        for lost in list(Path(target.waiting).iterdir()):
            other = lost.with_name(lost.name + "9")
            other.mkdir(exist_ok=True)
            for file in lost.iterdir():
                (other / file.name.replace("part-", "part-9")).write_bytes(file.read_bytes())
        yield from taken(target, batches)
        yield from taken(target, batches)

    disk._move = twice
    try:
        write(rows, path)
    finally:
        disk._move = taken
    assert rows_of(spark.read.parquet(str(path)), *rows.columns) == rows_of(rows)
    assert len(list(path.rglob("part-*.parquet"))) == 2


def test_checksums_are_compared_when_read(spark, tmp_path):
    rows = spark.range(2000).selectExpr("'a' as modul", "rand(1) as value", "cast(id as int) as id").coalesce(1)
    write(rows, tmp_path / "t")
    (file,) = (tmp_path / "t").rglob("*.parquet")
    assert file.with_name(f".{file.name}.crc").exists() and file.stat().st_size > 512
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.sum("id")).first()[0] == 1999 * 1000
    damaged = bytearray(file.read_bytes())
    damaged[1000] ^= 1
    file.write_bytes(bytes(damaged))
    with pytest.raises(Exception, match="(?i)checksum"):
        spark.read.parquet(str(tmp_path / "t")).agg(F.sum("value")).first()


def test_nan_is_found_by_filters(spark, tmp_path, monkeypatch):
    """For Spark NaN is larger than any number; statistics without it would hide it."""
    rows = spark.createDataFrame([("a", float("nan"), 1), ("a", 2.0, 2), ("b", 3.0, 3)], NAMES)
    for name, held in (("small", 250_000), ("pieces", 1)):
        monkeypatch.setattr(disk, "ROWS_HELD", held)
        write(rows.coalesce(1), tmp_path / name)
        stored = spark.read.parquet(str(tmp_path / name))
        assert [r.id for r in stored.filter("value > 100").collect()] == [1]
    write(rows.filter("id > 1").coalesce(1), tmp_path / "numbers")
    (file,) = (tmp_path / "numbers/modul=b").glob("*.parquet")
    assert pq.read_metadata(file).row_group(0).column(0).statistics.max == 3.0


def test_rows_per_file_and_long_directories(spark, settings, tmp_path):
    rows = spark.range(105).selectExpr("'a' as modul", "1.5 as value", "cast(id as int) as id").coalesce(1)
    with settings({"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
        write(rows, tmp_path / "t", most=10)
        write(rows, tmp_path / "whole")
    sizes = [pq.read_metadata(f).num_rows for f in (tmp_path / "t").rglob("*.parquet")]
    assert sorted(sizes) == [5] + [10] * 10
    assert [pq.read_metadata(f).num_rows for f in (tmp_path / "whole").rglob("*.parquet")] == [105]
    assert rows_of(spark.read.parquet(str(tmp_path / "t")), *rows.columns) == rows_of(rows)


def test_large_tables_are_read_in_several_scans(spark, tmp_path, monkeypatch):
    root = tmp_path / "bronze"
    for modul in range(6):
        meters = [measurement(MESS_ID=str(180_000 + n), VALUE=str(n + 1)) for n in range(5)]
        write_measurements(root, f"M{modul}", "15_min", meters)
    path = str(tmp_path / "silver")
    write_silver(silver.typed(read_bronze(spark, str(root))), path)
    whole = read_silver(spark, path)
    monkeypatch.setattr(tables, "DIRECTORIES_PER_SCAN", 10)
    parts = read_silver(spark, path)
    assert plan_of(whole).count("FileScan") == 1 and plan_of(parts).count("FileScan") == 3
    assert parts.schema == whole.schema == SILVER and parts.count() == 30
    assert rows_of(parts) == rows_of(whole)
    one = parts.filter("modul = 'M1' and mess_id = 180002")
    assert [row.value for row in one.collect()] == [3.0]
    filters = [line for line in plan_of(one).splitlines() if "FileScan" in line]
    assert filters and all("PartitionFilters: [isnotnull(" in line for line in filters)
    # rows beside the directories are never left out
    stray = next(Path(path).rglob("part-*.parquet"))
    (Path(path) / stray.name).write_bytes(stray.read_bytes())
    assert tables._groups(spark, path) == [[path]]
    assert tables._groups(spark, str(tmp_path / "none")) == [[str(tmp_path / "none")]]
