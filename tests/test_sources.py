import copy
from pathlib import Path

import pytest
from conftest import measurement, rows_of, write_measurements

from meterlake.operators import silver
from meterlake.schema import MEASUREMENT_NAMES, SILVER
from meterlake.sinks import write_data
from meterlake.sources import (
    file_inventory,
    read_bronze,
    read_data,
    read_header_csv,
    read_measurement_file,
    read_silver,
    s3a_settings,
)
from meterlake.sources.tables import LISTING_TASKS


def test_bronze_cells_and_directory_values_stay_text(spark, bronze_root):
    bronze = read_bronze(spark, bronze_root)
    assert {kind for _, kind in bronze.dtypes} == {"string"}
    assert {row.modul for row in bronze.select("modul").collect()} >= {"007", "Strom_GOM_M1"}
    assert {row.intervall for row in bronze.collect()} == {"15_min", "Monatlich", "Täglich"}
    assert bronze.filter("TEXT is not null").count() == 0


def test_wrong_header_ends_the_read(spark, tmp_path):
    file = write_measurements(tmp_path / "bronze", "M", "15_min", [measurement()])
    file.write_text(file.read_text().replace("ENTRYDATE", "ENTRDATE"))
    with pytest.raises(Exception, match="header does not conform"):
        read_bronze(spark, str(tmp_path / "bronze")).collect()


def test_one_file_with_crlf_and_unquoted_header(spark, tmp_path):
    file = write_measurements(tmp_path, "M", "x", [measurement(), measurement(VALUE="abc")])
    file.write_bytes(file.read_bytes().replace(b"\n", b"\r\n"))
    raw = silver.typed_raw(read_measurement_file(spark, str(file)))
    assert [kind for _, kind in raw.dtypes] == [
        "int", "string", "int", "double", "int", "int", "int", "string", "double", "string",
        "double", "string", "double", "double", "double", "int", "string", "string",
    ]
    assert rows_of(raw, "VALUEDATE", "VALUE", "OFFSET") == [
        ("31.01.2022 23:00:00", 10.5, 1), ("31.01.2022 23:00:00", None, 1)
    ]


def test_header_csv_is_all_text(spark, tmp_path):
    (tmp_path / "s.csv").write_text("timesecs,humidity\n1,2.5\n")
    df = read_header_csv(spark, str(tmp_path))
    assert df.dtypes == [("timesecs", "string"), ("humidity", "string")]


def test_inventory_lists_every_file(spark, bronze_root):
    files = file_inventory(spark, bronze_root)
    assert files.columns == ["path", "length", "modificationTime"]
    assert files.count() == 4 and files.filter("length = 0").count() == 0


@pytest.fixture
def config(tmp_path):
    file = write_measurements(tmp_path / "in", "M", "x", [measurement(), measurement()])
    return {
        "source": {
            "path": str(file),
            "format": "csv",
            "options": {"header": "true", "delimiter": ";"},
        },
        "destination": {
            "path": str(tmp_path / "out"), "format": "parquet", "partitionBy": ["year", "month"]
        },
        "schema": {name: "string" for name in MEASUREMENT_NAMES},
    }


def test_config_read_and_write(spark, config):
    df = read_data(spark, config)
    assert df.columns == MEASUREMENT_NAMES and {kind for _, kind in df.dtypes} == {"string"}
    assert rows_of(df, "VALUE") == [("10.5",), ("10.5",)]
    dated = df.selectExpr("VALUE", "2022 as year", "1 as month")
    write_data(dated, config)
    write_data(dated, config)
    out = config["destination"]["path"]
    assert spark.read.parquet(f"{out}/year=2022/month=1").count() == 2


def test_config_without_schema_reads_text(spark, config):
    del config["schema"]
    assert {kind for _, kind in read_data(spark, config).dtypes} == {"string"}
    config["source"]["options"]["inferSchema"] = "true"
    assert dict(read_data(spark, config).dtypes)["VALUE"] == "double"


def test_config_faults_are_errors(spark, config):
    misspelt_option = copy.deepcopy(config)
    misspelt_option["source"]["options"] = {"header": "true", "delimeter": ";"}
    with pytest.raises(ValueError, match="did you mean 'delimiter'"):
        read_data(spark, misspelt_option)

    misspelt_column = copy.deepcopy(config)
    misspelt_column["schema"] = {
        ("ENTRDATE" if name == "ENTRYDATE" else name): "string" for name in MEASUREMENT_NAMES
    }
    with pytest.raises(Exception, match="header does not conform"):
        read_data(spark, misspelt_column).collect()

    overwrites_source = copy.deepcopy(config)
    overwrites_source["destination"]["path"] = config["source"]["path"]
    with pytest.raises(ValueError, match="overlap"):
        read_data(spark, overwrites_source)
    overwrites_source["destination"]["path"] = config["source"]["path"] + "/inside"
    with pytest.raises(ValueError, match="overlap"):
        read_data(spark, overwrites_source)


def test_config_passes_options_of_the_source_itself(spark, config):
    folder = str(Path(config["source"]["path"]).parent)
    config["source"]["options"] |= {"basePath": folder, "timeZone": "UTC"}
    config["destination"]["options"] = {
        "maxRecordsPerFile": "1", "partitionOverwriteMode": "dynamic",
        "parquet.block.size": "1048576", "some.vendor.option": "x",
    }
    dated = read_data(spark, config).selectExpr("VALUE", "2022 as year", "1 as month")
    write_data(dated, config)
    out = config["destination"]["path"]
    assert spark.read.parquet(out).count() == 2
    assert len(spark.read.parquet(out).inputFiles()) == 2


def test_object_store_settings():
    settings = s3a_settings("http://store:9000", "key", "secret")
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    with pytest.raises(ValueError):
        s3a_settings("http://store:9000", "", "secret")


def test_silver_names_are_unique():
    assert len(set(SILVER.names)) == len(SILVER.names) == 23


def test_silver_is_listed_by_cores_not_by_directories(spark, tmp_path):
    row = spark.createDataFrame([(1, 2.5)], "comp_level int, value double").coalesce(1)
    row.write.parquet(str(tmp_path / "one"))
    (file,) = (tmp_path / "one").glob("*.parquet")
    table = tmp_path / "silver"
    for n in range(120):
        folder = table / f"modul=M{n}"
        folder.mkdir(parents=True)
        (folder / file.name).write_bytes(file.read_bytes())
    spark.sparkContext.setJobGroup("listing", "")
    before = spark.conf.get(LISTING_TASKS)
    try:
        rows = read_silver(spark, str(table))
        tracker = spark.sparkContext.statusTracker()
        jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup("listing")]
        stages = [tracker.getStageInfo(stage) for job in jobs for stage in job.stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get(LISTING_TASKS) == before
    assert 0 < sum(stage.numTasks for stage in stages) <= spark.sparkContext.defaultParallelism
    found = rows.select("modul", "comp_level", "value").collect()
    assert sorted(map(tuple, found)) == sorted((f"M{n}", 1, 2.5) for n in range(120))
