import warnings
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from meterlake import staging
from meterlake.plans import jobs
from meterlake.sinks import (
    append_load_record,
    database,
    read_load_records,
    to_pandas,
    write_csv,
    write_parquet,
)


def test_results_to_pandas(spark):
    meters = spark.createDataFrame([(180_001 + i, i / 4) for i in range(9)], "mess_id int, value double")
    first = to_pandas(meters.orderBy("mess_id"), 2)
    assert first["mess_id"].tolist() == [180_001, 180_002] and first["value"].sum() == 0.25
    assert rows_of(spark.createDataFrame(to_pandas(meters, 20))) == rows_of(
        meters.selectExpr("cast(mess_id as bigint) as mess_id", "value")
    )


def test_parquet_and_csv(spark, tmp_path):
    df = spark.range(1000).withColumn("text", F.col("id").cast("string"))
    path = str(tmp_path / "p")
    assert write_parquet(df.repartition(4), path, compact=True) == 1000
    assert rows_of(spark.read.parquet(path)) == rows_of(df)
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 1
    write_csv(df, str(tmp_path / "c"), header="true", sep=";")
    write_csv(df, str(tmp_path / "c"), header="true", sep=";")
    assert spark.read.csv(str(tmp_path / "c"), header=True, sep=";").count() == 1000


def test_load_records_are_appended(spark, tmp_path):
    path = str(tmp_path / "records")
    append_load_record(spark, path, "testdaten", 9)
    append_load_record(spark, path, "testdaten", 12)
    records = read_load_records(spark, path)
    assert rows_of(records, "table_name", "row_count") == [("testdaten", 12), ("testdaten", 9)]
    assert records.filter("loaded_at is null").count() == 0


def test_staging_folder(spark, settings):
    path = staging.new_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert path != staging.new_path(spark, "x")


def test_staging_is_below_the_warehouse_where_no_folder_is_set():
    class Session:
        conf = {"spark.sql.warehouse.dir": "file:/lake/warehouse/"}

    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert staging.shared_folder(Session()) == "file:/lake/warehouse/_staging"
    Session.conf = {**Session.conf, "spark.master": "yarn"}
    with pytest.warns(UserWarning, match="all executors share"):
        staging.shared_folder(Session())
    assert staging.shared_folder(Session()) == "file:/lake/warehouse/_staging"
    Session.conf = {**Session.conf, "spark.checkpoint.dir": "hdfs://n/shared/"}
    assert staging.shared_folder(Session()) == "hdfs://n/shared"


def test_a_job_takes_its_staged_tables_along(spark):
    with staging.job_folder(spark) as folder:
        table = staging.stage(spark.range(5), "numbers")
        assert folder in table.inputFiles()[0] and table.count() == 5
        place = table.inputFiles()[0].removeprefix("file://")
        assert Path(place).exists()
    assert not Path(place).exists()
    assert folder not in staging.new_path(spark, "later")


class Recorder:
    """Stands in for a DataFrameWriter; no database is started in tests."""

    def __init__(self, df, calls):
        self.df, self.calls, self.given = df, calls, {}

    def format(self, name):
        self.given["format"] = name
        return self

    def options(self, **options):
        self.given.update(options)
        return self

    def option(self, key, value):
        self.given[key] = value
        return self

    def mode(self, mode):
        self.given["mode"] = mode
        return self

    def save(self):
        self.calls[self.given["dbtable"]] = {**self.given, "rows": self.df.count()}


@pytest.fixture
def database_calls(spark, monkeypatch):
    calls = {}
    frame = type(spark.range(1))
    write = frame.write

    def writer(df):
        # files are written as usual; only the database module gets the recorder
        return Recorder(df, calls)

    def export(df, *args, **kwargs):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(frame, "write", property(writer))
            return original(df, *args, **kwargs)

    original = database.export_table
    monkeypatch.setattr(database, "export_table", export)
    monkeypatch.setattr(
        database, "count_table", lambda spark, url, table, properties=None: calls[table]["rows"]
    )
    assert frame.write is write
    return calls


def test_gold_export(spark, bronze_root, tmp_path, database_calls):
    done = jobs.run_chain(
        spark,
        bronze_root,
        str(tmp_path / "silver"),
        str(tmp_path / "gold"),
        jdbc_url="jdbc:postgresql://host/db",
        jdbc_properties={"user": "u", "password": "p"},
    )
    assert list(database_calls) == [
        "public.dim_modul", "public.dim_zeit", "public.dim_messung", "public.faktentabelle"
    ]
    assert done["database"] == done["gold"]
    assert database_calls["public.faktentabelle"] == {
        "format": "jdbc", "url": "jdbc:postgresql://host/db", "user": "u", "password": "p",
        "dbtable": "public.faktentabelle", "numPartitions": 8, "batchsize": 10_000,
        "truncate": False, "mode": "overwrite", "rows": 8,
    }


def test_file_load_leaves_a_record(spark, bronze_root, tmp_path, database_calls):
    records = str(tmp_path / "records")
    source = f"{bronze_root}/modul=007/intervall=15_min"
    assert jobs.load_measurement_file(spark, source, "jdbc:x", records) == 1
    assert rows_of(read_load_records(spark, records), "table_name", "row_count") == [
        ("testdaten", 1)
    ]


def test_rows_are_counted_in_the_database(spark, monkeypatch):
    given = {}

    class Reader:
        def format(self, name):
            given["format"] = name
            return self

        def options(self, **options):
            given.update(options)
            return self

        def option(self, key, value):
            given[key] = value
            return self

        def load(self):
            return answer

    answer = spark.sql("select cast(5 as decimal(20, 0)) as row_count")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark), "read", property(lambda session: Reader()))
        assert database.count_table(spark, "jdbc:x", "public.t", {"user": "u"}) == 5
    assert given == {
        "format": "jdbc", "url": "jdbc:x", "user": "u",
        "query": "SELECT COUNT(*) AS row_count FROM public.t",
    }


def test_lost_or_doubled_rows_are_an_error(spark, database_calls, monkeypatch):
    monkeypatch.setattr(database, "count_table", lambda *args: 4)
    with pytest.raises(RuntimeError, match="3 rows sent, 4 rows found"):
        database.export_checked(spark.range(3), "jdbc:x", "t")
