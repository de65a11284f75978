"""Rejected cells beside the silver table, from one reading of the files."""

from conftest import measurement, plan_of, rows_of, write_measurements

from meterlake.operators.quarantine import rejects, typed_with_faults
from meterlake.operators.silver import typed
from meterlake.plans import jobs
from meterlake.sources import read_bronze, read_silver


def test_every_lost_cell_is_named(spark, bronze_root):
    rows = typed_with_faults(read_bronze(spark, bronze_root, with_file=True))
    cells = rows_of(rejects(rows), "column_name", "raw", "reason", "row_dropped")
    bad_dates = ["kaputt", "29.02.2022 10:00:00", "1.2.2022 5:00:00"]
    of_dates = [
        (column, date, "unreadable", True)
        for date in bad_dates
        for column in ("VALUEDATE", "ENTRYDATE", "MINDATE", "MAXDATE")
    ]
    expected = of_dates + [
        ("COMP_LEVEL", None, "missing", True),
        ("MESS_ID", None, "missing", True),
        ("MESS_ID", "9999999999", "unreadable", True),
        ("MESS_ID", "x17", "unreadable", True),
        ("PVALUE", "0", "not_positive", True),
        ("VALUE", None, "missing", True),
        ("VALUE", "-1", "not_positive", True),
        ("VALUE", "-1", "not_positive", True),
        ("VALUE", "0", "not_positive", True),
        ("VALUE", "abc", "unreadable", True),
    ]
    assert cells == sorted(expected, key=repr)
    assert rows_of(rows.drop("_file", "_faults")) == rows_of(typed(read_bronze(spark, bronze_root)))
    assert plan_of(rejects(rows)).count("FileScan") == 1


def test_a_lost_cell_need_not_drop_the_row(spark, tmp_path):
    root = tmp_path / "bronze"
    write_measurements(root, "M", "15_min", [measurement(MIN="?"), measurement(TEXT="any text")])
    silver_path, rejected = str(tmp_path / "silver"), str(tmp_path / "rejects")
    for _ in range(2):
        done = jobs.run_chain(
            spark, str(root), silver_path, str(tmp_path / "gold"), rejects_path=rejected
        )
        cells = spark.read.parquet(rejected)
        assert rows_of(cells, "column_name", "raw", "row_dropped") == [("MIN", "?", False)]
    assert done["silver"]["rows_out"] == 2 and read_silver(spark, silver_path).count() == 2
    assert cells.first().file.endswith("/modul=M/intervall=15_min/a.csv")
    assert rows_of(cells, "modul", "intervall") == [("M", "15_min")]
