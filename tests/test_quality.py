from pathlib import Path

import pytest
from conftest import plan_of, rows_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterlake.operators import quality
from meterlake.plans import jobs
from meterlake.sources import read_gold, read_silver


@pytest.fixture
def built(spark, bronze_root, tmp_path):
    silver_path, gold_dir = str(tmp_path / "silver"), str(tmp_path / "gold")
    jobs.run_chain(spark, bronze_root, silver_path, gold_dir)
    return read_gold(spark, gold_dir), read_silver(spark, silver_path), gold_dir


def failed(gold, rows):
    return {r.check_name for r in quality.verify_gold(gold, rows).collect() if not r.passed}


def test_a_good_build_passes(built):
    gold, rows, _ = built
    checks = quality.verify_gold(gold, rows).collect()
    assert len(checks) == 11 and all(check.passed for check in checks)


def test_faults_are_found(built):
    gold, rows, _ = built
    fact = gold["faktentabelle"]
    members = "faktentabelle members"
    assert failed({**gold, "faktentabelle": fact.limit(3)}, rows) == {"faktentabelle rows", members}
    orphaned = fact.withColumn("FK_zeit_Id", F.col("FK_zeit_Id") + 1000)
    assert failed({**gold, "faktentabelle": orphaned}, rows) == {"FK_zeit_Id orphans", members}
    without_key = fact.withColumn("FK_modul_Id", F.lit(None).cast("bigint"))
    assert failed({**gold, "faktentabelle": without_key}, rows) == {"FK_modul_Id orphans", members}
    doubled = gold["dim_modul"].union(gold["dim_modul"])
    assert failed({**gold, "dim_modul": doubled}, rows) == {
        "dim_modul key", "dim_modul natural key", members
    }
    same_key = gold["dim_messung"].withColumn("messung_Id", F.lit(0).cast("bigint"))
    assert "dim_messung key" in failed({**gold, "dim_messung": same_key}, rows)


def test_keys_that_point_at_the_wrong_member_are_found(built):
    gold, rows, _ = built
    last = gold["dim_modul"].count() - 1
    permuted = gold["dim_modul"].withColumn("modul_Id", last - F.col("modul_Id"))
    assert failed({**gold, "dim_modul": permuted}, rows) == {"faktentabelle members"}
    changed = gold["faktentabelle"].withColumn("max", F.col("max") + 1)
    assert failed({**gold, "faktentabelle": changed}, rows) == {"faktentabelle members"}


def test_the_fact_is_read_once(built):
    gold, rows, gold_dir = built
    before = plan_of(quality._per_key(gold["faktentabelle"]))
    assert before.count("Scan parquet") == 1
    plan = plan_of(quality.verify_gold(gold, rows))
    assert "FK_zeit_Id" in plan and f"{gold_version_name(gold_dir)}/faktentabelle" not in plan


def gold_version_name(gold_dir):
    return max(Path(gold_dir).glob("CURRENT-*")).read_text()


def test_inspect_shows_tables_and_names_missing_ones(spark, built, tmp_path):
    _, _, gold_dir = built
    views, missing = quality.inspect_gold(spark, gold_dir, rows=2)
    assert list(views) == ["dim_modul", "dim_zeit", "dim_messung", "faktentabelle"]
    assert missing == []
    assert rows_of(views["dim_modul"].preview) == [(0, "007"), (1, "Nutzungsgrad_GOM_M3_el")]
    assert rows_of(views["dim_messung"].schema, "position", "column_name", "data_type") == [
        (0, "messung_bezeichnung", "string"),
        (1, "messung_Id", "bigint"),
        (2, "messung_einheit", "string"),
    ]
    views, missing = quality.inspect_gold(spark, str(tmp_path / "nowhere"))
    assert views == {} and len(missing) == 4


def test_other_errors_are_not_hidden(spark, tmp_path):
    (tmp_path / "dim_modul").mkdir()
    with pytest.raises(AnalysisException):
        quality.inspect_gold(spark, str(tmp_path))
