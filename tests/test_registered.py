"""Every registered query against its SQL in DuckDB, on whole tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from checks.compare import duckdb_rows, mismatch
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert QUERIES.keys() <= entry_module.oracle_sql().keys()


def test_queries_without_the_corpus_operators(monkeypatch):
    found = entry_module._found
    corpus = found("meterlake.llm")
    assert ("pipeline" in entry_module.queries()) == (corpus and found("corpus_pipeline"))
    monkeypatch.setattr(entry_module, "_found", lambda name: False)
    assert entry_module.queries().keys() == QUERIES.keys() == entry_module.oracle_sql().keys()


@pytest.mark.parametrize("gone", [["meterlake/llm"], ["meterlake/llm", "corpus_pipeline.py"]])
def test_the_library_without_the_corpus_folders(tmp_path, gone):
    """A copy of the tree without them still loads, with all other queries, and its tests too."""
    root = Path(entry_module.__file__).parent
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".*", "__pycache__", "llm", *gone))
    code = (
        "import __spark_entry__ as e, json, sys; sys.path.insert(0, 'tests'); "
        "import test_registered, test_jobs, test_sinks; "
        "print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"
    )
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True
    )
    assert done.stdout.strip() == str([sorted(QUERIES)] * 2).replace("'", '"')


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    assert mismatch(spark, SF_DIR, name) is None


def test_entry(spark):
    result = entry_module.entry(spark)
    columns, rows = duckdb_rows(SF_DIR, entry_module.oracle_sql()["module_month_report"])
    assert result.columns == columns
    assert result.count() == len(rows) > 0


@pytest.mark.parametrize("name", ["silver_clean", "dim_zeit", "explore_day_grain"])
def test_result_does_not_depend_on_the_session_time_zone(spark, settings, name):
    with settings({"spark.sql.session.timeZone": "Europe/Berlin"}):
        assert mismatch(spark, SF_DIR, name) is None
