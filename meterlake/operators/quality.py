"""Checks and views of stored tables."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.schema import FACT_MEASURES, GOLD
from meterlake.sources.tables import (
    gold_path,
    gold_version,
    read_gold_table,
    version_sources,
)
from meterlake.staging import stage

# Table -> (surrogate key, natural key); fact column -> (table, key).
DIMENSION_KEYS = {
    "dim_modul": ("modul_Id", ["modul_name"]),
    "dim_zeit": ("zeit_Id", ["timestamp", "intervall"]),
    "dim_messung": ("messung_Id", ["messung_bezeichnung"]),
}
FOREIGN_KEYS = {
    "FK_zeit_Id": ("dim_zeit", "zeit_Id"),
    "FK_modul_Id": ("dim_modul", "modul_Id"),
    "FK_messung_Id": ("dim_messung", "messung_Id"),
}

#: What a fact row belongs to: names of members, and the silver columns they come from.
_NAMES = [name for _, natural_key in DIMENSION_KEYS.values() for name in natural_key]
SILVER_NAMES = ["modul", "valuedate", "intervall", "messung_typ"]


def _check(name: str, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(name).alias("check_name"), "expected", "found")


def _unique(table: DataFrame, columns: list[str]) -> DataFrame:
    per_key = table.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("expected"),
        F.count(F.lit(1)).alias("found"),
    )


def _per_key(fact: DataFrame) -> DataFrame:
    """The one pass over the fact: rows and a mark of their values per combination of keys."""
    return fact.groupBy(*FOREIGN_KEYS).agg(*_rows_and_mark())


def _rows_and_mark() -> list[Column]:
    # the mark does not depend on the order of rows; with their number it tells values apart
    return [F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*FACT_MEASURES)).alias("mark")]


def _orphans(per_key: DataFrame, fk: str, dimension: DataFrame, key: str) -> DataFrame:
    rows = per_key.select(F.col(fk).alias(key), "rows")
    return rows.join(dimension.select(key), key, "left_anti").agg(
        F.lit(0).cast("bigint").alias("expected"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("found"),
    )


def _facts_by_name(per_key: DataFrame, gold: dict[str, DataFrame]) -> DataFrame:
    named = per_key
    for fk, (table, key) in FOREIGN_KEYS.items():
        names = DIMENSION_KEYS[table][1]
        named = named.join(gold[table].select(F.col(key).alias(fk), *names), fk)
    return named.select(*_NAMES, "rows", "mark")


def _members(per_key: DataFrame, gold: dict[str, DataFrame], silver: DataFrame) -> list[DataFrame]:
    """Silver rows, and how many of them the fact has under the same names with equal values."""
    columns = dict(zip(_NAMES, SILVER_NAMES))
    rows = silver.groupBy(*[F.col(own).alias(name) for name, own in columns.items()])
    counted = stage(rows.agg(*_rows_and_mark()), "silver_members")
    both = counted.withColumn("fact_rows", F.lit(0).cast("bigint"))
    facts = _facts_by_name(per_key, gold).select(
        *_NAMES, F.lit(0).cast("bigint").alias("rows"), "mark", F.col("rows").alias("fact_rows")
    )
    groups = (
        both.unionByName(facts)
        .groupBy(*_NAMES)
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("fact_rows").alias("fact_rows"),
            F.bit_xor("mark").alias("difference"),
        )
    )
    equal = (F.col("rows") == F.col("fact_rows")) & (F.col("difference") == 0)
    compared = groups.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("expected"),
        F.coalesce(F.sum(F.when(equal, F.col("rows"))), F.lit(0)).alias("found"),
    )
    total = per_key.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    sent = compared.select("expected", F.lit(0).alias("found")).unionByName(
        total.select(F.lit(0).alias("expected"), F.col("rows").alias("found"))
    )
    sent = sent.agg(F.sum("expected").alias("expected"), F.sum("found").alias("found"))
    return [_check("faktentabelle rows", sent), _check("faktentabelle members", compared)]


def verify_gold(gold: dict[str, DataFrame], silver: DataFrame) -> DataFrame:
    """One row per check: ``check_name``, ``expected``, ``found``, ``passed``.

    The fact is read once, silver once. Facts are joined back to the names of their members
    and compared with silver, so a key that points at the wrong member is found although
    all keys exist.
    """
    per_key = stage(_per_key(gold["faktentabelle"]), "verify")
    checks = _members(per_key, gold, silver)
    for table, (key, natural_key) in DIMENSION_KEYS.items():
        checks.append(_check(f"{table} key", _unique(gold[table], [key])))
        checks.append(_check(f"{table} natural key", _unique(gold[table], natural_key)))
    for fk, (table, key) in FOREIGN_KEYS.items():
        checks.append(_check(f"{fk} orphans", _orphans(per_key, fk, gold[table], key)))
    return reduce(DataFrame.unionByName, checks).withColumn(
        "passed", F.col("expected") == F.col("found")
    )


def describe_table(df: DataFrame) -> DataFrame:
    """The schema as rows."""
    fields = [
        (position, field.name, field.dataType.simpleString(), field.nullable)
        for position, field in enumerate(df.schema)
    ]
    return df.sparkSession.createDataFrame(
        fields, "position int, column_name string, data_type string, nullable boolean"
    )


def profile_table(df: DataFrame) -> DataFrame:
    """``describe_table`` with the rows of the table and the nulls of each column, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(name).alias(name) for name in df.columns]
    )
    nulls = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(name)).alias("null_rows"),
        )
        for name in df.columns
    ]
    per_column = counts.select(F.explode(F.array(*nulls)).alias("_of")).select("_of.*")
    return describe_table(df).join(per_column, "column_name")


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows in the order of all columns, so that it can be repeated."""
    return df.orderBy(*df.columns).limit(rows)


class TableView(NamedTuple):
    schema: DataFrame
    preview: DataFrame


def inspect_gold(
    spark: SparkSession, gold_dir: str, rows: int = 10
) -> tuple[dict[str, TableView], list[str]]:
    """Schema and first rows of each gold table, and the names of missing ones."""
    views, missing = {}, []
    folder = gold_version(spark, gold_dir)
    sliced = version_sources(spark, folder) is not None
    for table in GOLD:
        try:
            if sliced and table == "faktentabelle":
                df = read_gold_table(spark, folder, table)
            else:
                df = spark.read.parquet(gold_path(folder, table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(table)
        else:
            views[table] = TableView(describe_table(df), preview(df, rows))
    return views, missing
