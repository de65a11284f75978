"""Bronze text to typed, cleaned silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions import measurement_type, parse_as
from meterlake.schema import BRONZE_PARTITIONS, MEASUREMENT_COLUMNS, SILVER_KEYS

KEPT = "kept"
NULL_KEY = "null_key"
INVALID_VALUE = "invalid_value"

#: Names of the cleaning counts, in report order.
CLEANING_COUNTS = ["rows_in", "null_key_rows", "invalid_value_rows", "rows_out", "nan_rows"]


def typed_columns() -> list[Column]:
    return [
        *map(F.col, BRONZE_PARTITIONS),
        *[parse_as(F.col(raw), kind).alias(name) for raw, name, kind in MEASUREMENT_COLUMNS],
        measurement_type(F.col("modul")).alias("messung_typ"),
    ]


def typed(bronze: DataFrame) -> DataFrame:
    """Rename to lower case, parse every column, add ``messung_typ``."""
    return bronze.select(*typed_columns())


def typed_raw(raw: DataFrame) -> DataFrame:
    """One measurement file under its own column names: numbers parsed, dates as text."""
    return raw.select(
        *[
            (parse_as(F.col(name), kind) if kind in ("int", "double") else F.col(name)).alias(name)
            for name, _, kind in MEASUREMENT_COLUMNS
        ]
    )


def keys_present() -> Column:
    present = [F.col(key).isNotNull() for key in SILVER_KEYS]
    return present[0] & present[1] & present[2]


def measures_positive() -> Column:
    """True only for two positive measures; NaN counts as positive in Spark."""
    return (F.col("value") > 0) & (F.col("pvalue") > 0)


def clean(rows: DataFrame) -> DataFrame:
    return rows.filter(keys_present() & measures_positive())


def add_partition_columns(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"year": F.year("valuedate"), "month": F.month("valuedate")})


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    return add_partition_columns(clean(typed(bronze)))


def row_status() -> Column:
    """Why a typed row is dropped; a missing key comes before a bad value."""
    return (
        F.when(~keys_present(), NULL_KEY)
        .when(measures_positive(), KEPT)
        .otherwise(INVALID_VALUE)
    )


def cleaning_counts(status: Column) -> list[Column]:
    kept = status == KEPT
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(status == NULL_KEY).alias("null_key_rows"),
        F.count_if(status == INVALID_VALUE).alias("invalid_value_rows"),
        F.count_if(kept).alias("rows_out"),
        F.count_if(kept & (F.isnan("value") | F.isnan("pvalue"))).alias("nan_rows"),
    ]


def cleaning_report(rows: DataFrame) -> DataFrame:
    """One row of counts over typed rows, in one pass and one small shuffle."""
    return rows.agg(*cleaning_counts(row_status()))


def duplicate_rows(silver: DataFrame) -> DataFrame:
    """How many rows repeat an earlier (``mess_id``, ``valuedate``). They are kept."""
    per_key = silver.groupBy("mess_id", "valuedate").agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))
