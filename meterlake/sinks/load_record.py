"""One row per finished load: which table, how many rows, when."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOAD_RECORD = "table_name string, row_count bigint"


def append_load_record(
    spark: SparkSession, records_path: str, table: str, row_count: int
) -> None:
    (
        spark.createDataFrame([(table, row_count)], LOAD_RECORD)
        .withColumn("loaded_at", F.current_timestamp())
        .write.mode("append")
        .parquet(records_path)
    )


def read_load_records(spark: SparkSession, records_path: str) -> DataFrame:
    return spark.read.schema(f"{LOAD_RECORD}, loaded_at timestamp").parquet(records_path)
