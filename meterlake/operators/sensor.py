"""Bucket averages of sensor readings kept as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import minute_bucket, parse_double

# Columns of the gas-sensor table and the bucket column's name.
SENSOR_TIME = "timesecs"
SENSOR_VALUES = ["humidity", "temperature", "flowrate"]
BUCKET = "hour"


def add_bucket(sensor: DataFrame, width: int = 60) -> DataFrame:
    """Named ``hour`` as in stored results; with seconds and width 60 it is a minute."""
    return sensor.withColumn(BUCKET, minute_bucket(parse_double(F.col(SENSOR_TIME)), width))


def bucket_averages(
    sensor: DataFrame, *, width: int = 60, values: Sequence[str] = SENSOR_VALUES
) -> DataFrame:
    return (
        add_bucket(sensor, width)
        .groupBy(BUCKET)
        .agg(*[F.round(F.avg(parse_double(F.col(v))), 2).alias(v) for v in values])
        .orderBy(BUCKET)
    )
