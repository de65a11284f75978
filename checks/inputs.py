"""Measurement and sensor rows derived by Spark from the given tables.

Every row of a table gives one measurement. Row numbers only decide which cells
are damaged on purpose, so that cleaning has something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions import format_timestamp
from meterlake.schema import BRONZE_PARTITIONS, MEASUREMENT_NAMES

# Fixed values, repeated in the SQL of oracle.py.
EVENT_MODULES = {
    "click": "Strom",
    "view": "Waerme",
    "error": "Nutzungsgrad",
    "purchase": "Gas",
    "signup": "Waermeabsatz",
}
RETURN_MODULES = {"A": "Strom", "N": "Waerme", "R": "Nutzungsgrad"}
INTERVALS = {0: "15_min", 1: "Täglich", 2: "Monatlich"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(column: Column, values: dict) -> Column:
    (first, value), *others = values.items()
    result = F.when(column == first, value)
    for key, other in others:
        result = result.when(column == key, other)
    return result


def _quarter_hour_text(ts: Column) -> Column:
    quarter = F.floor(F.minute(ts) / 15) * 15
    start = F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), quarter.cast("int"), F.lit(0)
    )
    return format_timestamp(start)


def _measurements(
    rows: DataFrame,
    *,
    modul: Column,
    intervall: Column,
    comp_level: Column,
    valuedate: Column,
    mess_id: Column,
    value: Column,
    pvalue: Column,
) -> DataFrame:
    cells = {
        "modul": modul,
        "intervall": intervall,
        "COMP_LEVEL": comp_level,
        "MESS_ID": mess_id,
        "PVALUE": pvalue,
        "STATE_VAL": F.lit("50"),
        "STATE_ACQ": F.lit("0"),
        "STATE_COR": F.lit("999"),
        "OFFSET": F.lit("1"),
        "VERSION": F.lit("01.01.0001 00:00:00"),
        "TEXT": F.lit(None).cast("string"),
        **{name: valuedate for name in ("VALUEDATE", "ENTRYDATE", "MINDATE", "MAXDATE")},
        **{name: value for name in ("VALUE", "MIN", "MAX", "AVG", "SUM")},
    }
    return rows.select(
        *[cells[name].alias(name) for name in BRONZE_PARTITIONS + MEASUREMENT_NAMES]
    )


def event_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows from ``events``: 15 modules, 3 intervals, a meter for each user."""
    number, user = F.col("event_id"), F.col("user_id")
    value = (
        F.when(number % 83 == 0, "0")
        .when(number % 79 == 0, "-1")
        .otherwise(F.col("value").cast("string"))
    )
    return _measurements(
        table(spark, sf_dir, "events"),
        modul=F.concat(
            _lookup(F.col("event_type"), EVENT_MODULES),
            F.lit("_GOM_M"),
            (user % 3).cast("string"),
        ),
        intervall=_lookup(number % 3, INTERVALS),
        comp_level=F.when(number % 101 != 0, "2100"),
        valuedate=F.when(number % 89 == 0, "kaputt").otherwise(_quarter_hour_text(F.col("ts"))),
        mess_id=F.when(number % 97 == 0, "x17").otherwise((user + 180000).cast("string")),
        value=value,
        pvalue=value,
    )


def lineitem_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows from ``lineitem``, the larger table; discount 0 fails cleaning."""
    value = F.col("l_extendedprice").cast("string")
    return _measurements(
        table(spark, sf_dir, "lineitem"),
        modul=F.concat(
            _lookup(F.col("l_returnflag"), RETURN_MODULES),
            F.lit("_GOM_"),
            F.col("l_linestatus"),
        ),
        intervall=_lookup(F.col("l_linenumber") % 3, INTERVALS),
        comp_level=F.lit("2100"),
        valuedate=format_timestamp(F.col("l_shipdate")),
        mess_id=(F.col("l_suppkey") + 180000).cast("string"),
        value=value,
        pvalue=F.col("l_discount").cast("string"),
    )


def event_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor rows as text from ``events``; time in whole seconds since 2024-01-01."""
    ts = F.col("ts")
    days = F.datediff(F.to_date(ts), F.lit("2024-01-01").cast("date"))
    seconds = (
        days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))
    ).cast("string")
    return table(spark, sf_dir, "events").select(
        seconds.alias("timesecs"),
        F.col("value").cast("string").alias("humidity"),
        F.col("user_id").cast("string").alias("temperature"),
        (F.col("event_id") % 50).cast("string").alias("flowrate"),
    )
