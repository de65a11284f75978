"""Readings of some dimension members, reading only the directories that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def readings_where(
    silver: DataFrame,
    gold: dict[str, DataFrame],
    *,
    modul: Column | str | None = None,
    zeit: Column | str | None = None,
) -> DataFrame:
    """Silver rows of the modules and times that a condition on their dimension picks.

    Silver is joined with the picked members on its directory columns: the name of the
    module, the year and the month. The members are few and broadcast, if their size allows,
    and Spark then takes their names to leave out directories while the query runs, before
    any file in them is opened. The time itself is compared afterwards.
    """
    rows = silver
    if modul is not None:
        picked = gold["dim_modul"].filter(modul).select(F.col("modul_name").alias("modul"))
        rows = rows.join(picked, "modul", "left_semi")
    if zeit is not None:
        members = gold["dim_zeit"].filter(zeit)
        months = members.select(F.col("jahr").alias("year"), F.col("monat").alias("month"))
        rows = rows.join(months.distinct(), ["year", "month"], "left_semi")
        times = members.select(F.col("timestamp").alias("valuedate"), "intervall")
        rows = rows.join(times, ["valuedate", "intervall"], "left_semi")
    return rows.select(*silver.columns)
