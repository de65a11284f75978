"""Silver rows to three dimensions and a fact table.

Where a dimension of an earlier build is given as ``known``, its members keep their keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import calendar_columns, measurement_unit
from meterlake.operators.keys import stable_key
from meterlake.schema import DIM_MESSUNG, DIM_MODUL, DIM_ZEIT, FACT_MEASURES
from meterlake.staging import stage


def dim_modul(silver: DataFrame, known: DataFrame | None = None) -> DataFrame:
    members = silver.select(F.col("modul").alias("modul_name")).distinct()
    return stable_key(members, ["modul_name"], "modul_Id", known).select(*DIM_MODUL.names)


def dim_zeit(silver: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per (time stamp, interval)."""
    members = silver.select(F.col("valuedate").alias("timestamp"), "intervall").distinct()
    return (
        stable_key(members, ["timestamp", "intervall"], "zeit_Id", known)
        .withColumns(calendar_columns(F.col("timestamp")))
        .select(*DIM_ZEIT.names)
    )


def dim_messung(silver: DataFrame, known: DataFrame | None = None) -> DataFrame:
    members = silver.select(F.col("messung_typ").alias("messung_bezeichnung")).distinct()
    return (
        stable_key(members, ["messung_bezeichnung"], "messung_Id", known)
        .withColumn("messung_einheit", measurement_unit(F.col("messung_bezeichnung")))
        .select(*DIM_MESSUNG.names)
    )


def join_modul(rows: DataFrame, modul: DataFrame) -> DataFrame:
    return rows.join(modul, rows["modul"].eqNullSafe(modul["modul_name"]), "inner")


def join_zeit(rows: DataFrame, zeit: DataFrame) -> DataFrame:
    """Time stamp alone is not a key of the dimension; the interval belongs to it."""
    keys = zeit.select("zeit_Id", "timestamp", F.col("intervall").alias("zeit_intervall"))
    same = (rows["valuedate"] == keys["timestamp"]) & rows["intervall"].eqNullSafe(
        keys["zeit_intervall"]
    )
    return rows.join(keys, same, "inner").drop("timestamp", "zeit_intervall")


def join_messung(rows: DataFrame, messung: DataFrame) -> DataFrame:
    same = rows["messung_typ"].eqNullSafe(messung["messung_bezeichnung"])
    return rows.join(messung, same, "inner")


def faktentabelle(
    silver: DataFrame,
    modul: DataFrame,
    zeit: DataFrame,
    messung: DataFrame,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One fact row per silver row, also where a name is NULL: NULL is a member too.

    ``carry`` names silver columns that stay with the fact.

    Spark knows the size of stored dimensions and broadcasts those below the session's
    limit; silver is then not shuffled. A larger one is joined by sort-merge, in which
    adaptive execution splits a time stamp that many rows share.
    """
    joined = join_messung(join_zeit(join_modul(silver, modul), zeit), messung)
    return joined.select(
        F.col("zeit_Id").alias("FK_zeit_Id"),
        F.col("modul_Id").alias("FK_modul_Id"),
        F.col("messung_Id").alias("FK_messung_Id"),
        *FACT_MEASURES,
        *carry,
    )


def dimensions(
    silver: DataFrame, known: Mapping[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """All three, in the order ``faktentabelle`` takes them, from two scans of silver."""
    known = known or {}
    modules = stage(silver.select("modul", "messung_typ").distinct(), "modules")
    return {
        "dim_modul": dim_modul(modules, known.get("dim_modul")),
        "dim_zeit": dim_zeit(silver, known.get("dim_zeit")),
        "dim_messung": dim_messung(modules, known.get("dim_messung")),
    }


def silver_to_gold(silver: DataFrame) -> dict[str, DataFrame]:
    dims = dimensions(silver)
    return {**dims, "faktentabelle": faktentabelle(silver, *dims.values())}
