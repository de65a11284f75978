"""Columns derived from parsed ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one measurement type that is a ratio, and the two units.
RATIO_TYPE = "Nutzungsgrad"
RATIO_UNIT = "%"
ENERGY_UNIT = "kWh"


def measurement_type(modul: Column) -> Column:
    """Text before the first ``_``; the whole text if there is none."""
    return F.substring_index(modul, "_", 1)


def measurement_unit(messung: Column) -> Column:
    return F.when(messung == RATIO_TYPE, RATIO_UNIT).otherwise(ENERGY_UNIT)


def calendar_columns(ts: Column) -> dict[str, Column]:
    return {
        "datum": F.to_date(ts),
        "jahr": F.year(ts),
        "monat": F.month(ts),
        "tag": F.dayofmonth(ts),
        "stunde": F.hour(ts),
        "minute": F.minute(ts),
    }


def minute_bucket(seconds: Column, width: int = 60) -> Column:
    """1-based bucket of ``width`` seconds."""
    return F.floor(seconds / F.lit(width)) + F.lit(1)
