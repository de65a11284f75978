"""Why a cell or a row of bronze did not make it to silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.operators.silver import KEPT, row_status, typed_columns
from meterlake.schema import BRONZE_PARTITIONS, MEASUREMENT_COLUMNS, SILVER_KEYS

#: Text that is not of the column's type.
UNREADABLE = "unreadable"
#: No text in a column that every row must have.
MISSING = "missing"
#: A measure that must be positive and is not.
NOT_POSITIVE = "not_positive"

#: Columns that rejected cells come from, beside those of silver.
FILE, FAULTS = "_file", "_faults"
POSITIVE = ["value", "pvalue"]


def _fault(raw: str, name: str, kind: str) -> Column:
    """Why the cell counts as rejected, or NULL."""
    text, parsed = F.col(raw), F.col(f"_typed.{name}")
    given = text.isNotNull() & (text != "")
    reason = F.when(given & parsed.isNull(), UNREADABLE) if kind != "string" else F.when(
        F.lit(False), UNREADABLE
    )
    if name in SILVER_KEYS or name in POSITIVE:
        reason = reason.when(~given, MISSING)
    if name in POSITIVE:
        reason = reason.when(~(parsed > 0), NOT_POSITIVE)
    return F.when(
        reason.isNotNull(),
        F.struct(F.lit(raw).alias("column_name"), text.alias("raw"), reason.alias("reason")),
    )


def typed_with_faults(bronze: DataFrame) -> DataFrame:
    """``typed`` rows with their file and an array of the cells that were rejected.

    ``bronze`` is read with its files named. A cell is parsed once; the same pass tells
    whether it was lost.
    """
    cells = bronze.withColumn("_typed", F.struct(*typed_columns()))
    faults = F.array(*[_fault(*column) for column in MEASUREMENT_COLUMNS])
    return cells.select(
        "_typed.*", FILE, F.filter(faults, lambda fault: fault.isNotNull()).alias(FAULTS)
    )


def rejects(rows: DataFrame) -> DataFrame:
    """One row per rejected cell: file, place, column, raw text, reason, whether the row went."""
    return (
        rows.filter(F.size(FAULTS) > 0)
        .withColumn("row_dropped", row_status() != KEPT)
        .select(
            F.col(FILE).alias("file"), *BRONZE_PARTITIONS, "row_dropped", F.explode(FAULTS).alias("_fault")
        )
        .select("file", *BRONZE_PARTITIONS, "_fault.*", "row_dropped")
    )
