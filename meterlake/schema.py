"""Column layout of the three layers.

Bronze is text: every cell is read as a string and parsed leniently, so one
bad cell never changes the type of a whole column.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values: (bronze column, silver column, kind) in file order.
MEASUREMENT_COLUMNS = [
    ("COMP_LEVEL", "comp_level", "int"),
    ("VALUEDATE", "valuedate", "timestamp"),
    ("MESS_ID", "mess_id", "int"),
    ("VALUE", "value", "double"),
    ("STATE_VAL", "state_val", "int"),
    ("STATE_ACQ", "state_acq", "int"),
    ("STATE_COR", "state_cor", "int"),
    ("ENTRYDATE", "entrydate", "timestamp"),
    ("MIN", "min", "double"),
    ("MINDATE", "mindate", "timestamp"),
    ("MAX", "max", "double"),
    ("MAXDATE", "maxdate", "timestamp"),
    ("AVG", "avg", "double"),
    ("SUM", "sum", "double"),
    ("PVALUE", "pvalue", "double"),
    ("OFFSET", "offset", "int"),
    ("VERSION", "version", "string"),
    ("TEXT", "text", "string"),
]

# Directory columns of bronze, partition columns of silver.
BRONZE_PARTITIONS = ["modul", "intervall"]
SILVER_PARTITIONS = ["modul", "intervall", "mess_id", "year", "month"]
SILVER_KEYS = ["mess_id", "comp_level", "valuedate"]
FACT_MEASURES = ["value", "min", "max", "avg", "sum", "pvalue"]

#: The silver columns that gold is built from.
GOLD_INPUT = ["modul", "intervall", "valuedate", "messung_typ", *FACT_MEASURES]

_SPARK_TYPES = {
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampNTZType(),
}


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


def text_schema(names) -> T.StructType:
    return _table(*[(name, T.StringType()) for name in names])


MEASUREMENT_NAMES = [bronze for bronze, _, _ in MEASUREMENT_COLUMNS]

#: One measurement file without its directory columns.
MEASUREMENT_FILE = text_schema(MEASUREMENT_NAMES)

#: The bronze tree. Directory values stay text: ``modul=007`` is not a number.
BRONZE = text_schema(MEASUREMENT_NAMES + BRONZE_PARTITIONS)

SILVER = _table(
    ("modul", T.StringType()),
    ("intervall", T.StringType()),
    *[(silver, _SPARK_TYPES[kind]) for _, silver, kind in MEASUREMENT_COLUMNS],
    ("messung_typ", T.StringType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
)

DIM_MODUL = _table(("modul_Id", T.LongType()), ("modul_name", T.StringType()))

DIM_ZEIT = _table(
    ("zeit_Id", T.LongType()),
    ("timestamp", T.TimestampNTZType()),
    ("datum", T.DateType()),
    ("jahr", T.IntegerType()),
    ("monat", T.IntegerType()),
    ("tag", T.IntegerType()),
    ("stunde", T.IntegerType()),
    ("minute", T.IntegerType()),
    ("intervall", T.StringType()),
)

DIM_MESSUNG = _table(
    ("messung_bezeichnung", T.StringType()),
    ("messung_Id", T.LongType()),
    ("messung_einheit", T.StringType()),
)

FAKTENTABELLE = _table(
    ("FK_zeit_Id", T.LongType()),
    ("FK_modul_Id", T.LongType()),
    ("FK_messung_Id", T.LongType()),
    *[(name, T.DoubleType()) for name in FACT_MEASURES],
)

#: The gold tables in load order: dimensions before the fact.
GOLD = {
    "dim_modul": DIM_MODUL,
    "dim_zeit": DIM_ZEIT,
    "dim_messung": DIM_MESSUNG,
    "faktentabelle": FAKTENTABELLE,
}
