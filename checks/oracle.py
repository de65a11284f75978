"""The registered queries as SQL for DuckDB, on the same tables.

Each statement starts from the same rule that ``inputs.py`` states for Spark.
"""

from __future__ import annotations

# The layout as the tables are described, stated here a second time so that
# a wrong kind in the library shows.
_INTS = ("COMP_LEVEL", "MESS_ID", "STATE_VAL", "STATE_ACQ", "STATE_COR", "OFFSET")
_TIMES = ("VALUEDATE", "ENTRYDATE", "MINDATE", "MAXDATE")
_TEXTS = ("VERSION", "TEXT")
MEASUREMENT_NAMES = (
    "COMP_LEVEL", "VALUEDATE", "MESS_ID", "VALUE", "STATE_VAL", "STATE_ACQ", "STATE_COR",
    "ENTRYDATE", "MIN", "MINDATE", "MAX", "MAXDATE", "AVG", "SUM", "PVALUE", "OFFSET", "VERSION",
    "TEXT",
)
BRONZE_PARTITIONS = ("modul", "intervall")
FACT_MEASURES = ("value", "min", "max", "avg", "sum", "pvalue")


def _kind(name: str) -> str:
    if name in _INTS:
        return "int"
    return "timestamp" if name in _TIMES else "string" if name in _TEXTS else "double"


MEASUREMENT_COLUMNS = [(name, name.lower(), _kind(name)) for name in MEASUREMENT_NAMES]
SILVER_NAMES = [
    *BRONZE_PARTITIONS, *[name.lower() for name in MEASUREMENT_NAMES], "messung_typ", "year", "month"
]


def _names(names) -> str:
    return ", ".join(f'"{name}"' for name in names)


_CONSTANTS = """
    '50' AS "STATE_VAL", '0' AS "STATE_ACQ", '999' AS "STATE_COR", '1' AS "OFFSET",
    '01.01.0001 00:00:00' AS "VERSION", CAST(NULL AS VARCHAR) AS "TEXT",
    date_text AS "VALUEDATE", date_text AS "ENTRYDATE", date_text AS "MINDATE",
    date_text AS "MAXDATE", value_text AS "VALUE", value_text AS "MIN",
    value_text AS "MAX", value_text AS "AVG", value_text AS "SUM"
"""

_EVENT_BRONZE = f"""
given AS (
  SELECT *,
    CASE WHEN event_id % 89 = 0 THEN 'kaputt'
         ELSE strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%d.%m.%Y %H:%M:%S') END AS date_text,
    CASE WHEN event_id % 83 = 0 THEN '0'
         WHEN event_id % 79 = 0 THEN '-1'
         ELSE CAST(value AS VARCHAR) END AS value_text
  FROM events),
bronze AS (
  SELECT
    CASE event_type WHEN 'click' THEN 'Strom' WHEN 'view' THEN 'Waerme'
      WHEN 'error' THEN 'Nutzungsgrad' WHEN 'purchase' THEN 'Gas'
      WHEN 'signup' THEN 'Waermeabsatz' END || '_GOM_M' || (user_id % 3) AS "modul",
    CASE event_id % 3 WHEN 0 THEN '15_min' WHEN 1 THEN 'Täglich' ELSE 'Monatlich' END
      AS "intervall",
    CASE WHEN event_id % 101 <> 0 THEN '2100' END AS "COMP_LEVEL",
    CASE WHEN event_id % 97 = 0 THEN 'x17' ELSE CAST(user_id + 180000 AS VARCHAR) END
      AS "MESS_ID",
    value_text AS "PVALUE", {_CONSTANTS}
  FROM given)"""

_LINEITEM_BRONZE = f"""
given AS (
  SELECT *, strftime(l_shipdate, '%d.%m.%Y %H:%M:%S') AS date_text,
    CAST(l_extendedprice AS VARCHAR) AS value_text
  FROM lineitem),
bronze AS (
  SELECT
    CASE l_returnflag WHEN 'A' THEN 'Strom' WHEN 'N' THEN 'Waerme'
      WHEN 'R' THEN 'Nutzungsgrad' END || '_GOM_' || l_linestatus AS "modul",
    CASE l_linenumber % 3 WHEN 0 THEN '15_min' WHEN 1 THEN 'Täglich' ELSE 'Monatlich' END
      AS "intervall",
    '2100' AS "COMP_LEVEL", CAST(l_suppkey + 180000 AS VARCHAR) AS "MESS_ID",
    CAST(l_discount AS VARCHAR) AS "PVALUE", {_CONSTANTS}
  FROM given)"""

_SENSOR = """
sensor AS (
  SELECT CAST(epoch(date_trunc('second', ts) - TIMESTAMP '2024-01-01')::BIGINT AS VARCHAR)
      AS timesecs,
    CAST(value AS VARCHAR) AS humidity, CAST(user_id AS VARCHAR) AS temperature,
    CAST(event_id % 50 AS VARCHAR) AS flowrate
  FROM events)"""


def _parsed(raw: str, kind: str) -> str:
    if kind == "int":
        return f'TRY_CAST(trunc(TRY_CAST("{raw}" AS DOUBLE)) AS INTEGER)'
    if kind == "double":
        return f'TRY_CAST("{raw}" AS DOUBLE)'
    if kind == "timestamp":
        pattern = r"\d{2}\.\d{2}\.\d{4} \d{2}:\d{2}:\d{2}"
        return (
            f"""CASE WHEN regexp_full_match("{raw}", '{pattern}') """
            f"""THEN try_strptime("{raw}", '%d.%m.%Y %H:%M:%S') END"""
        )
    return f'"{raw}"'


_TYPED = f"""
typed AS (
  SELECT {_names(BRONZE_PARTITIONS)},
    {", ".join(f'{_parsed(raw, kind)} AS "{name}"' for raw, name, kind in MEASUREMENT_COLUMNS)},
    split_part("modul", '_', 1) AS "messung_typ"
  FROM bronze)"""

_KEYS = "mess_id IS NOT NULL AND comp_level IS NOT NULL AND valuedate IS NOT NULL"
_POSITIVE = "coalesce(value > 0 AND pvalue > 0, false)"

_SILVER = f"""
silver AS (
  SELECT *, CAST(year(valuedate) AS INTEGER) AS "year",
    CAST(month(valuedate) AS INTEGER) AS "month"
  FROM typed WHERE {_KEYS} AND {_POSITIVE})"""

_GOLD = f"""
dim_modul AS (
  SELECT CAST(row_number() OVER (ORDER BY modul) - 1 AS BIGINT) AS "modul_Id",
    modul AS modul_name
  FROM (SELECT DISTINCT modul FROM silver)),
dim_zeit AS (
  SELECT CAST(row_number() OVER (ORDER BY valuedate, intervall) - 1 AS BIGINT) AS "zeit_Id",
    valuedate AS "timestamp", CAST(valuedate AS DATE) AS datum,
    CAST(year(valuedate) AS INTEGER) AS jahr, CAST(month(valuedate) AS INTEGER) AS monat,
    CAST(day(valuedate) AS INTEGER) AS tag, CAST(hour(valuedate) AS INTEGER) AS stunde,
    CAST(minute(valuedate) AS INTEGER) AS "minute", intervall
  FROM (SELECT DISTINCT valuedate, intervall FROM silver)),
dim_messung AS (
  SELECT messung_typ AS messung_bezeichnung,
    CAST(row_number() OVER (ORDER BY messung_typ) - 1 AS BIGINT) AS "messung_Id",
    CASE WHEN messung_typ = 'Nutzungsgrad' THEN '%' ELSE 'kWh' END AS messung_einheit
  FROM (SELECT DISTINCT messung_typ FROM silver)),
faktentabelle AS (
  SELECT z."zeit_Id" AS "FK_zeit_Id", m."modul_Id" AS "FK_modul_Id",
    t."messung_Id" AS "FK_messung_Id",
    {", ".join(f's."{name}"' for name in FACT_MEASURES)}
  FROM silver s
  JOIN dim_modul m ON s.modul = m.modul_name
  JOIN dim_zeit z ON s.valuedate = z."timestamp" AND s.intervall = z.intervall
  JOIN dim_messung t ON s.messung_typ = t.messung_bezeichnung)"""

_REPORT = """
  SELECT modul AS modul_name,
    CASE WHEN messung_typ = 'Nutzungsgrad' THEN '%' ELSE 'kWh' END AS messung_einheit,
    "year" AS jahr, "month" AS monat, count(*) AS "rows",
    round(sum(value), 4) AS sum_value,
    round(round(sum(value), 4) / count(*), 4) AS avg_value
  FROM silver GROUP BY 1, 2, 3, 4"""

_DATASET = f"""
dataset AS (
  SELECT {", ".join(
      f'{_parsed(raw, kind) if kind in ("int", "double") else _parsed(raw, "string")} AS "{raw}"'
      for raw, _, kind in MEASUREMENT_COLUMNS)}
  FROM bronze)"""


def _with(*parts: str, select: str) -> str:
    return f"WITH {','.join(parts)}\n{select}"


def _events(select: str, *more: str) -> str:
    return _with(_EVENT_BRONZE, _TYPED, _SILVER, *more, select=select)


def _lineitems(select: str, *more: str) -> str:
    return _with(_LINEITEM_BRONZE, _TYPED, _SILVER, *more, select=select)


def _event_dataset(select: str) -> str:
    return _with(_EVENT_BRONZE, _DATASET, select=select)


_ALL_SILVER = f"SELECT {_names(SILVER_NAMES)} FROM silver"
_ALL_DATASET = f"SELECT {_names(MEASUREMENT_NAMES)} FROM dataset"
_ALL_TYPED = "SELECT * FROM typed"
_ALL_FACTS = "SELECT * FROM faktentabelle"

_CLEANING_REPORT = f"""
  SELECT count(*) AS rows_in,
    count(*) FILTER (WHERE NOT ({_KEYS})) AS null_key_rows,
    count(*) FILTER (WHERE {_KEYS} AND NOT {_POSITIVE}) AS invalid_value_rows,
    count(*) FILTER (WHERE {_KEYS} AND {_POSITIVE}) AS rows_out,
    count(*) FILTER (WHERE {_KEYS} AND {_POSITIVE} AND (isnan(value) OR isnan(pvalue)))
      AS nan_rows
  FROM typed"""


def _check(name: str, expected: str, found: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, CAST(({expected}) AS BIGINT) AS expected, "
        f"CAST(({found}) AS BIGINT) AS found"
    )


def _key_check(table: str, label: str, columns: str) -> str:
    return _check(
        f"{table} {label}",
        f"SELECT count(*) FROM {table}",
        f"SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {table})",
    )


def _orphan_check(fk: str, table: str, key: str) -> str:
    return _check(
        f"{fk} orphans",
        "SELECT 0",
        f'SELECT count(*) FROM faktentabelle f ANTI JOIN {table} d ON f."{fk}" = d."{key}"',
    )


_VERIFY = "SELECT *, expected = found AS passed FROM (" + " UNION ALL ".join(
    [
        _check(
            "faktentabelle rows",
            "SELECT count(*) FROM silver",
            "SELECT count(*) FROM faktentabelle",
        ),
        _check(
            "faktentabelle members",
            "SELECT count(*) FROM silver",
            f"""SELECT count(*) FROM (
                SELECT modul, valuedate, intervall, messung_typ, {_names(FACT_MEASURES)} FROM silver
                INTERSECT ALL
                SELECT modul_name, "timestamp", intervall, messung_bezeichnung,
                  {_names(FACT_MEASURES)}
                FROM faktentabelle f
                JOIN dim_modul m ON f."FK_modul_Id" = m."modul_Id"
                JOIN dim_zeit z ON f."FK_zeit_Id" = z."zeit_Id"
                JOIN dim_messung t ON f."FK_messung_Id" = t."messung_Id")""",
        ),
        _key_check("dim_modul", "key", '"modul_Id"'),
        _key_check("dim_modul", "natural key", "modul_name"),
        _key_check("dim_zeit", "key", '"zeit_Id"'),
        _key_check("dim_zeit", "natural key", '"timestamp", intervall'),
        _key_check("dim_messung", "key", '"messung_Id"'),
        _key_check("dim_messung", "natural key", "messung_bezeichnung"),
        _orphan_check("FK_zeit_Id", "dim_zeit", "zeit_Id"),
        _orphan_check("FK_modul_Id", "dim_modul", "modul_Id"),
        _orphan_check("FK_messung_Id", "dim_messung", "messung_Id"),
    ]
) + ")"

_FACT_ORDER = ", ".join(
    f'"{name}" NULLS FIRST'
    for name in ["FK_zeit_Id", "FK_modul_Id", "FK_messung_Id", *FACT_MEASURES]
)


_cells = ", ".join(f"""coalesce("{name}", '')""" for name in MEASUREMENT_NAMES)


def _rounded_average(column: str) -> str:
    # half up on the printed digits of the average, as Spark rounds a double
    return (
        f"CAST(round(CAST(CAST(avg(TRY_CAST({column} AS DOUBLE)) AS VARCHAR) "
        f"AS DECIMAL(38, 18)), 2) AS DOUBLE) AS {column}"
    )


_SENSOR_AVERAGES = _with(
    _SENSOR,
    select=f"""
  SELECT CAST(floor(TRY_CAST(timesecs AS DOUBLE) / 60) + 1 AS BIGINT) AS "hour",
    {_rounded_average("humidity")}, {_rounded_average("temperature")},
    {_rounded_average("flowrate")}
  FROM sensor GROUP BY 1""",
)

_BOTH_SILVER = f"SELECT * FROM ({_events(_ALL_SILVER)}) UNION ALL SELECT * FROM ({_lineitems(_ALL_SILVER)})"

_CELL_KEYS = ("COMP_LEVEL", "VALUEDATE", "MESS_ID")
_CELL_POSITIVE = ("VALUE", "PVALUE")


def _rejected(raw: str, kind: str) -> str:
    parsed, given = _parsed(raw, kind), f"""coalesce("{raw}", '') <> ''"""
    reasons = []
    if kind != "string":
        reasons.append(f"WHEN {given} AND {parsed} IS NULL THEN 'unreadable'")
    if raw in _CELL_KEYS + _CELL_POSITIVE:
        reasons.append(f"WHEN NOT {given} THEN 'missing'")
    if raw in _CELL_POSITIVE:
        reasons.append(f"WHEN NOT {parsed} > 0 THEN 'not_positive'")
    reason = f"CASE {' '.join(reasons)} END" if reasons else "CAST(NULL AS VARCHAR)"
    kinds = {name: kind for name, _, kind in MEASUREMENT_COLUMNS}
    good = " AND ".join(
        [f"{_parsed(name, kinds[name])} IS NOT NULL" for name in _CELL_KEYS]
        + [f"coalesce({_parsed(name, kinds[name])} > 0, false)" for name in _CELL_POSITIVE]
    )
    return (
        f"""SELECT modul, intervall, '{raw}' AS column_name, "{raw}" AS raw, {reason} AS reason, """
        f"NOT ({good}) AS row_dropped, true AS has_file FROM bronze"
    )


_REJECTED = _with(
    _EVENT_BRONZE,
    select="SELECT * FROM ("
    + " UNION ALL ".join(_rejected(raw, kind) for raw, _, kind in MEASUREMENT_COLUMNS)
    + ") WHERE reason IS NOT NULL",
)

_SPARK_NAMES = {"int": "int", "double": "double", "string": "string", "timestamp": "timestamp_ntz"}
_SILVER_KINDS = {
    **{name: "string" for name in (*BRONZE_PARTITIONS, "messung_typ")},
    **{name: _SPARK_NAMES[kind] for _, name, kind in MEASUREMENT_COLUMNS},
    "year": "int",
    "month": "int",
}
#: A column that is the same text in every row of the input is never null.
_PROFILE = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, CAST({position} AS INTEGER) AS position, "
    f"'{_SILVER_KINDS[name]}' AS data_type, {name != 'version'} AS nullable, count(*) AS \"rows\", "
    f'count(*) - count("{name}") AS null_rows FROM silver'
    for position, name in enumerate(SILVER_NAMES)
)


def _kept_keys(table: str, member: str, order: str) -> str:
    """Members of the events numbered from 0, those that only lineitem has numbered behind."""
    return f"""
        SELECT '{table}' AS table_name,
          row_number() OVER (ORDER BY is_new, {order}) - 1 AS key, member
        FROM (SELECT {order}, {member} AS member, bool_and(is_new) AS is_new
              FROM marked GROUP BY ALL)"""


_KEPT_KEYS = f"""
    WITH marked AS (
        SELECT *, false AS is_new FROM ({_events(_ALL_SILVER)})
        UNION ALL SELECT *, true FROM ({_lineitems(_ALL_SILVER)}))
    {_kept_keys("dim_modul", "modul", "modul")}
    UNION ALL {_kept_keys("dim_messung", "messung_typ", "messung_typ")}
    UNION ALL {_kept_keys(
        "dim_zeit",
        "strftime(valuedate, '%Y-%m-%d %H:%M:%S') || ' ' || intervall",
        "valuedate, intervall",
    )}"""

ORACLE_SQL: dict[str, str] = {
    "silver_typed": _events(_ALL_TYPED),
    "silver_clean": _events(f"SELECT * FROM typed WHERE {_KEYS} AND {_POSITIVE}"),
    "silver_partition_cols": _events(_ALL_SILVER),
    "cleaning_report": _events(_CLEANING_REPORT),
    "cleaning_report_lineitem": _lineitems(_CLEANING_REPORT),
    "duplicate_rows": _events(
        "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM "
        "(SELECT count(*) AS n FROM silver GROUP BY mess_id, valuedate)"
    ),
    "rejected_cells": _REJECTED,
    "silver_profile": _events(_PROFILE),
    "dim_modul": _events("SELECT * FROM dim_modul", _GOLD),
    "dim_zeit": _events("SELECT * FROM dim_zeit", _GOLD),
    "dim_messung": _events("SELECT * FROM dim_messung", _GOLD),
    "join_modul": _events(
        'SELECT m."modul_Id", s.modul, s.valuedate, s.value FROM silver s '
        "JOIN dim_modul m ON s.modul = m.modul_name",
        _GOLD,
    ),
    "join_zeit": _events(
        'SELECT z."zeit_Id", s.valuedate, s.intervall, s.value FROM silver s '
        'JOIN dim_zeit z ON s.valuedate = z."timestamp" AND s.intervall = z.intervall',
        _GOLD,
    ),
    "join_messung": _events(
        'SELECT t."messung_Id", t.messung_einheit, s.messung_typ, s.value FROM silver s '
        "JOIN dim_messung t ON s.messung_typ = t.messung_bezeichnung",
        _GOLD,
    ),
    "fact_star_join": _events(_ALL_FACTS, _GOLD),
    "fact_star_join_lineitem": _lineitems(_ALL_FACTS, _GOLD),
    "fact_no_fanout": _events(
        'SELECT intervall, count(*) AS silver_rows, count(*) AS fact_rows FROM silver GROUP BY 1'
    ),
    "gold_verify": _events(_VERIFY, _GOLD),
    "gold_table_counts": _events(
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, count(*) AS \"rows\" FROM {table}"
            for table in ("dim_modul", "dim_zeit", "dim_messung", "faktentabelle")
        ),
        _GOLD,
    ),
    "keys_after_new_members": _KEPT_KEYS,
    "gold_incremental": f"WITH silver AS ({_BOTH_SILVER}) {_REPORT}",
    "silver_of_members": _events(
        f"{_ALL_SILVER} WHERE modul LIKE 'Nutzungsgrad%' AND \"year\" = 2024 AND \"month\" % 2 = 1"
    ),
    "gold_preview_dim_modul": _events(
        'SELECT * FROM dim_modul ORDER BY "modul_Id" LIMIT 10', _GOLD
    ),
    "gold_preview_dim_zeit": _events('SELECT * FROM dim_zeit ORDER BY "zeit_Id" LIMIT 10', _GOLD),
    "gold_preview_dim_messung": _events(
        "SELECT * FROM dim_messung ORDER BY messung_bezeichnung LIMIT 10", _GOLD
    ),
    "gold_preview_faktentabelle": _events(
        f"SELECT * FROM faktentabelle ORDER BY {_FACT_ORDER} LIMIT 10", _GOLD
    ),
    "module_month_report": _events(_REPORT),
    "module_month_report_lineitem": _lineitems(_REPORT),
    "explore_groups_1000": _event_dataset(
        'SELECT DISTINCT "VALUEDATE", "VALUE", "STATE_VAL", "AVG", "TEXT" FROM dataset '
        'ORDER BY "VALUEDATE" NULLS FIRST, "VALUE" NULLS FIRST, "STATE_VAL" NULLS FIRST, '
        '"AVG" NULLS FIRST, "TEXT" NULLS FIRST LIMIT 1000'
    ),
    "explore_count": _event_dataset(
        'SELECT "MESS_ID", count(*) AS "count" FROM dataset GROUP BY 1'
    ),
    "explore_all_groups": _event_dataset(
        'SELECT "VALUEDATE", "VALUE", count(*) AS "count" FROM dataset GROUP BY 1, 2'
    ),
    "explore_total": _event_dataset('SELECT count(*) AS "count" FROM dataset'),
    "explore_filtered": _events(
        'SELECT modul, intervall, count(*) AS "count", max(value) AS max_value FROM silver '
        "WHERE value > 50 AND messung_typ <> 'Gas' GROUP BY 1, 2 "
        'ORDER BY "count" DESC, modul, intervall'
    ),
    "explore_day_grain": _events(
        "SELECT CAST(CAST(valuedate AS DATE) AS TIMESTAMP) AS valuedate, messung_typ, "
        'count(*) AS "count" FROM silver GROUP BY 1, 2'
    ),
    "explore_hour_grain": _events(
        "SELECT date_trunc('hour', valuedate) AS valuedate, messung_typ, "
        'count(*) AS "count", max(value) AS max_value FROM silver GROUP BY 1, 2'
    ),
    "explore_week_gaps": _events(
        'SELECT s.mess_id, s.valuedate, coalesce(b."count", 0) AS "count", max_value '
        "FROM spine s LEFT JOIN buckets b USING (mess_id, valuedate)",
        """
        buckets AS (
          SELECT mess_id, CAST(date_trunc('week', valuedate) AS TIMESTAMP) AS valuedate,
            count(*) AS "count", max(value) AS max_value
          FROM silver GROUP BY 1, 2),
        spine AS (
          SELECT mess_id,
            unnest(generate_series(min(valuedate), max(valuedate), INTERVAL 7 DAY)) AS valuedate
          FROM buckets GROUP BY 1)""",
    ),
    "explore_third_page": _event_dataset(
        'SELECT "VALUEDATE", "VALUE", count(*) AS "count" FROM dataset GROUP BY 1, 2 '
        'ORDER BY "VALUEDATE" NULLS FIRST, "VALUE" NULLS FIRST LIMIT 500 OFFSET 1000'
    ),
    "explore_from_partials": _events(
        'SELECT messung_typ, "month", count(*) AS "count", round(sum(value), 4) AS sum_value, '
        "min(value) AS least, max(value) AS largest, round(avg(value), 4) AS avg_value "
        "FROM silver WHERE intervall <> '15_min' GROUP BY 1, 2"
    ),
    "sensor_bucket_avg": _SENSOR_AVERAGES,
    "sensor_buckets": _with(
        _SENSOR,
        select='SELECT *, CAST(floor(TRY_CAST(timesecs AS DOUBLE) / 60) + 1 AS BIGINT) AS "hour" '
        "FROM sensor",
    ),
    "sensor_first_buckets": f'{_SENSOR_AVERAGES} ORDER BY "hour" NULLS FIRST LIMIT 10',
    "sensor_job": _SENSOR_AVERAGES,
    "csv_tree_roundtrip": _events(_ALL_TYPED),
    "csv_file_scan": _event_dataset(_ALL_DATASET),
    "config_read": _event_dataset(_ALL_DATASET),
    "config_write": _events(_ALL_SILVER),
    "config_options": _events(_ALL_TYPED),
    "parquet_partition_roundtrip": _events(_ALL_SILVER),
    "parquet_partition_lineitem": _lineitems(_ALL_SILVER),
    "silver_dynamic_overwrite": _events(
        "SELECT * REPLACE (CASE WHEN intervall = 'Täglich' THEN value * 2 ELSE value END AS value) "
        f"FROM ({_ALL_SILVER})"
    ),
    "parquet_flat_roundtrip": _events("SELECT * FROM dim_zeit", _GOLD),
    "parquet_readback_count": _events('SELECT count(*) AS "rows" FROM typed'),
    "parquet_compact": _events('SELECT count(*) AS "rows", true AS few_files FROM typed'),
    "silver_packed": _events(_ALL_SILVER),
    "silver_packed_files": _lineitems(
        'SELECT modul, intervall, count(*) AS "rows", '
        "count(DISTINCT least((day(valuedate) - 1) // 10, 2)) AS units_before, "
        "CAST(1 AS BIGINT) AS units_after FROM silver GROUP BY 1, 2"
    ),
    "csv_roundtrip": _with(_SENSOR, select="SELECT * FROM sensor"),
    "file_inventory": _events(
        "SELECT modul, intervall, 'csv' AS file_type, "
        f"CAST(sum(strlen(concat_ws(';', {_cells})) + 1) AS BIGINT) AS bytes "
        "FROM bronze GROUP BY 1, 2"
    ),
    "load_record": _event_dataset(
        "SELECT 'testdaten' AS table_name, count(*) AS row_count FROM dataset"
    ),
    "job_chain": _events(_REPORT),
    "job_chain_monthly": _events(_REPORT),
    "job_chain_lineitem": _lineitems(_REPORT),
    "landing_stream": _events(_ALL_SILVER),
    "stream_and_batch": _events(_ALL_SILVER),
}
