from meterlake.functions.derive import (
    calendar_columns,
    measurement_type,
    measurement_unit,
    minute_bucket,
)
from meterlake.functions.parsing import (
    format_timestamp,
    parse_as,
    parse_double,
    parse_int,
    parse_timestamp,
)

__all__ = [
    "calendar_columns",
    "format_timestamp",
    "measurement_type",
    "measurement_unit",
    "minute_bucket",
    "parse_as",
    "parse_double",
    "parse_int",
    "parse_timestamp",
]
