"""Lenient text parsing: a cell that cannot be read becomes NULL.

Works with ANSI mode on, where a plain cast would end the job instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dd.MM.yyyy HH:mm:ss with all parts zero-padded, as a pattern over the
# whole cell, and its parts in ISO order. Any other cell matches the second branch and
# leaves text that no cast accepts.
TIMESTAMP_TEXT = r"(?s)^(\d{2})\.(\d{2})\.(\d{4}) (\d{2}:\d{2}:\d{2})\z|^.*$"
ISO_ORDER = "$3-$2-$1 $4"


def parse_double(text: Column) -> Column:
    return text.try_cast("double")


def parse_int(text: Column) -> Column:
    """Whole number, fractions cut off; out of range gives NULL."""
    return text.try_cast("double").try_cast("int")


def parse_timestamp(text: Column) -> Column:
    """Wall-clock time as written, independent of the session time zone.

    ``text`` is used once, so a filter on the result that the optimizer moves below
    the projection does not repeat the expression behind ``text``.
    """
    return F.regexp_replace(text, TIMESTAMP_TEXT, ISO_ORDER).try_cast("timestamp_ntz")


def format_timestamp(ts: Column) -> Column:
    """``parse_timestamp`` backwards: a wall-clock time as text, in any session time zone.

    Put together from its parts; formatting as a whole would pass through the session's
    zone and move times that do not exist there.
    """

    def digits(part: Column, width: int = 2) -> Column:
        return F.lpad(part.cast("int").cast("string"), width, "0")

    date = F.concat_ws(".", digits(F.dayofmonth(ts)), digits(F.month(ts)), digits(F.year(ts), 4))
    time = F.concat_ws(":", digits(F.hour(ts)), digits(F.minute(ts)), digits(F.second(ts)))
    return F.when(ts.isNotNull(), F.concat(date, F.lit(" "), time))


_PARSERS = {
    "int": parse_int,
    "double": parse_double,
    "timestamp": parse_timestamp,
    "string": lambda text: text,
}


def parse_as(text: Column, kind: str) -> Column:
    return _PARSERS[kind](text)
