"""Group-by queries as a chart tool sends them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Time grains: whole units from midnight, or from the first day of a period, as written.
#: (``date_trunc`` would cut in the session's time zone.) Each with the step to the next.
_SECONDS = {"PT1M": 60, "PT5M": 300, "PT15M": 900, "PT30M": 1800, "PT1H": 3600}
_PERIODS = {"P1W": "week", "P1M": "month", "P3M": "quarter", "P1Y": "year"}
_STEPS = {
    **{grain: f"INTERVAL '{seconds}' SECOND" for grain, seconds in _SECONDS.items()},
    "P1D": "INTERVAL '1' DAY",
    "P1W": "INTERVAL '7' DAY",
    "P1M": "INTERVAL '1' MONTH",
    "P3M": "INTERVAL '3' MONTH",
    "P1Y": "INTERVAL '1' YEAR",
}
TIME_GRAINS = tuple(_STEPS)


def _expression(given: Column | str) -> Column:
    return F.expr(given) if isinstance(given, str) else given


def _known_grain(grain: str) -> str:
    if grain not in _STEPS:
        raise ValueError(f"unknown time grain {grain!r}, known: {sorted(TIME_GRAINS)}")
    return grain


def grain_column(column: str, grain: str) -> Column:
    """The start of the grain that a wall-clock time lies in."""
    time, day = F.col(column), F.to_date(F.col(column))
    if _known_grain(grain) in _SECONDS:
        second = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
        whole = F.floor(second / _SECONDS[grain]) * _SECONDS[grain]
        return day.cast("timestamp_ntz") + F.make_dt_interval(secs=whole)
    first = F.trunc(day, _PERIODS[grain]) if grain in _PERIODS else day
    return first.cast("timestamp_ntz")


def fill_gaps(
    buckets: DataFrame,
    time_column: str,
    grain: str,
    *,
    within: Sequence[str] = (),
    empty: Mapping[str, object] | None = None,
) -> DataFrame:
    """``buckets`` with a row for each grain between the first and the last of its group.

    ``within`` names the columns that make a group. A row that was missing has the values of
    ``empty`` (0 for a count), else NULL. Rows without a time stay as they are.
    """
    step = _STEPS[_known_grain(grain)]
    names = list(within)
    timed = buckets.filter(F.col(time_column).isNotNull())
    ends = timed.groupBy(*names).agg(F.min(time_column).alias("_a"), F.max(time_column).alias("_b"))
    spine = ends.select(
        *[F.col(name).alias(f"_in_{name}") for name in names],
        F.explode(F.expr(f"sequence(_a, _b, {step})")).alias("_at"),
    ).filter(F.col("_at").isNotNull())
    same = F.col("_at") == F.col(time_column)
    for name in names:
        same &= F.col(f"_in_{name}").eqNullSafe(F.col(name))
    missing = F.col(time_column).isNull()
    values = {name: F.lit(value) for name, value in (empty or {}).items()}

    def cell(name: str) -> Column:
        if name == time_column:
            return F.col("_at").alias(name)
        if name in names:
            return F.col(f"_in_{name}").alias(name)
        filled = F.when(missing, values[name]).otherwise(F.col(name)) if name in values else F.col(name)
        return filled.alias(name)

    filled = spine.join(timed, same, "left").select(*map(cell, buckets.columns))
    return filled.unionByName(buckets.filter(missing))


def _value(given: object) -> Column:
    return given if isinstance(given, Column) else F.lit(given)


def comes_after(columns: Sequence[str], key: Sequence[object]) -> Column:
    """Rows behind ``key`` in the order of ``columns``, null first."""
    behind = F.lit(False)
    for name, value in reversed(list(zip(columns, key))):
        if value is None:
            larger, equal = F.col(name).isNotNull(), F.col(name).isNull()
        else:
            larger = F.coalesce(F.col(name) > _value(value), F.lit(False))
            equal = F.col(name).eqNullSafe(_value(value))
        behind = larger | (equal & behind)
    return behind


def explore(
    df: DataFrame,
    groupby: Sequence[str] = (),
    *,
    metrics: Mapping[str, Column | str] | None = None,
    filters: Sequence[Column | str] = (),
    time_column: str | None = None,
    grain: str | None = None,
    row_limit: int | None = None,
    order_by_metric: str | None = None,
    after: Sequence[object] | None = None,
) -> DataFrame:
    """Filter, group, aggregate and order; all groups, unless the caller sets a cap.

    Without metrics the result is the distinct combinations of ``groupby``.
    Rows are ordered by the group columns (or one metric, largest first, then the
    group columns) before the cap, so equal input gives equal rows. A capped result takes
    the first rows of each task and then of those, never a full sort.

    ``after`` is the last row of the page before: its group columns, in front of them the
    metric if rows are ordered by one. The page goes on behind it. Earlier pages are not
    sorted again: in the order of the group columns their rows go before they are grouped.
    """
    if not groupby and not metrics:
        raise ValueError("name at least one group column or metric")
    for condition in filters:
        df = df.filter(condition)
    if grain is not None:
        if time_column not in groupby:
            raise ValueError("time_column must be one of the group columns")
        df = df.withColumn(time_column, grain_column(time_column, grain))
    if after is not None and not order_by_metric:
        df = df.filter(comes_after(groupby, after))
    if metrics:
        named = [_expression(metric).alias(name) for name, metric in metrics.items()]
        result = df.groupBy(*groupby).agg(*named)
    else:
        result = df.select(*groupby).distinct()
    order = [F.desc(order_by_metric)] if order_by_metric else []
    if after is not None and order_by_metric:
        metric, key = F.col(order_by_metric), _value(after[0])
        later = F.coalesce(metric < key, metric.isNull() & key.isNotNull())
        result = result.filter(later | (metric.eqNullSafe(key) & comes_after(groupby, after[1:])))
    if groupby or order:
        result = result.orderBy(*order, *groupby)
    return result if row_limit is None else result.limit(row_limit)
