"""Stored partial aggregates: coarser groups answered without the rows themselves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What is stored per measure; an average comes from two of them.
PARTS = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
ROWS = "rows"

#: A metric: its function and its column; ("count", "*") counts rows.
Metric = tuple[str, str]


def partials(rows: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Rows, and sum, count, least and largest value of each measure, per combination of ``by``."""
    parts = [
        part(measure).alias(f"{measure}_{name}")
        for measure in measures
        for name, part in PARTS.items()
    ]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias(ROWS), *parts)


@dataclass(frozen=True)
class Partials:
    """A table of ``partials``, as stored, and what it was made from."""

    table: DataFrame
    by: Sequence[str]
    measures: Sequence[str]

    def answers(
        self, groupby: Sequence[str], metrics: Mapping[str, Metric], filters: Sequence[str] = ()
    ) -> bool:
        """Whether the table has what a query needs: its groups, measures and filter columns."""
        if not set(groupby) | set(filters) <= set(self.by):
            return False
        return all(
            (function, column) == ("count", "*")
            or function in (*PARTS, "avg") and column in self.measures
            for function, column in metrics.values()
        )

    def explore(
        self,
        groupby: Sequence[str],
        metrics: Mapping[str, Metric],
        conditions: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """The groups and metrics, from the partials alone.

        ``conditions`` holds a filter for some of the columns of ``by``. What the table cannot
        answer is an error, never a wrong number.
        """
        conditions = conditions or {}
        if not self.answers(groupby, metrics, list(conditions)):
            raise ValueError(f"not in partials by {list(self.by)} of {list(self.measures)}")
        rows = self.table
        for condition in conditions.values():
            rows = rows.filter(condition)
        return rows.groupBy(*groupby).agg(
            *[_again(function, column).alias(name) for name, (function, column) in metrics.items()]
        )


def _again(function: str, column: str) -> Column:
    """A metric of a coarser group from the parts of finer ones."""
    if column == "*":
        return F.coalesce(F.sum(ROWS), F.lit(0))
    if function == "avg":
        return F.sum(f"{column}_sum") / F.nullif(F.sum(f"{column}_count"), F.lit(0))
    if function == "count":
        return F.coalesce(F.sum(f"{column}_count"), F.lit(0))
    return PARTS[function](f"{column}_{function}")


def direct(rows: DataFrame, groupby: Sequence[str], metrics: Mapping[str, Metric]) -> DataFrame:
    """The same metrics from the rows themselves, for groups that partials do not have."""
    functions = {**PARTS, "avg": F.avg}
    return rows.groupBy(*groupby).agg(
        *[
            functions[function](F.lit(1) if column == "*" else F.col(column)).alias(name)
            for name, (function, column) in metrics.items()
        ]
    )


def explore_stored(
    rows: DataFrame,
    stored: Sequence[Partials],
    groupby: Sequence[str],
    metrics: Mapping[str, Metric],
    conditions: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The answer from the coarsest stored partials that have it, else from ``rows``."""
    conditions = conditions or {}
    able = [p for p in stored if p.answers(groupby, metrics, list(conditions))]
    if able:
        return min(able, key=lambda p: len(p.by)).explore(groupby, metrics, conditions)
    for condition in conditions.values():
        rows = rows.filter(condition)
    return direct(rows, groupby, metrics)
