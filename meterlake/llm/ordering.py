"""Places of rows in an order, also where one group holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import stage


def numbered(rows: DataFrame, group: str, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with their ``place`` (from 0) in their group, and the ``total`` of the group.

    The rows are range-sorted as a whole and stored, so a large group lies in many ranges.
    Places count within a range; the rows of the group in earlier ranges are added. No task
    gets more of a group than a range holds. Rows equal in ``order`` follow one another in
    any order. ``part`` is the range of a row; ``group`` must not be null.
    """
    ranges = stage(
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(group, *order, "tie")
        .withColumn("part", F.spark_partition_id()),
        label,
    )
    sizes = ranges.groupBy("part", group).agg(F.count(F.lit(1)).alias("size"))
    of_group = Window.partitionBy(group)
    earlier = of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "part",
        group,
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"),
        F.sum("size").over(of_group).alias("total"),
    )
    in_part = Window.partitionBy("part", group).orderBy(*order, "tie")
    return (
        ranges.withColumn("place", F.row_number().over(in_part))
        .join(starts, ["part", group])
        .select(
            "part",
            *rows.columns,
            (F.col("start") + F.col("place") - 1).alias("place"),
            "total",
        )
    )
