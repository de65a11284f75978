"""Surrogate keys that depend on the data alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.staging import stage


def dense_key(members: DataFrame, natural_key: list[str], key_name: str) -> DataFrame:
    """Number distinct ``members`` 0, 1, 2, … in the order of ``natural_key``.

    Rows are numbered inside each range of keys; the rows of earlier ranges are added.
    The ranges are stored with their number, so every later reading sees the same ones.
    The window over all of them has one row per shuffle partition.
    """
    ranges = stage(
        members.repartitionByRange(*natural_key).withColumn("_range", F.spark_partition_id()),
        key_name,
    )
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select(
        "_range",
        (F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")).alias("_start"),
    )
    position = F.row_number().over(Window.partitionBy("_range").orderBy(*natural_key))
    return (
        ranges.withColumn("_position", position)
        .join(starts, "_range")
        .select(
            (F.col("_start") + F.col("_position") - 1).cast("bigint").alias(key_name),
            *members.columns,
        )
    )


def stable_key(
    members: DataFrame, natural_key: list[str], key_name: str, known: DataFrame | None
) -> DataFrame:
    """``dense_key`` for members that are not ``known`` yet; all others keep the key they have.

    New members are numbered behind the largest known key, in the order of ``natural_key``.
    Known members that no longer occur stay, so rows stored earlier still join. NULL is a
    member like any other.
    """
    if known is None:
        return dense_key(members, natural_key, key_name)
    known = known.select(key_name, *natural_key)
    named = known.select(*[F.col(name).alias(f"_known_{name}") for name in natural_key])
    same = reduce(
        lambda a, b: a & b,
        [F.col(name).eqNullSafe(F.col(f"_known_{name}")) for name in natural_key],
    )
    new = dense_key(members.join(named, same, "left_anti"), natural_key, key_name)
    largest = known.agg(F.max(key_name)).first()[0]
    first = 0 if largest is None else largest + 1
    return known.unionByName(new.withColumn(key_name, F.col(key_name) + F.lit(first)))
