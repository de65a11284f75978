"""What several operators share: inputs, staged tables, ranges of a key."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.paths import let_workers_import
from meterlake.staging import new_path

#: White space of words and of normalised texts: space, tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
#: Bytes that a range of a key should not exceed, unless there would be too many ranges for
#: the driver to hold their bounds.
RANGE_BYTES, MOST_RANGES = 128 << 20, 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The two columns every operator on documents needs; a null text is empty."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A column of lists from an array for each row."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(array) for array in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranges_for(spark: SparkSession, size: int) -> int:
    """Ranges for ``size`` bytes: the session's shuffle partitions, more where those are long."""
    return max(parallelism(spark), min(MOST_RANGES, -(-size // RANGE_BYTES)))


def range_bounds(
    df: DataFrame, key: str, parts: int, weight: Column | None = None
) -> list[float]:
    """At most ``parts - 1`` rising values that cut ``key`` into even ranges.

    Even in rows, or in their ``weight``, a small whole number. The quantile sketch is merged
    on the driver; its size depends on ``parts`` alone.
    """
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    if weight is not None:
        df = df.select(F.explode(F.array_repeat(F.col(key), weight)).alias(key))
    found = df.approxQuantile(key, shares, 1 / (8 * parts))
    return sorted(set(found))


def range_of(key: Column, bounds: Sequence[float]) -> Column:
    """The number of the range a key lies in; null keys lie in the first."""
    edges = np.asarray(bounds, dtype="float64")

    @F.pandas_udf("int")
    def find(keys: pd.Series) -> pd.Series:
        found = np.searchsorted(edges, keys.to_numpy(dtype="float64", na_value=-np.inf), "right")
        return pd.Series(found.astype("int32"))

    return find(key)
