"""Small results for a notebook."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame


def to_pandas(df: DataFrame, rows: int) -> pd.DataFrame:
    """The first ``rows`` rows; the limit is applied before anything moves."""
    return df.limit(rows).toPandas()
