"""Result shaping shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison; adding zero turns -0.0 into 0.0."""
    return df.select(
        *[
            (F.round(F.col(c).cast("double"), digits) + F.lit(0.0)).alias(c) if t in ("double", "float") else F.col(c)
            for c, t in df.dtypes
        ]
    )
