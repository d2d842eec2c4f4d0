"""Top-N rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows of each group in ``order`` (ties broken by the
    order columns, so the result is deterministic).

    ``row_number() <= n`` lets Spark plan a partial per-group limit before the
    shuffle (``WindowGroupLimit``), so a group with millions of candidates
    ships only ``n`` rows per input partition."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
