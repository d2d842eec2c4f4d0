"""Wide <-> long reshapes with static output schemas.

Pivot values are always listed explicitly: the output columns do not depend on
which values the data happens to contain, and Spark skips the extra job it
would otherwise run to discover them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "metric",
                 value: str = "value", drop_null: bool = False) -> DataFrame:
    """``pivot_longer``: one row per (ids, column in ``values``); values cast to
    double so counts and shares share one column."""
    cast = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    out = cast.unpivot(list(ids), list(values), name, value)
    return out.where(F.col(value).isNotNull()) if drop_null else out


def long_to_wide(df: DataFrame, ids: Sequence[str], names_from: str, values_from: str,
                 names: Sequence[str], fill=None) -> DataFrame:
    """``pivot_wider`` with an explicit list of new columns; ``fill`` replaces
    absent combinations (``values_fill``)."""
    out = df.groupBy(*ids).pivot(names_from, list(names)).agg(F.first(values_from, ignorenulls=True))
    if fill is not None:
        out = out.fillna(fill, subset=list(names))
    return out


def long_to_wide_periods(df: DataFrame, metrics: Sequence[str], periods: Sequence[str],
                         period_col: str = "period") -> DataFrame:
    """Per-period metric rows -> ``metric, <period>...``; a period missing from
    the data gives a NULL column rather than a missing one (F11)."""
    long = wide_to_long(df, [period_col], metrics)
    return long_to_wide(long, ["metric"], period_col, "value", periods)
