"""Null-aware predicates and aggregates with R's semantics, as built-in
expressions (they stay inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_true(cond: Column) -> Column:
    """TRUE only when ``cond`` is TRUE (NULL counts as not true)."""
    return F.coalesce(cond, F.lit(False))


def filter_out(df: DataFrame, cond: Column) -> DataFrame:
    """Drop rows where ``cond`` is TRUE; rows where it is NULL stay.
    A plain ``where(~cond)`` would also drop the NULL rows."""
    return df.where(~is_true(cond))


def not_in(col: Column | str, values: Iterable) -> Column:
    """``!x %in% values``: NULL ``x`` passes (F2)."""
    return ~is_true(_c(col).isin(list(values)))


def n_distinct_keep_null(col: Column | str) -> Column:
    """Distinct count where NULL counts as one more value (A6).  Built from
    two ordinary aggregates, so it keeps the two-phase (map-side) plan."""
    c = _c(col)
    return (F.count_distinct(c) + F.max(c.isNull().cast("int"))).cast("bigint")


def ratio(num: Column | str, den: Column | str) -> Column:
    """Ratio that is NULL (not an error, inf or NaN) when the denominator is
    zero or NULL (A16)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def fill_null(col: Column | str, value) -> Column:
    return F.coalesce(_c(col), F.lit(value))
