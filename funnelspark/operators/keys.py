"""Join helpers for grouping keys that may be NULL (R groups NA as a value)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``); the result has
    one copy of each key column (taken from the left, or the right for rows
    only the right side has in outer joins)."""
    if not keys:
        return left.crossJoin(right) if how in ("inner", "cross") else left.join(right, how=how)
    ren = {k: f"_rk_{k}" for k in keys}
    r = right.withColumnsRenamed(ren)
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[ren[k]]) for k in keys])
    j = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return j
    if how in ("right", "right_outer", "full", "full_outer", "outer"):
        j = j.withColumns({k: F.coalesce(left[k], F.col(ren[k])) for k in keys})
    return j.drop(*ren.values())
