"""Exact grouped quantiles with linear interpolation (R type 7, DuckDB
``quantile_cont``), one path for groups of any size.

Spark's exact ``percentile`` keeps every distinct value of a group in one
task's buffer; a group holding a third of the data would not fit.  Here the
order statistics a quantile needs (ranks ``floor(h)+1`` and ``ceil(h)+1`` with
``h = (n-1)p``) are found in two passes:

1. a histogram per group over bins of the value's logarithm (``BINS`` to a
   factor of e, by sign): map-side combined, and as fine for seconds as for far
   outliers.  Its running total tells the bin each wanted rank lies in;
2. only the values of those bins (at most two per quantile and group) are
   counted by distinct value, and a running total inside the bin gives the rank.

The wanted bins, at most ``2 * len(probs)`` rows per group, are broadcast to the
second pass, so values are not joined by shuffle; the broadcast checks that there
are at most ``MAX_GROUPS`` groups.  For keys that may have more (by person, say)
``many_groups`` joins the bins by shuffle instead, at any number of groups and
with the same result; adaptive execution splits a bin that holds a large share.
No job runs while the frame is built, and there are no rounds.

Interpolation is ``lo + (hi - lo) * (h - floor(h))``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import join_null_safe

BINS = 512
MAX_GROUPS = 1_000_000


def _h(n: Column, p: float) -> Column:
    return (n - F.lit(1)).cast("double") * F.lit(float(p))


def _bin(v: Column) -> Column:
    """Never falls as the value grows: sign and floor of the scaled logarithm."""
    size = F.floor(F.least(F.log(F.abs(v)), F.lit(710.0)) * F.lit(float(BINS))) + F.lit(1_000_000)  # > 0 for every double
    return F.when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size).cast("bigint")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], *,
                    with_stats: bool = True, many_groups: bool = False) -> DataFrame:
    """One row per group of ``keys``: ``n, min, max`` (if ``with_stats``) and
    one column per entry of ``probs``.  NULL/NaN values are ignored; groups with
    no value are absent."""
    keys = list(keys)
    v = F.col(value).cast("double")
    values = df.select(*keys, F.when(v == 0, F.lit(0.0)).otherwise(v).alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")).withColumn("_bin", _bin(F.col("_v")))
    hist = values.groupBy(*keys, "_bin").agg(F.count("*").alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    w = Window.partitionBy(*keys)
    upto = w.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumns({
        "_n": F.sum("_c").over(w), "_lo": F.min("_min").over(w), "_hi": F.max("_max").over(w),
        "_before": F.sum("_c").over(upto) - F.col("_c")})
    ranks = F.array_distinct(F.array(*[r.cast("bigint") for p in probs.values()
                                       for r in (F.floor(_h(F.col("_n"), p)) + 1, F.ceil(_h(F.col("_n"), p)) + 1)]))
    inside = F.filter(ranks, lambda r: (r > F.col("_before")) & (r <= F.col("_before") + F.col("_c")))
    wanted = hist.withColumn("_ranks", inside).where(F.size("_ranks") > 0).select(
        *keys, "_bin", "_before", "_n", "_lo", "_hi", "_ranks")
    if not many_groups:
        # The bound of the broadcast, checked where it is made (a few rows per group).
        few = F.col("_rows") <= F.lit(MAX_GROUPS * 2 * len(probs))
        wanted = F.broadcast(wanted.withColumn("_rows", F.count("*").over(Window.partitionBy())).where(
            F.assert_true(few, "too many groups to broadcast: set many_groups").isNull()).drop("_rows"))

    counts = join_null_safe(values, wanted, [*keys, "_bin"]).groupBy(
        *keys, "_bin", "_before", "_n", "_lo", "_hi", "_ranks", "_v").agg(F.count("*").alias("_c"))
    wv = Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_upto", F.sum("_c").over(wv) + F.col("_before"))
    hit = F.filter("_ranks", lambda r: (r > F.col("_upto") - F.col("_c")) & (r <= F.col("_upto")))
    found = counts.select(*keys, "_n", "_lo", "_hi", "_v", F.explode(hit).alias("_rank"))
    # Per group at most two entries for each quantile.
    out = found.groupBy(*keys, "_n", "_lo", "_hi").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_m"))
    cols = [F.col(k) for k in keys]
    if with_stats:
        cols += [F.col("_n").alias("n"), F.col("_lo").alias("min"), F.col("_hi").alias("max")]
    for name, p in probs.items():
        h = _h(F.col("_n"), p)
        lo = F.element_at(F.col("_m"), (F.floor(h) + 1).cast("bigint"))
        hi = F.element_at(F.col("_m"), (F.ceil(h) + 1).cast("bigint"))
        cols.append((lo + (hi - lo) * (h - F.floor(h))).alias(name))
    return out.select(*cols)


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], *,
              approx: bool = False, accuracy: int = 10_000, with_stats: bool = True, many_groups: bool = False) -> DataFrame:
    """:func:`exact_quantiles`, or with ``approx`` Spark's ``percentile_approx``
    sketch (one map-side combined aggregate, bounded memory per group; returns
    data values, relative rank error about 1/accuracy)."""
    if not approx:
        return exact_quantiles(df, keys, value, probs, with_stats=with_stats, many_groups=many_groups)
    keys = list(keys)
    v = F.col(value).cast("double")
    values = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    names = list(probs)
    agg = values.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min("_v").alias("min"), F.max("_v").alias("max"),
        F.percentile_approx("_v", [float(probs[n]) for n in names], accuracy).alias("_q"))
    cols = [F.col(k) for k in keys]
    if with_stats:
        cols += ["n", "min", "max"]
    cols += [F.col("_q")[i].alias(n) for i, n in enumerate(names)]
    return agg.select(*cols)
