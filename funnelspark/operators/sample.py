"""Exact-size, seeded sample of distinct keys without replacement (M1).

Keys are ordered by ``md5(key || seed)`` (ties by key) and the first
``floor(share * n)`` are taken.  The order is a pure function of the key, so
the sample is identical under any partitioning or executor loss.

The sample is represented by its *cutoff*: the last chosen (hash, key) pair.
A row belongs to the sample iff its (hash, key) is not greater, which is a
plain predicate -- no join against the (large) set of chosen keys.

Finding the cutoff needs no global sort or single-partition window over the
keys: keys are bucketed by the first four hex digits of their hash (65,536
buckets, a bound fixed in code), bucket counts locate the bucket holding the
cut, and only that bucket's keys are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_PREFIX = 4  # hex digits -> 16**4 buckets


def hash_order(key: Column, seed: str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(seed)))


def sample_cutoff(df: DataFrame, key: str, share: float, seed: str) -> DataFrame:
    """At most one row ``_h, _k``: the last key in the sample (none when the
    sample is empty)."""
    k = df.select(key).where(F.col(key).isNotNull()).distinct() \
        .withColumn("_h", hash_order(F.col(key), seed)) \
        .withColumn("_b", F.substring("_h", 1, HASH_PREFIX))
    hist = k.groupBy("_b").agg(F.count("*").alias("_c"))
    # <= 65,536 rows: total and running total over buckets are bounded windows.
    w = Window.orderBy("_b")
    total = F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    hist = hist.withColumn("_take", F.floor(total.cast("double") * F.lit(float(share)))) \
        .withColumn("_cum", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))) \
        .withColumn("_before", F.col("_cum") - F.col("_c"))
    edge = hist.where((F.col("_before") < F.col("_take")) & (F.col("_cum") >= F.col("_take"))).select("_b", "_before", "_take")
    # Only the keys of the one bucket holding the cut are ranked.
    cand = k.join(F.broadcast(edge), "_b")
    wr = Window.partitionBy("_b").orderBy("_h", key)
    return (cand.withColumn("_r", F.row_number().over(wr))
            .where(F.col("_before") + F.col("_r") == F.col("_take"))
            .select("_h", F.col(key).alias("_k")))


def in_sample(key: Column, cutoff: DataFrame, seed: str) -> Column:
    """Predicate: ``key`` is in the sample whose cutoff is ``cutoff``."""
    cut = cutoff.select(F.struct("_h", "_k").alias("c")).scalar()
    h = hash_order(key, seed)
    return key.isNotNull() & ((h < cut["_h"]) | ((h == cut["_h"]) & (key.cast("string") <= cut["_k"])))


def sample_keys(df: DataFrame, key: str, share: float, seed: str) -> DataFrame:
    """The sampled distinct keys (one column ``key``)."""
    cutoff = sample_cutoff(df, key, share, seed)
    return df.select(key).distinct().where(in_sample(F.col(key), cutoff, seed))
