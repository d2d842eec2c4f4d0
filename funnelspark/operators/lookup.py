"""Small-table joins: literal lookups, dictionaries, dimensions.

A side is broadcast only when its size is bounded: literal tables have a length
known on the driver; a dimension read from storage is counted first (one cheap
aggregate on a small table) and joined by shuffle if it is over the limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_MAX_ROWS = 100_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, *,
                      known_rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows.

    ``known_rows`` skips the count for frames built from driver-side literals."""
    n = known_rows if known_rows is not None else df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def literal_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A lookup built from literal rows, already marked for broadcast (its size
    is the length of ``rows``, fixed in code)."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def recode(col: Column | str, pairs: Sequence[tuple[str, str]]) -> Column:
    """``from -> to`` recode as one map-literal lookup; unmatched values give
    NULL (J2/X3).  For a few dozen pairs a map literal is cheaper than a join."""
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[F.lit(x) for kv in dict(pairs).items() for x in kv])
    return F.try_element_at(m, c)


def step_frame(spark: SparkSession, key_events: Sequence[str], dictionary: Sequence[tuple[str, str]]) -> DataFrame:
    """Funnel steps: ``event, event_clean, step_order``; step order is the
    position of the readable name among the key events' readable names (O4)."""
    names = dict(dictionary)
    clean_levels: list[str] = []
    for e in key_events:
        c = names.get(e)
        if c is not None and c not in clean_levels:
            clean_levels.append(c)
    rows = [(e, names.get(e), clean_levels.index(names[e]) + 1 if names.get(e) in clean_levels else None)
            for e in key_events]
    return literal_frame(spark, rows, "event string, event_clean string, step_order int")
