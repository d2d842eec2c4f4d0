"""Landing table for events and Parquet sinks/sources of the report tables
(S4, S7-S10).

Events land partitioned by ``client_agency`` and ``event_date``: a per-agency,
date-ranged extract then reads only the matching directories (partition
pruning), and the time filter inside them is pushed to the Parquet reader.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "event_date"
LANDING_PARTITIONS = ("client_agency", DAY)


def land_events(events: DataFrame, path: str, agency: str, mode: str = "append",
                max_records_per_file: int = 5_000_000) -> None:
    """Append an event batch to the landing table (one folder per agency/day).

    No shuffle: a day of one agency can be a large share of all rows, so it is
    not gathered into one task.  Each task sorts its own rows by day (one open
    file at a time; inside a day by event and time, so that event filters skip
    row groups) and files are capped in size."""
    out = events.withColumn("client_agency", F.lit(agency)) \
                .withColumn(DAY, F.to_date("timestamp"))
    (out.sortWithinPartitions(*LANDING_PARTITIONS, "event", "timestamp")
        .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*LANDING_PARTITIONS).parquet(path))


def distinct_events(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Each event once: rows that repeat an id are dropped (Q16), whatever the
    age of the export that brought them; rows without an id are all kept (a
    number of their own keeps them apart, and spreads them over the tasks)."""
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return events.withColumn("_own", own).dropDuplicates([key, "_own"]).drop("_own")


def read_landed(spark: SparkSession, path: str, dedupe_key: str | None = "event_id") -> DataFrame:
    """All landed events; overlapping exports repeat events, which
    ``dedupe_key`` keeps once."""
    df = spark.read.parquet(path)
    return distinct_events(df, dedupe_key) if dedupe_key else df


def range_extract(spark: SparkSession, path: str, agency: str, start: dt.date, end: dt.date,
                  dedupe_key: str | None = "event_id") -> DataFrame:
    """Events of one agency between two dates (inclusive): only the folders of
    these days are read, and only their events are de-duplicated."""
    df = spark.read.parquet(path).where(
        (F.col("client_agency") == agency) & F.col(DAY).between(F.lit(start), F.lit(end)))
    return distinct_events(df, dedupe_key) if dedupe_key else df


@contextmanager
def _partitions_only(spark: SparkSession) -> Iterator[None]:
    """Aggregates of partition columns are answered from the table's partitions:
    the optimizer puts their values in place of the scan."""
    name = "spark.sql.optimizer.metadataOnly"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def day_bounds(events: DataFrame) -> tuple[dt.date | None, dt.date | None]:
    """Date of the first and of the last event.  Of a landed table, under
    whatever filter of agency and days the frame has, they come from its
    partitions and no data file is read (a filter on other columns, as the
    pilot's state, does read those); of other frames it is one aggregate."""
    if DAY not in events.columns:
        return tuple(events.agg(F.min(F.to_date("timestamp")), F.max(F.to_date("timestamp"))).first())
    with _partitions_only(events.sparkSession):
        return tuple(events.agg(F.min(DAY), F.max(DAY)).first())


def last_day(events: DataFrame) -> dt.date | None:
    return day_bounds(events)[1]


def between_days(events: DataFrame, start: dt.date | None, end: dt.date | None = None) -> DataFrame:
    """Literal day bounds on the scan (partition pruning); frames without the
    day column are returned as they are, their callers filter by time."""
    if DAY not in events.columns:
        return events
    if start is not None:
        events = events.where(F.col(DAY) >= F.lit(start))
    return events if end is None else events.where(F.col(DAY) <= F.lit(end))


def count_between(events: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """One row: the number of events on the days from ``start`` to ``end``."""
    inside = between_days(events, start, end).where(F.to_date("timestamp").between(F.lit(start), F.lit(end)))
    return inside.agg(F.count("*").alias("n_events"))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
