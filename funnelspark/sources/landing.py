"""Landing of the test data, the way production data arrives.

In production the analytics export arrives as line-delimited JSON files and is
landed as a Parquet event table partitioned by agency and day
(:func:`funnelspark.sources.tables.land_events`); every report reads the landed
table.  The test data instead holds one generic ``events`` table, so for each
data folder this module derives, once per Spark application:

* ``export_dir``: the export files (NDJSON, one object per event) written from
  ``events`` through the adapter -- read back by the JSON-scan queries;
* ``event_log``: the normalised event log, landed by ``land_events`` -- read by
  every metric, which puts its day bounds on the scan.

Both live under the shared checkpoint folder (on a local master without one, in
a temporary folder) and are keyed by the source's length and modification time.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TEST_AGENCY
from ..session import ensure_checkpoint_dir, file_stamp, shared_table_path
from .driver_events import adapt_driver_events, read_driver_events
from .export import normalise, to_export_lines
from .tables import land_events

_LOCK = threading.RLock()  # what is made may need what was made before
_MEMO: dict[tuple, str] = {}


def _key(spark: SparkSession, sf_dir: str, kind: str) -> tuple:
    src = f"{sf_dir.rstrip('/')}/events.parquet"
    return (spark.sparkContext.applicationId, src, file_stamp(spark, src), kind)


def _landed(spark: SparkSession, sf_dir: str, kind: str, build) -> str:
    key = _key(spark, sf_dir, kind)
    with _LOCK:
        path = _MEMO.get(key)
        if path is None or file_stamp(spark, path) is None:
            ensure_checkpoint_dir(spark)
            path = shared_table_path(spark, f"landing-{kind}")
            build(path)
            _MEMO[key] = path
        return path


def export_dir(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        lines = to_export_lines(adapt_driver_events(read_driver_events(spark, sf_dir)))
        lines.write.mode("overwrite").text(path)
    return _landed(spark, sf_dir, "export", build)


def export_by_day(spark: SparkSession, sf_dir: str) -> str:
    """The export files by agency and day, as a source delivers them on request."""
    def build(path: str) -> None:
        events = adapt_driver_events(read_driver_events(spark, sf_dir))
        lines = to_export_lines(events, [F.lit(TEST_AGENCY).alias("agency"), F.to_date("timestamp").alias("day")])
        lines.write.partitionBy("agency", "day").text(path)
    return _landed(spark, sf_dir, "export-by-day", build)


def derived(spark: SparkSession, sf_dir: str, kind: str, build) -> str:
    """Folder of a table that ``build(path)`` makes from the landed data, made once."""
    return _landed(spark, sf_dir, kind, build)


def event_log_path(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        land_events(normalise(adapt_driver_events(read_driver_events(spark, sf_dir))), path, TEST_AGENCY)
    return _landed(spark, sf_dir, "log", build)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(event_log_path(spark, sf_dir))
