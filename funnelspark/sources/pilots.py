"""Pilot dimension (S5): one row per pilot run of a state agency."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Pilot
from ..operators.lookup import DEFAULT_BROADCAST_MAX_ROWS, bounded_broadcast

PILOT_SCHEMA = T.StructType(
    [
        T.StructField("state", T.StringType()),
        T.StructField("client_agency", T.StringType()),
        T.StructField("pilot", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
    ]
)


def pilot_frame(spark: SparkSession, pilots: Iterable[Pilot]) -> DataFrame:
    """The calendar from literal rows: its size is known, so it is marked for
    broadcast."""
    rows = [(p.state, p.client_agency, p.pilot, p.start_date, p.end_date) for p in pilots]
    return F.broadcast(spark.createDataFrame(rows, PILOT_SCHEMA))


def read_pilots(spark: SparkSession, path: str, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """The calendar from storage: broadcast only after its row count is checked
    (a calendar over the limit is joined by shuffle instead)."""
    return bounded_broadcast(spark.read.schema(PILOT_SCHEMA).parquet(path), max_rows)
