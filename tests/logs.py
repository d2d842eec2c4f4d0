"""Event logs of hand-made rows."""

import datetime as dt

from pyspark.sql import types as T

LOG_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("distinct_id", T.StringType()),
    T.StructField("cbv_flow_id", T.LongType()),
    T.StructField("pilot_state", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("employment_type", T.StringType()),
    T.StructField("employer_name", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("sync_duration_seconds", T.DoubleType()),
    T.StructField("flow_started_minutes_ago", T.DoubleType()),
])


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def make_log(spark, rows):
    """Rows are dicts; missing keys are NULL; ``event_id`` defaults to position."""
    names = [f.name for f in LOG_SCHEMA.fields]
    data = []
    for i, r in enumerate(rows):
        r = dict(r)
        r.setdefault("event_id", i)
        r.setdefault("pilot_state", "Testland")
        if isinstance(r.get("timestamp"), str):
            r["timestamp"] = ts(r["timestamp"])
        data.append(tuple(r.get(n) for n in names))
    return spark.createDataFrame(data, LOG_SCHEMA)
