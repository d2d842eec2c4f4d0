"""Analytics-export scan: line-delimited JSON events with a nested ``properties``
object, flattened to one column per chosen property key.

The schema is built from the property keys the caller asks for, never inferred:
every file (and every mixed batch of files) parses to the same columns, and keys
absent from a file come back NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Property keys that :func:`to_export_lines` writes.  A scan reads whatever keys
# its caller names; these are not a limit on it.
PROPERTY_FIELDS: tuple[str, ...] = (
    "event_id",
    "timestamp",
    "distinct_id",
    "cbv_flow_id",
    "client_agency",
    "pilot_state",
    "provider",
    "device_type",
    "origin",
    "employment_type",
    "employment_employer_name",
    "query",
    "sync_duration_seconds",
    "flow_started_seconds_ago",
)

# Output column -> property key.  The standard report and the weekly dashboard
# pick slightly different keys; both are instances of this mapping.
REPORT_PROPERTIES: dict[str, str] = {
    "sync_duration_seconds": "sync_duration_seconds",
    "flow_started_seconds_ago": "flow_started_seconds_ago",
    "device_type": "device_type",
    "employment_type": "employment_type",
    "employer_name": "employment_employer_name",
    "query": "query",
}
WEEKLY_PROPERTIES: dict[str, str] = {
    "device_type": "device_type",
    "origin": "origin",
    "sync_duration_seconds": "sync_duration_seconds",
    "flow_started_seconds_ago": "flow_started_seconds_ago",
    "employer_name": "employment_employer_name",
    "employment_type": "employment_type",
}

# Columns every event carries regardless of the chosen properties.
CORE_PROPERTIES: dict[str, str] = {
    "event_id": "event_id",
    "timestamp": "timestamp",
    "distinct_id": "distinct_id",
    "cbv_flow_id": "cbv_flow_id",
    "pilot_state": "pilot_state",
}


def export_schema(properties: Mapping[str, str]) -> T.StructType:
    """Read schema of the export for the requested property keys.  All values
    are read as text: the exporter emits numbers as strings in some versions,
    and ids may be any text; numeric keys are converted leniently later."""
    keys = dict.fromkeys([*CORE_PROPERTIES.values(), *properties.values()])
    return T.StructType([
        T.StructField("event", T.StringType()),
        T.StructField("properties", T.StructType([T.StructField(k, T.StringType()) for k in keys])),
    ])


def flatten_export(raw: DataFrame, properties: Mapping[str, str] = REPORT_PROPERTIES, *,
                   drop_prop: bool = True, applicant_only: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Project ``properties.<key>`` to top-level columns (P1/P2) and optionally
    keep applicant events only (S2); ``keep`` names top-level columns carried
    through unchanged.  The event id stays text."""
    cols: list[Column] = [F.col("event"), *[F.col(k) for k in keep]]
    for out, key in {**CORE_PROPERTIES, **properties}.items():
        cols.append(F.col("properties").getField(key).alias(out))
    if not drop_prop:
        cols.append(F.col("properties"))
    df = raw.select(*cols).withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))
    if applicant_only:
        df = df.where(F.col("event").startswith("Applicant"))
    return df


def read_export(spark: SparkSession, paths: str | list[str], properties: Mapping[str, str] = REPORT_PROPERTIES,
                *, drop_prop: bool = True, applicant_only: bool = False, with_source_file: bool = False) -> DataFrame:
    """Scan one file, a directory, or a list of export files (S1/S3); the
    property keys are chosen here, by the caller.

    All files are read with one schema, so a directory read is the union of the
    files.  ``with_source_file`` adds ``source_file`` (the file each event came
    from, from the scan's ``_metadata`` column) for lineage."""
    raw = spark.read.schema(export_schema(properties)).json(paths)
    keep: tuple[str, ...] = ()
    if with_source_file:
        raw = raw.select("*", F.col("_metadata.file_path").alias("source_file"))
        keep = ("source_file",)
    return flatten_export(raw, properties, drop_prop=drop_prop, applicant_only=applicant_only, keep=keep)


def parse_export_lines(lines: DataFrame, properties: Mapping[str, str] = REPORT_PROPERTIES, *,
                       drop_prop: bool = True, applicant_only: bool = False, column: str = "value") -> DataFrame:
    """Same as :func:`read_export` for export lines already in a DataFrame
    (e.g. from a message queue or a text table)."""
    raw = lines.select(F.from_json(F.col(column), export_schema(properties)).alias("_e")).select("_e.*")
    return flatten_export(raw, properties, drop_prop=drop_prop, applicant_only=applicant_only)


def normalise(df: DataFrame) -> DataFrame:
    """Lenient casts and units (P3/P4/P5): flow id to integer, durations to
    numbers (a value that is not a number becomes NULL instead of failing the
    job), seconds-ago to minutes-ago under its new name."""
    out = df
    if "cbv_flow_id" in df.columns:
        out = out.withColumn("cbv_flow_id", F.col("cbv_flow_id").try_cast("bigint"))
    for c in ("sync_duration_seconds", "flow_started_seconds_ago"):
        if c in df.columns:
            out = out.withColumn(c, F.col(c).try_cast("double"))
    if "flow_started_seconds_ago" in out.columns:
        out = out.withColumn("flow_started_seconds_ago", F.col("flow_started_seconds_ago") / F.lit(60.0)) \
                 .withColumnRenamed("flow_started_seconds_ago", "flow_started_minutes_ago")
    return out


def to_export_lines(events: DataFrame, beside: Sequence[Column] = ()) -> DataFrame:
    """Serialise a flat event log back to export lines (one JSON object per
    event); the inverse of :func:`parse_export_lines` for the declared keys.
    ``beside``: columns that stand beside the line."""
    present = [k for k in PROPERTY_FIELDS if k in events.columns or k == "employment_employer_name"]
    fields = []
    for k in present:
        src = "employer_name" if k == "employment_employer_name" else k
        if src not in events.columns:
            continue
        fields.append(F.col(src).cast("string").alias(k))
    return events.select(
        F.to_json(F.struct(F.col("event"), F.struct(*fields).alias("properties"))).alias("value"), *beside
    )
