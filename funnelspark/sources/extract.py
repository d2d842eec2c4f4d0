"""Date-ranged, per-agency extract that brings each day once (S4), keeps every
property (S1, P1) and every line it could not read.

An extract is a folder of three tables:

* ``events``: each event with a time once, by agency and day.  ``properties``
  stays whole, as a VARIANT; which keys become columns is
  chosen when it is read (:func:`read_extract`), also keys that nobody named when
  the line was landed.  Only the paths asked for reach the Parquet reader.
* ``quarantine``: the lines that cannot be events, with their file and the reason;
  none is lost or counted as an empty event.
* ``ledger``: one row per finished run and range: agency, first and last day,
  run, events, repeated events left out, quarantined lines (together all lines
  of the range).  Only days in it are done.

:func:`extract` asks the source only for the days that the ledger lacks.  It
writes them over their own partitions, so a run that died half-way, or days
that are not complete yet, are brought again without a trace of the first time;
the ledger's row comes last.  As a day is landed whole, an event that the source
repeats is dropped right there (within day and bucket of its id), and reading
each event once needs no shuffle.  Ledger rows are read after they are merged to the
ranges they cover, so their number is that of the gaps, not of the runs.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .export import CORE_PROPERTIES, REPORT_PROPERTIES, normalise
from .tables import DAY, LANDING_PARTITIONS

Range = tuple[dt.date, dt.date]
#: Gives the export lines of an agency's days: ``value`` (the line), ``source_file``.
Source = Callable[[str, dt.date, dt.date], DataFrame]

LEDGER = "client_agency string, first_day date, last_day date, run_id string, n_events bigint, n_repeated bigint, n_quarantined bigint"
QUARANTINE = "source_file string, reason string, value string, client_agency string, run_id string"
LINE = "event string, properties variant, _broken string"
UNREADABLE, NO_TIME, OTHER_DAY = "unreadable", "no timestamp", "outside the range"


def _table(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    path = f"{root.rstrip('/')}/{name}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    return _table(spark, root, "ledger", LEDGER)


def coverage(runs: DataFrame) -> DataFrame:
    """client_agency, first_day, last_day: the ledger's ranges, merged where they
    overlap or follow each other."""
    w = Window.partitionBy("client_agency").orderBy("first_day", "last_day")
    before = F.max("last_day").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first_day") > F.date_add(before, 1), F.lit(True)).cast("int")
    return (runs.select("client_agency", "first_day", "last_day").distinct().withColumn("_opens", opens)
            .withColumn("_range", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("client_agency", "_range").agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
            .drop("_range"))


def without(wanted: Range, covered: Sequence[Range]) -> list[Range]:
    """The parts of a range of days that no covered range holds, in order."""
    day, (start, end), out = dt.timedelta(days=1), wanted, []
    for a, b in sorted(covered):
        if a > start:
            out.append((start, min(end, a - day)))
        start = max(start, b + day)
        if start > end:
            break
    else:
        out.append((start, end))
    return [(a, b) for a, b in out if a <= b]


def missing_days(spark: SparkSession, root: str, agency: str, start: dt.date, end: dt.date) -> list[Range]:
    """The ranges between two dates (inclusive) still to be extracted."""
    near = ledger(spark, root).where(F.col("client_agency") == agency)
    done = coverage(near).where((F.col("last_day") >= F.lit(start)) & (F.col("first_day") <= F.lit(end)))
    return without((start, end), [(r["first_day"], r["last_day"]) for r in done.collect()])


def property_text(key: str) -> Column:
    """A property as text, from the VARIANT; NULL where it is absent or null."""
    return F.try_variant_get("properties", f"$['{key}']", "string")


def parse_lines(lines: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """event, properties, timestamp, event_date, reason, value, source_file of
    each line; ``reason`` tells why it cannot be an event of these days."""
    parsed = F.from_json("value", LINE, {"columnNameOfCorruptRecord": "_broken"})
    ev = lines.select("value", "source_file", parsed.alias("_e")).select("value", "source_file", "_e.*")
    ev = ev.withColumn("timestamp", property_text(CORE_PROPERTIES["timestamp"]).try_cast("timestamp_ntz"))
    ev = ev.withColumn(DAY, F.to_date("timestamp"))
    blank = F.col("event").isNull() & F.col("properties").isNull()  # an empty line, or an object of neither
    reason = (F.when(F.col("_broken").isNotNull() | blank, UNREADABLE).when(F.col(DAY).isNull(), NO_TIME)
              .when(~F.col(DAY).between(F.lit(start), F.lit(end)), OTHER_DAY))
    return ev.withColumn("reason", reason).drop("_broken")


def _day_files(spark: SparkSession, root: str, agency: str, start: dt.date, end: dt.date) -> dict[str, frozenset[str]]:
    """The data files of each landed day of an agency, by the day's folder."""
    # No quoting: agency codes and dates need none in a folder's name.
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/events/client_agency={agency}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return {}
    days = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory()]
    inside = [d for d in days if str(start) <= d.getName().removeprefix(f"{DAY}=") <= str(end)]
    return {d.toString(): frozenset(f.getPath().getName() for f in fs.listStatus(d)) for d in inside}


def _counted(seen: Observation) -> int:
    try:
        return seen.get["n"]
    except Py4JJavaError:  # a frame known to be empty was planned away, and its count with it
        return 0


def _land(spark: SparkSession, root: str, agency: str, lines: DataFrame, start: dt.date, end: dt.date,
          buckets: int, max_records_per_file: int) -> tuple[str, int, int, int]:
    """Write the lines of a range; run id, events, repeated ones, quarantined lines."""
    run, parsed = uuid.uuid4().hex, parse_lines(lines, start, end)
    good, bad = parsed.where(F.col("reason").isNull()), parsed.where(F.col("reason").isNotNull())
    read, kept, aside = Observation(), Observation(), Observation()
    before = _day_files(spark, root, agency, start, end)
    # A day is spread over its buckets; rows without an id are all kept, each under a number of its own.
    key = property_text(CORE_PROPERTIES["event_id"])
    good = good.observe(read, F.count("*").alias("n")).withColumns({
        "_id": key, "_own": F.when(key.isNull(), F.monotonically_increasing_id()),
        "_bucket": F.pmod(F.xxhash64(F.coalesce(key, F.col("value"))), F.lit(buckets))})
    once = good.repartition(DAY, "_bucket").dropDuplicates([DAY, "_bucket", "_id", "_own"])
    (once.select("event", "properties", "timestamp", "source_file", F.lit(agency).alias("client_agency"), DAY)
     .observe(kept, F.count("*").alias("n")).sortWithinPartitions(DAY, "event", "timestamp")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*LANDING_PARTITIONS).parquet(f"{root}/events"))
    after = _day_files(spark, root, agency, start, end)
    for folder in (d for d, files in before.items() if after.get(d) == files):  # of an unfinished run; no event today
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    (bad.select("source_file", "reason", "value", F.lit(agency).alias("client_agency"), F.lit(run).alias("run_id"))
     .observe(aside, F.count("*").alias("n")).write.mode("append").partitionBy("client_agency", "run_id")
     .parquet(f"{root}/quarantine"))
    n_events = _counted(kept)
    return run, n_events, _counted(read) - n_events, _counted(aside)


def extract(spark: SparkSession, root: str, agency: str, start: dt.date, end: dt.date, source: Source, *,
            complete_until: dt.date | None = None, buckets: int = 16, max_records_per_file: int = 5_000_000) -> list[Range]:
    """Bring the agency's events from ``start`` to ``end`` into the extract at
    ``root``; the source is asked for missing days only.  Days after
    ``complete_until`` (the current one, say) are landed but not entered in the
    ledger, so the next run brings them anew.  ``buckets``: tasks a day is spread
    over (and files of it, at least).  Returns the ranges asked for."""
    root, asked = root.rstrip("/"), missing_days(spark, root, agency, start, end)
    for a, b in asked:
        run, *counts = _land(spark, root, agency, source(agency, a, b), a, b, buckets, max_records_per_file)
        done = b if complete_until is None else min(b, complete_until)
        row = spark.createDataFrame([(agency, a, done, run, *counts)], LEDGER)
        row.where("first_day <= last_day").coalesce(1).write.mode("append").parquet(f"{root}/ledger")
    return asked


def read_extract(spark: SparkSession, root: str, agency: str, start: dt.date, end: dt.date,
                 properties: Mapping[str, str] = REPORT_PROPERTIES, *, applicant_only: bool = False) -> DataFrame:
    """The normalised events of an agency between two dates, with the property
    keys chosen here as columns; each event once, without a shuffle."""
    df = spark.read.parquet(f"{root.rstrip('/')}/events").where(
        (F.col("client_agency") == agency) & F.col(DAY).between(F.lit(start), F.lit(end)))
    if applicant_only:
        df = df.where(F.col("event").startswith("Applicant"))
    keys = {k: v for k, v in {**CORE_PROPERTIES, **properties}.items() if k != "timestamp"}
    return normalise(df.select("event", "timestamp", *[property_text(v).alias(k) for k, v in keys.items()], *LANDING_PARTITIONS))


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """The lines set aside by finished runs: client_agency, run_id, source_file, reason, value."""
    runs = ledger(spark, root).select("run_id").distinct()  # one row a run
    return _table(spark, root, "quarantine", QUARANTINE).join(F.broadcast(runs), "run_id", "left_semi")
