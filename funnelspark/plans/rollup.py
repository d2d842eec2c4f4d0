"""A pre-aggregate of the event log by day that the report tables share, kept up
to date day by day, with exact distinct counts that merge.

Persons get numbers (``people``: distinct_id, person), consecutive inside each
part of the table, so a set of persons is a few bitmaps of 32,768 bits.  For
each agency, day, state and event the rollup holds

* ``bits``: the number of events, and the bitmap of persons by bucket of their
  numbers (events of nobody in a row without a bucket);
* ``employers``: the distinct (person, employer) pairs of finished syncs;
* ``ledger``: the days that are done.

The persons of any set of days, a week, the weeks so far, or a period, are the
OR of its bitmaps: the cumulative week is made of the weeks and no event is
copied or read again.  :func:`refresh` reads the days that the ledger lacks and
writes them over their partitions, numbering the persons that are new.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import Params
from ..functions.nulls import fill_null, ratio
from ..operators.lookup import recode, step_frame
from ..operators.reshape import long_to_wide
from ..session import written_once
from ..sources.extract import LEDGER, Range, missing_days
from ..sources.tables import DAY, LANDING_PARTITIONS, between_days, day_bounds
from .periods import days_before
from .weekly import ROLES, WEEK_KEYS, PilotContext, compare_pilots, funnel_of_counts, measures, multi_employer_of_pairs

BITS = f"pilot_state string, event string, bucket bigint, bits binary, n_events bigint, client_agency string, {DAY} date"
EMPLOYERS = f"pilot_state string, person bigint, employer_name string, client_agency string, {DAY} date"
PEOPLE = "distinct_id string, person bigint"
#: Numbers of one part of the people's table: monotonically_increasing_id counts from a multiple of it.
PART = 33


def _stored(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    path = f"{root}/{name}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def _number(spark: SparkSession, root: str, persons: DataFrame) -> None:
    """Numbers for the persons that have none yet, above all that are given."""
    known = _stored(spark, root, "people", PEOPLE)
    new = persons.where(F.col("distinct_id").isNotNull()).select("distinct_id").distinct().join(known, "distinct_id", "left_anti")
    last = known.agg(F.max("person")).first()[0]
    start = 0 if last is None else ((last >> PART) + 1) << PART
    new.select("distinct_id", (F.monotonically_increasing_id() + F.lit(start)).alias("person")).write.mode("append").parquet(f"{root}/people")


def _write_days(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LANDING_PARTITIONS).parquet(path))


def refresh(events: DataFrame, root: str, agency: str, *, start: dt.date | None = None, end: dt.date | None = None,
            complete_until: dt.date | None = None) -> list[Range]:
    """Bring the rollup at ``root`` up to the agency's ``events`` (landed, each
    event once) from ``start`` to ``end`` (default: their first and last day).
    Days after ``complete_until`` are made but not entered as done.  Returns the
    ranges of days that were read."""
    spark, root = events.sparkSession, root.rstrip("/")
    first, last = day_bounds(events) if start is None or end is None else (start, end)
    if first is None:
        return []
    made = missing_days(spark, root, agency, start or first, end or last)
    for a, b in made:
        # The log is read here and only here: all that follows reads one row by person (and employer), day and event.
        employer = F.when(F.col("event") == C.FINISHED_SYNC, fill_null("employer_name", C.NOT_CAPTURED)).alias("employer_name")
        days = between_days(events, a, b).withColumn("client_agency", F.lit(agency))
        daily = days.groupBy(*LANDING_PARTITIONS, "pilot_state", "event", "distinct_id", employer).agg(F.count("*").alias("n"))
        with written_once(daily, "rollup-daily") as daily:
            _number(spark, root, daily)
            numbered = daily.join(spark.read.schema(PEOPLE).parquet(f"{root}/people"), "distinct_id", "left")
            person = F.col("person")
            sets = numbered.groupBy("pilot_state", "event", F.bitmap_bucket_number(person).alias("bucket"), *LANDING_PARTITIONS).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position(person)).alias("bits"), F.sum("n").alias("n_events"))
            known = F.when(F.col("bucket").isNotNull(), F.col("bits")).alias("bits")
            _write_days(sets.select("pilot_state", "event", "bucket", known, "n_events", *LANDING_PARTITIONS), f"{root}/bits")
            pairs = numbered.where(F.col("employer_name").isNotNull())
            _write_days(pairs.select("pilot_state", "person", "employer_name", *LANDING_PARTITIONS), f"{root}/employers")
        done = b if complete_until is None else min(b, complete_until)
        row = spark.createDataFrame([(agency, a, done, uuid.uuid4().hex, 0, 0, 0)], LEDGER).where("first_day <= last_day")
        row.coalesce(1).write.mode("append").parquet(f"{root}/ledger")
    return made


def bits(spark: SparkSession, root: str, agency: str) -> DataFrame:
    return _stored(spark, root.rstrip("/"), "bits", BITS).where(F.col("client_agency") == agency)


def employers(spark: SparkSession, root: str, agency: str) -> DataFrame:
    return _stored(spark, root.rstrip("/"), "employers", EMPLOYERS).where(F.col("client_agency") == agency)


def merged(days: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """``keys``, bucket, bits, n_events: the OR of the bitmaps, the sum of the
    events; merges again to coarser keys."""
    return days.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("n_events").alias("n_events"))


def counted(sets: DataFrame, keys: Sequence[str], *, nobody: bool = False) -> DataFrame:
    """``keys``, persons, events of merged sets; with ``nobody`` the events of
    no known person count as those of one more (A6)."""
    known = F.col("bucket").isNotNull()
    persons = F.sum(F.when(known, F.bitmap_count("bits")))
    persons = F.coalesce(persons, F.lit(0)) + (F.max((~known).cast("int")) if nobody else F.lit(0))
    return sets.groupBy(*keys).agg(persons.cast("bigint").alias("persons"), F.sum("n_events").cast("bigint").alias("events"))


def _with_so_far(weeks: DataFrame, ctx: PilotContext, keys: Sequence[str]) -> DataFrame:
    """The weeks and, as week -1, the OR of weeks 1 to the latest."""
    rest = [k for k in keys if k != "pilot_wk"]
    so_far = merged(weeks.where(F.col("pilot_wk").between(F.lit(1), ctx.week)), rest).withColumn("pilot_wk", F.lit(C.CUMULATIVE_WEEK))
    return weeks.unionByName(so_far.select(weeks.columns))


def weekly_events_applicants(days: DataFrame, ctx: PilotContext) -> DataFrame:
    """C8's counts from the rollup's ``bits`` with pilot and week."""
    roles = days.where(F.col("event").isin([e for e, _ in C.WEEKLY_LOOKUP])).withColumn("event_ban", recode("event", C.WEEKLY_LOOKUP))
    keys = [*WEEK_KEYS, "event_ban"]
    agg = counted(_with_so_far(merged(roles, keys), ctx, keys), keys, nobody=True).withColumnRenamed("persons", "applicants")
    long = agg.unpivot(keys, ["applicants", "events"], "denom", "value")
    wide = long_to_wide(long, [*WEEK_KEYS, "denom"], "event_ban", "value", ROLES, fill=0)
    return wide.select(*WEEK_KEYS, "denom", *[F.col(r).cast("bigint").alias(r) for r in ROLES])


def weekly_kpi(days: DataFrame, pairs: DataFrame, ctx: PilotContext) -> DataFrame:
    """C8 from the rollup (``bits`` and ``employers`` with pilot and week)."""
    wk = F.col("pilot_wk")
    weeks = pairs.select(*WEEK_KEYS, F.col("person").cast("string").alias("distinct_id"), "employer_name").distinct()
    so_far = weeks.where(wk.between(F.lit(1), ctx.week)).withColumn("pilot_wk", F.lit(C.CUMULATIVE_WEEK)).distinct()
    multi = multi_employer_of_pairs(weeks.unionByName(so_far))
    return compare_pilots(measures(weekly_events_applicants(days, ctx), multi), ctx)


def weekly_funnel(days: DataFrame, ctx: PilotContext, params: Params) -> DataFrame:
    """C12 from the rollup: persons by step and week."""
    steps = step_frame(days.sparkSession, params.key_events, params.event_dictionary)
    keys = ["pilot", "pilot_wk", "event_clean", "step_order"]
    own = days.where(F.col("event").isin(list(params.key_events))).join(steps, "event")
    own = own.withColumn("pilot_rel", ctx.relation(F.col("pilot"))).where(F.col("pilot_rel").isNotNull())
    sets = _with_so_far(merged(own, ["event", "pilot_rel", *keys]), ctx, ["event", "pilot_rel", *keys])
    # Two events may be one step: their persons are counted apart, as the events are.
    per_event = counted(sets, ["event", "pilot_rel", *keys], nobody=True)
    counts = per_event.groupBy("pilot_rel", "pilot_wk", "event_clean", "step_order").agg(F.sum("persons").alias("n"))
    return funnel_of_counts(counts)


def trend(days: DataFrame, params: Params) -> DataFrame:
    """C5 from the rollup: events by day over the month before the last one."""
    as_of = params.as_of or day_bounds(days)[1]
    own = between_days(days, days_before(as_of, "month", 1) if as_of else None)
    own = own.where(F.col("event").isin([e for e, _ in C.TREND_LOOKUP]))
    return own.groupBy(recode("event", C.TREND_LOOKUP).alias("event"), F.col(DAY).alias("date")).agg(
        F.sum("n_events").cast("bigint").alias("n"))


def submission_share(days: DataFrame, ctx: PilotContext) -> DataFrame:
    """C14 from the rollup: the latest pilot to date."""
    names = [C.VIEWED_AGREEMENT, C.SHARED_INCOME_SUMMARY]
    own = days.where((F.col("pilot") == ctx.latest) & (F.col("pilot_wk") > 0) & F.col("event").isin(names))
    agg = counted(merged(own, ["pilot", "event"]), ["pilot", "event"], nobody=True).withColumnRenamed("persons", "applicants")
    wide = long_to_wide(agg.unpivot(["pilot", "event"], ["applicants", "events"], "denom", "value"), ["pilot", "denom"], "event", "value",
                        names, fill=0)
    return wide.select("pilot", "denom", *[F.col(n).cast("bigint").alias(n) for n in names],
                       ratio(C.SHARED_INCOME_SUMMARY, C.VIEWED_AGREEMENT).alias("share"))
