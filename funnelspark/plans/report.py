"""Standard (monthly/weekly) report tables, C1-C7.

Every function takes the normalised event log and :class:`Params` and returns
a DataFrame; only the last day's date reaches the driver.  Distinct counts over
one group key (the period) are pre-aggregated to the flow and person level
first, so a multi-distinct aggregate never ``Expand``s the raw rows, and the
final aggregate over two periods is map-side combined.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import Params
from ..functions import labels as L
from ..functions.nulls import filter_out, is_true, not_in, ratio
from ..functions.text import count_label, normalize_search
from ..operators.lookup import recode, step_frame
from ..operators.quantiles import quantiles
from ..operators.reshape import long_to_wide, long_to_wide_periods, wide_to_long
from ..operators.topn import top_n_per_group
from ..operators.window_ops import lead_within
from ..sources.tables import between_days, day_bounds, last_day
from .periods import PERIODS, classify_period, days_before


# -- C1 ------------------------------------------------------------------------
def report_period(events: DataFrame, params: Params) -> DataFrame:
    """First/last event date, start of the last period, and the period text:
    "January 01 - 30" inside one month, "January 10 - February 09" across.  The
    two dates come from the landed table's partitions; no event is read."""
    first, last = day_bounds(events)
    d = events.sparkSession.range(1).select(F.lit(first).cast("date").alias("date_start"), F.lit(last).cast("date").alias("date_end"))
    start, end = F.col("date_start"), F.col("date_end")
    back = F.add_months(end, -1) if params.report_type == "month" else F.date_sub(end, 7)
    same_month = (F.year(start) == F.year(end)) & (F.month(start) == F.month(end))
    head = F.date_format(start, "MMMM dd")
    period = F.when(same_month, F.concat(head, F.lit(" - "), F.date_format(end, "dd"))) \
        .otherwise(F.concat(head, F.lit(" - "), F.date_format(end, "MMMM dd")))
    return d.select("date_start", "date_end", F.greatest(start, back).alias("period_start"), period.alias("period"))


# -- C2 ------------------------------------------------------------------------
def funnel(events: DataFrame, params: Params) -> DataFrame:
    """Users reaching each funnel step in the current period, the previous
    step's count and the loss between them."""
    spark = events.sparkSession
    ev = classify_period(events, params.report_type, within=1)
    ev = ev.where(F.col("event").isin(list(params.key_events)))
    reached = ev.select("pilot", "distinct_id", "event").distinct()
    steps = step_frame(spark, params.key_events, params.event_dictionary)
    counted = (reached.join(steps, "event")
               .groupBy("event_clean", "step_order").agg(F.count("*").alias("n")))
    # At most one row per step: a global window over a handful of rows.
    w = Window.orderBy("step_order")
    out = counted.withColumn("n_lag", F.lag("n").over(w))
    out = out.withColumn("loss_share", L.pct(ratio("n", "n_lag") - 1))
    return out.select(rename_steps(F.col("event_clean")).alias("event_clean"), "step_order", "n", "n_lag",
                      "loss_share")


def rename_steps(c: Column) -> Column:
    out = c
    for old, new in C.STEP_RENAMES:
        out = F.when(c == old, F.lit(new)).otherwise(out)
    return out


# -- C3 ------------------------------------------------------------------------
def period_kpi(events: DataFrame, params: Params) -> DataFrame:
    """Per period: sessions, applicants, completed sessions, median minutes to
    complete, median sync seconds, smartphone share of sessions, gig share of
    completed sessions (Q17: numerator is any gig flow)."""
    ev = classify_period(events, params.report_type, within=2)
    ev = filter_out(ev, F.col("event") == C.CASEWORKER_INVITED)
    completed = F.col("event") == C.SHARED_INCOME_SUMMARY

    # One scan for all counts: rows are first combined per (period, flow,
    # person); each of these then stands once for its flow and once for its
    # person, and flows and persons are counted by one more aggregate.
    flags = {"c": completed, "s": is_true(F.col("device_type") == "smartphone"),
             "g": is_true(F.col("employment_type") == "gig")}
    pairs = ev.groupBy("period", "cbv_flow_id", "distinct_id").agg(
        *[F.max(f.cast("int")).alias(k) for k, f in flags.items()])
    kinds = F.array(F.struct(F.lit("flow").alias("kind"), F.col("cbv_flow_id").cast("string").alias("key")),
                    F.struct(F.lit("person").alias("kind"), F.col("distinct_id").alias("key")))
    units = (pairs.select("period", *flags, F.explode(kinds).alias("_u")).select("period", *flags, "_u.kind", "_u.key")
             .groupBy("period", "kind", "key").agg(*[F.max(k).alias(k) for k in flags]))
    known, flow = F.col("key").isNotNull(), (F.col("kind") == "flow") & F.col("key").isNotNull()
    n_people = (F.approx_count_distinct(F.when(F.col("kind") == "person", F.col("key")), params.approx_rsd)
                if params.approx else F.count_if(known & (F.col("kind") == "person")))
    counts = units.groupBy("period").agg(
        F.count_if(flow).alias("n_sessions"), n_people.alias("n_applicants"),
        *[F.sum(F.when(flow, F.col(k))).cast("bigint").alias(a)
          for k, a in (("c", "n_completed"), ("s", "_smart"), ("g", "_gig"))])
    # Both medians in one quantile pass, keyed by (period, measure).
    timed = ev.select("period", F.when(completed, F.col("flow_started_minutes_ago")).alias("duration_complete"),
                      F.col("sync_duration_seconds").alias("duration_sync"))
    timed = wide_to_long(timed, ["period"], ["duration_complete", "duration_sync"], "measure", "v",
                         drop_null=True)
    med = quantiles(timed, ["period", "measure"], "v", {"median": 0.5}, with_stats=False,
                    approx=params.approx, accuracy=params.approx_accuracy)
    med = long_to_wide(med, ["period"], "measure", "median", ["duration_complete", "duration_sync"])
    # Two rows at most on the right.
    out = counts.join(F.broadcast(med), "period", "left")
    return out.select(
        "period",
        F.coalesce("n_sessions", F.lit(0)).cast("bigint").alias("n_sessions"),
        F.coalesce("n_applicants", F.lit(0)).cast("bigint").alias("n_applicants"),
        F.coalesce("n_completed", F.lit(0)).cast("bigint").alias("n_completed"),
        "duration_complete", "duration_sync",
        ratio(F.coalesce("_smart", F.lit(0)), "n_sessions").alias("share_smartphone"),
        ratio(F.coalesce("_gig", F.lit(0)), "n_completed").alias("share_gig"),
    )


ADDTL_METRICS = tuple(m for m, _ in C.ADDTL_NAMES)


def kpi_table(events: DataFrame, params: Params) -> DataFrame:
    """C3 reshaped: one row per metric, ``curr`` and ``prior`` as numbers
    (prior NULL when the data has no prior period)."""
    k = period_kpi(events, params)
    return long_to_wide_periods(k, ADDTL_METRICS, PERIODS).select(
        "metric", recode("metric", C.ADDTL_NAMES).alias("metric_clean"),
        F.array_position(F.array(*[F.lit(m) for m in ADDTL_METRICS]), F.col("metric")).cast("int")
        .alias("metric_order"), "curr", "prior")


def addtl_label(metric: Column, x: Column) -> Column:
    return (F.when(metric.contains("share"), L.pct(x))
            .when(metric == "duration_complete", L.timespan(x, "mins", 0))
            .when(metric == "duration_sync", L.timespan(x, "secs", 0))
            .otherwise(L.comma(x)))


def kpi_table_fmt(events: DataFrame, params: Params) -> DataFrame:
    """The additional-metrics table as printed: labels for every value."""
    t = kpi_table(events, params)
    m = F.col("metric")
    return t.select("metric", "metric_clean", "metric_order",
                    addtl_label(m, F.col("curr")).alias("curr"), addtl_label(m, F.col("prior")).alias("prior"))


# -- C4 ------------------------------------------------------------------------
BAN_METRICS = ("n_started", "share_completed", "duration_complete", "share_missing_searches")


def ban_values(events: DataFrame, params: Params) -> DataFrame:
    """Per period: distinct starters, completers / starters, median minutes to
    complete, missing-result pages / searches."""
    froms = [f for f, _ in C.BAN_LOOKUP]
    ev = classify_period(events, params.report_type, within=2).where(F.col("event").isin(froms))
    started = F.col("event") == C.VIEWED_AGREEMENT
    completed = F.col("event") == C.SHARED_INCOME_SUMMARY
    # One pass: per (period, person) whether they started / completed and how
    # many searches / missing-result pages; NULL persons count for the event
    # sums only (distinct counts ignore NULL).
    per_person = ev.groupBy("period", "distinct_id").agg(
        F.max(started.cast("int")).alias("s"), F.max(completed.cast("int")).alias("c"),
        F.sum((F.col("event") == C.SEARCHED_EMPLOYER).cast("long")).alias("se"),
        F.sum((F.col("event") == C.MISSING_RESULTS).cast("long")).alias("mi"))
    known = F.col("distinct_id").isNotNull()
    per_period = per_person.groupBy("period").agg(
        F.sum(F.when(known, F.col("s"))).alias("_s"), F.sum(F.when(known, F.col("c"))).alias("_c"),
        F.sum("se").alias("_search"), F.sum("mi").alias("_missing"))
    dur = quantiles(ev.where(completed).select("period", F.col("flow_started_minutes_ago").alias("v")),
                    ["period"], "v", {"duration_complete": 0.5}, with_stats=False,
                    approx=params.approx, accuracy=params.approx_accuracy)
    out = per_period.join(F.broadcast(dur), "period", "left")  # two rows at most
    return out.select(
        "period",
        F.coalesce("_s", F.lit(0)).cast("double").alias("n_started"),
        ratio(F.coalesce("_c", F.lit(0)), "_s").alias("share_completed"),
        "duration_complete",
        ratio("_missing", "_search").alias("share_missing_searches"))


def ban_kpi(events: DataFrame, params: Params) -> DataFrame:
    """Big-number cards: value now, value before, relative change and texts."""
    wide = long_to_wide_periods(ban_values(events, params), BAN_METRICS, PERIODS)
    m, curr = F.col("metric"), F.col("curr")
    delta = F.try_subtract(F.try_divide(curr, F.col("prior")), F.lit(1.0))
    curr_fmt = (F.when(m.contains("share"), L.pct(curr))
                .when(m == "duration_complete", L.number(curr, 1, "m"))
                .otherwise(L.short_scale(curr, 1)))
    d = F.col("delta")
    delta_fmt = (F.when(d.isNull(), F.lit(C.NO_PRIOR))
                 .when(d.between(-0.005, 0.005), F.lit(C.NO_CHANGE))
                 .otherwise(F.concat(L.pct(F.abs(d)), F.lit(f" from last {params.report_type}"))))
    return (wide.withColumn("delta", delta)
            .select("metric",
                    F.array_position(F.array(*[F.lit(x) for x in BAN_METRICS]), m).cast("int").alias("metric_order"),
                    "curr", "prior", "delta",
                    recode(m, C.BAN_LABELS).alias("label"),
                    curr_fmt.alias("curr_fmt"),
                    direction(d).alias("direction"),
                    delta_fmt.alias("delta_fmt")))


def direction(delta: Column) -> Column:
    return F.when(delta > 0, F.lit("up")).when(delta < 0, F.lit("down"))


# -- C5 ------------------------------------------------------------------------
def trend(events: DataFrame, params: Params) -> DataFrame:
    """Daily counts of invitations, starts and completions over the month
    before ``as_of`` (default: the last event date)."""
    as_of = params.as_of or last_day(events)
    if as_of is None:  # no events at all
        as_of = dt.date.max
    since = days_before(as_of, "month", 1)
    froms = [f for f, _ in C.TREND_LOOKUP]
    ev = between_days(events, since).where(
        F.col("event").isin(froms) & (F.col("timestamp") >= F.lit(since).cast("timestamp_ntz")))
    return (ev.groupBy(recode("event", C.TREND_LOOKUP).alias("event"), F.to_date("timestamp").alias("date"))
            .agg(F.count("*").alias("n")))


def weekend_days(events: DataFrame, params: Params) -> DataFrame:
    """Saturdays and Sundays present in the trend."""
    t = trend(events, params)
    return t.select("date").distinct().where(F.dayofweek("date").isin(1, 7)).select(
        "date", F.date_format("date", "EEEE").alias("weekday"))


# -- C6 ------------------------------------------------------------------------
def search_lead(events: DataFrame, params: Params) -> DataFrame:
    """Each employer search with the next event of the same flow (readable
    name) and the normalised search text.

    Order inside a flow: person, time, then "selected employer" before "began
    linking" before any other event, then event name.  Flows with NULL id have
    no meaningful next event (Q7): their searches get a NULL lead."""
    names = params.event_dictionary
    ev = events.where(not_in("event", C.SEARCH_IGNORED_EVENTS))
    ev = ev.withColumn("event_clean", recode("event", names))
    prio = F.coalesce(F.array_position(F.array(*[F.lit(e) for e in C.SEARCH_TIE_PRIORITY]), F.col("event")),
                      F.lit(0))
    prio = F.when(prio == 0, F.lit(len(C.SEARCH_TIE_PRIORITY) + 1)).otherwise(prio)
    ev = ev.withColumn("_prio", prio.cast("int"))
    order = [F.col(c) for c in ("distinct_id", "timestamp", "_prio", "event", "event_id")]
    led = lead_within(ev, "cbv_flow_id", order, "event_clean", "lead_event", keep=F.col("event") == C.SEARCHED_EMPLOYER)
    return led.select("event_id", "distinct_id", "cbv_flow_id", "timestamp", "query", "lead_event",
                      normalize_search(F.col("query")).alias("query_clean"))


def search_outcomes(events: DataFrame, params: Params) -> DataFrame:
    s = search_lead(events, params)
    s = s.withColumn("is_successful", F.col("lead_event") == C.dict_name(params.event_dictionary,
                                                                            C.SELECTED_EMPLOYER))
    return filter_out(s, F.col("is_successful").isNull())


# -- C7 ------------------------------------------------------------------------
def top_searches(events: DataFrame, params: Params) -> DataFrame:
    """Ten most frequent normalised searches that were / were not followed by
    selecting an employer; ties by search text (byte order)."""
    s = search_outcomes(events, params)
    counts = s.groupBy("is_successful", "query_clean").agg(F.count("*").alias("n"))
    top = top_n_per_group(counts, ["is_successful"], [F.col("n").desc(), F.col("query_clean").asc_nulls_last()],
                          params.top_n, rank_col="rank")
    return top.select("is_successful", "query_clean", "n", "rank",
                      count_label(F.col("query_clean"), F.col("n")).alias("event_count"))


def search_line(events: DataFrame, params: Params) -> DataFrame:
    """The two report lines: top searches joined with "; " in rank order."""
    t = top_searches(events, params)
    return t.groupBy("is_successful").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "event_count"))),
                                 lambda x: x["event_count"]), "; ").alias("line"))
