"""Pilot-versus-pilot weekly dashboard tables, C8-C14.

Input: the normalised event log annotated with ``pilot``/``pilot_wk``
(:func:`funnelspark.plans.periods.add_pilot_week`).  The latest pilot, the
previous pilot of the same state and the latest week reached are one scalar
subquery over that log, evaluated once per query on the cluster.

Only the latest pilot and its immediate predecessor are compared (Q10): rows of
older pilots, or of no pilot, do not enter the curr/prior pivots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import Params
from ..functions import labels as L
from ..functions.nulls import fill_null, n_distinct_keep_null, ratio
from ..functions.text import initiation_label
from ..operators.keys import join_null_safe
from ..operators.lookup import recode, step_frame
from ..operators.quantiles import quantiles
from ..operators.reshape import long_to_wide, wide_to_long
from ..operators.window_ops import fill_updown
from .periods import with_cumulative_week
from .report import direction, rename_steps

WEEK_KEYS = ["pilot_state", "pilot", "pilot_wk"]
ROLES = tuple(dict.fromkeys(to for _, to in C.WEEKLY_LOOKUP))


class PilotContext:
    """Scalar facts of a run as plan expressions (no driver action).

    The latest pilot is the one that started last among the pilots that have
    events (equal starts: the larger name, then state), not the one of the last
    event: an older pilot may still be running.  Its state, the latest week its
    events reach, and the pilot before it in its state come from the same scalar
    subquery: a few rows per pilot, joined to the calendar."""

    def __init__(self, events: DataFrame, pilots: DataFrame, *, present: DataFrame | None = None):
        """``present``: pilot, pilot_state and the last week of those that have
        events, if known already."""
        if present is None:
            present = (events.where(F.col("pilot").isNotNull()).groupBy("pilot", "pilot_state")
                       .agg(F.max("pilot_wk").alias("week")))
        w = Window.partitionBy("state").orderBy("start_date", "pilot")
        cal = pilots.select(F.col("state").alias("_c_state"), F.col("pilot").alias("_c_pilot"),
                            "start_date", F.lag("pilot").over(w).alias("prior"))
        facts = present.join(cal, (F.col("pilot") == F.col("_c_pilot")) & (F.col("pilot_state") == F.col("_c_state")))
        one = facts.agg(F.max_by(
            F.struct(F.col("pilot").alias("latest"), F.col("pilot_state").alias("state"), "week", "prior"),
            F.struct("start_date", "pilot", "pilot_state")).alias("f")).scalar()
        self.latest: Column = one.getField("latest")
        self.state: Column = one.getField("state")
        self.week: Column = one.getField("week")
        self.prior: Column = one.getField("prior")

    def relation(self, pilot: Column) -> Column:
        return F.when(pilot == self.latest, F.lit("curr")).when(pilot == self.prior, F.lit("prior"))


def cumulative(events: DataFrame, ctx: PilotContext) -> DataFrame:
    return with_cumulative_week(events, ctx.week)


# -- C8 ------------------------------------------------------------------------
def weekly_events_applicants(events: DataFrame, ctx: PilotContext) -> DataFrame:
    """Per pilot x week x denominator (distinct applicants / events): one
    column per event role, 0 where a role did not occur."""
    ev = cumulative(events, ctx)
    froms = [f for f, _ in C.WEEKLY_LOOKUP]
    ev = ev.where(F.col("event").isin(froms)).withColumn("event_ban", recode("event", C.WEEKLY_LOOKUP))
    agg = ev.groupBy(*WEEK_KEYS, "event_ban").agg(
        n_distinct_keep_null("distinct_id").alias("applicants"), F.count("*").alias("events"))
    long = agg.unpivot([*WEEK_KEYS, "event_ban"], ["applicants", "events"], "denom", "value")
    wide = long_to_wide(long, [*WEEK_KEYS, "denom"], "event_ban", "value", ROLES, fill=0)
    return wide.select(*WEEK_KEYS, "denom", *[F.col(r).cast("bigint").alias(r) for r in ROLES])


# -- C9 ------------------------------------------------------------------------
def multi_employer(events: DataFrame, ctx: PilotContext) -> DataFrame:
    """Applicants who synced more than one distinct employer, per pilot week
    (missing employer names count as one "[not captured]" employer).  Weeks
    where nobody qualifies are absent (their value is NULL after the join)."""
    ev = cumulative(events, ctx).where(F.col("event") == C.FINISHED_SYNC)
    ev = ev.withColumn("employer_name", fill_null("employer_name", C.NOT_CAPTURED))
    return multi_employer_of_pairs(ev.select(*WEEK_KEYS, "distinct_id", "employer_name").distinct())


def multi_employer_of_pairs(pairs: DataFrame) -> DataFrame:
    """C9 from the distinct (person, employer) pairs of each pilot week."""
    per_person = pairs.groupBy(*WEEK_KEYS, "distinct_id").agg(F.count("*").alias("submissions"))
    return (per_person.where(F.col("submissions") > 1).groupBy(*WEEK_KEYS)
            .agg(F.count("*").alias("multi_employers"))
            .select(*WEEK_KEYS, F.lit("applicants").alias("denom"), "multi_employers"))


KPI_COUNTS = {"started": "n_started", "error": "n_error", "help": "n_help", "invitation": "n_invitation",
              "copied_invite": "n_copied_invite", "multi_employers": "n_multi_employers"}
KPI_SHARES = ("share_complete", "share_tokenized", "share_search_missing", "share_login_success")
KPI_METRICS = tuple(KPI_COUNTS.values()) + KPI_SHARES


def weekly_measures(events: DataFrame, ctx: PilotContext) -> DataFrame:
    """C8 before the curr/prior comparison: counts and shares per pilot week."""
    return measures(weekly_events_applicants(events, ctx), multi_employer(events, ctx))


def measures(wide: DataFrame, multi: DataFrame) -> DataFrame:
    """Counts and shares from the counts by role and the multi-employer persons."""
    # ``multi`` has at most one row per (state, pilot, week): bounded by the pilot
    # calendar times the weeks of a pilot, so it is broadcast.
    j = join_null_safe(wide, F.broadcast(multi), [*WEEK_KEYS, "denom"], "left")
    c = F.col
    shares = {
        "share_complete": ratio("completed", "started"),
        "share_tokenized": ratio("initiation_token",
                                 c("initiation_generic") + c("initiation_generic_restart") + c("initiation_token")),
        "share_search_missing": ratio("search_missing", "search"),
        "share_login_success": ratio("login_success", "login_attempt"),
    }
    return j.select(*WEEK_KEYS, "denom", *[c(k).alias(v) for k, v in KPI_COUNTS.items()],
                    *[e.alias(k) for k, e in shares.items()])


def weekly_kpi(events: DataFrame, ctx: PilotContext) -> DataFrame:
    """One row per state x week x denominator x metric: latest pilot (curr)
    against the previous pilot (prior), absolute and relative change, labels."""
    return compare_pilots(weekly_measures(events, ctx), ctx)


def compare_pilots(measured: DataFrame, ctx: PilotContext) -> DataFrame:
    """The weekly measures of the latest pilot against those of the one before."""
    m = measured.withColumn("pilot_rel", ctx.relation(F.col("pilot")))
    m = m.where(F.col("pilot_rel").isNotNull()).drop("pilot")
    long = wide_to_long(m, ["pilot_state", "pilot_wk", "denom", "pilot_rel"], KPI_METRICS)
    wide = long_to_wide(long, ["pilot_state", "pilot_wk", "denom", "metric"], "pilot_rel", "value",
                        ["curr", "prior"])
    curr, prior, metric = F.col("curr"), F.col("prior"), F.col("metric")
    wide = wide.withColumn("delta", curr - prior).withColumn("delta_pct", F.try_divide(F.col("delta"), prior))
    is_count = metric.startswith("n_")
    d, dp = F.col("delta"), F.col("delta_pct")
    text = (F.when(prior.isNull(), F.lit(C.NO_PRIOR))
            .when(curr.isNull(), F.lit(None))
            .when(dp.between(-0.005, 0.005), F.lit(C.NO_CHANGE))
            .when(is_count, F.concat(L.comma(F.abs(d)), F.lit(" from last run")))
            .when(metric.startswith("share_"), F.concat(L.pct(F.abs(d)), F.lit(" points from last run")))
            .otherwise(F.lit(C.NO_CHANGE)))
    return wide.select(
        "pilot_state", "pilot_wk", "denom", "metric", "curr", "prior", "delta", "delta_pct",
        F.when(is_count, L.comma(curr)).otherwise(L.pct(curr)).alias("val_fmt"),
        direction(d).alias("direction"), text.alias("text_fmt"))


# -- C10 -----------------------------------------------------------------------
def flow_filled(events: DataFrame) -> DataFrame:
    """Initiation label, then device / origin / initiation filled across each
    (person, flow) in time order (before the cumulative copies are added, Q13)."""
    ev = events.withColumn("initiation", initiation_label(F.col("event")))
    ev = fill_updown(ev, ["distinct_id", "cbv_flow_id"], [F.col("timestamp"), F.col("event_id")], ["device_type", "origin", "initiation"])
    ev = ev.withColumns({c: fill_null(c, "unknown") for c in ("device_type", "origin", "initiation")})
    return ev.withColumn("device_type", F.when(F.col("device_type").isin(list(C.DEVICE_KEEP)), F.col("device_type"))
                         .otherwise(F.lit("other")))


def device_mix(events: DataFrame, ctx: PilotContext) -> DataFrame:
    """Per pilot week and device: flows started / completed, completion rate,
    share of starts, and the label text for phones and desktops."""
    ev = with_cumulative_week(flow_filled(events), ctx.week)
    ev = ev.where(F.col("event").isin(C.VIEWED_AGREEMENT, C.SHARED_INCOME_SUMMARY))
    ev = ev.withColumn("started", (F.col("event") == C.VIEWED_AGREEMENT).cast("long")) \
           .withColumn("completed", (F.col("event") == C.SHARED_INCOME_SUMMARY).cast("long"))
    flows = ev.groupBy("pilot", "pilot_wk", "distinct_id", "cbv_flow_id", "device_type", "origin", "initiation") \
        .agg(F.sum("started").alias("started"), F.sum("completed").alias("completed"))
    weekly = flows.groupBy("pilot", "pilot_wk", "device_type").agg(
        F.sum("started").cast("bigint").alias("started"), F.sum("completed").cast("bigint").alias("completed"))
    # The weekly table has a handful of rows per (pilot, week): the share window is tiny.
    w = Window.partitionBy("pilot", "pilot_wk")
    weekly = weekly.withColumn("completion_rate", ratio("completed", "started")) \
                   .withColumn("share", ratio("started", F.sum("started").over(w)))
    dev = F.col("device_type")
    lab = F.when(dev.isin("smartphone", "desktop"), F.concat(
        L.sentence_case(dev), F.lit("\ndevice share: "), L.pct("share"),
        F.lit("\ncompletion rate: "), L.pct("completion_rate")))
    order = F.array_position(F.array(*[F.lit(x) for x in C.DEVICE_ORDER]), dev).cast("int")
    return weekly.select("pilot", "pilot_wk", "device_type", order.alias("device_order"), "started", "completed",
                         "completion_rate", "share", L.pct("completion_rate").alias("completion_rate_fmt"),
                         L.pct("share").alias("share_fmt"), lab.alias("lab_share"))


# -- C11 -----------------------------------------------------------------------
def duration_stats(events: DataFrame, ctx: PilotContext, approx: bool = False) -> DataFrame:
    """Five-number summary and count of sync seconds and minutes-to-complete
    per pilot, week, metric and employment type (exact, interpolated)."""
    ev = cumulative(events, ctx).where(F.col("event").isin(C.FINISHED_SYNC, C.SHARED_INCOME_SUMMARY))
    keys = ["pilot", "pilot_wk", "employment_type"]
    long = wide_to_long(ev.select(*keys, "sync_duration_seconds", "flow_started_minutes_ago"), keys,
                        ["sync_duration_seconds", "flow_started_minutes_ago"], drop_null=True)
    return quantiles(long, ["pilot", "pilot_wk", "metric", "employment_type"], "value",
                     {"q25": 0.25, "median": 0.5, "q75": 0.75}, approx=approx)


# -- C12 -----------------------------------------------------------------------
def weekly_funnel(events: DataFrame, ctx: PilotContext, params: Params) -> DataFrame:
    """Funnel per week for the latest (curr) and previous (prior) pilot, with
    the loss between consecutive steps of the current pilot."""
    spark = events.sparkSession
    ev = cumulative(events, ctx).where(F.col("event").isin(list(params.key_events)))
    reached = ev.select("pilot", "pilot_wk", "distinct_id", "event").distinct()
    steps = step_frame(spark, params.key_events, params.event_dictionary)
    rel = reached.join(steps, "event").withColumn("pilot_rel", ctx.relation(F.col("pilot"))) \
        .where(F.col("pilot_rel").isNotNull())
    return funnel_of_counts(rel.groupBy("pilot_rel", "pilot_wk", "event_clean", "step_order").agg(F.count("*").alias("n")))


def funnel_of_counts(counts: DataFrame) -> DataFrame:
    """C12 from the persons of each pilot (curr, prior), week and step."""
    wide = long_to_wide(counts, ["pilot_wk", "event_clean", "step_order"], "pilot_rel", "n", ["curr", "prior"])
    # Steps only the prior pilot reached sort after the current pilot's steps (Q9).
    w = Window.partitionBy("pilot_wk").orderBy(F.col("curr").isNull(), "step_order")
    wide = wide.withColumn("curr_lag", F.lag("curr").over(w))
    return wide.select("pilot_wk", rename_steps(F.col("event_clean")).alias("event_clean"), "step_order",
                       F.col("curr").cast("bigint").alias("curr"), F.col("prior").cast("bigint").alias("prior"),
                       F.col("curr_lag").cast("bigint").alias("curr_lag"),
                       L.pct(ratio("curr", "curr_lag") - 1).alias("loss_share"))


# -- C13 -----------------------------------------------------------------------
def initiations_daily(events: DataFrame, ctx: PilotContext) -> DataFrame:
    """Verifications started per day in weeks 1..latest week of every pilot,
    with the week total and its label."""
    ev = events.where(F.col("pilot_wk").between(F.lit(1), ctx.week) & (F.col("event") == C.VIEWED_AGREEMENT))
    daily = ev.groupBy("pilot", "pilot_wk", F.to_date("timestamp").alias("day")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("pilot", "pilot_wk")
    daily = daily.withColumn("week_total", F.sum("n").over(w).cast("bigint"))
    return daily.select(
        "pilot", "pilot_wk", "day", "n", "week_total",
        (F.col("pilot_wk") == ctx.week).alias("is_latest_week"),
        F.concat(F.lit("Week "), F.col("pilot_wk").cast("string"), F.lit(" [n = "),
                 L.short_scale("week_total", 1, unscaled_digits=0), F.lit("]")).alias("week_label"))


def initiations_daily_total(events: DataFrame, ctx: PilotContext) -> DataFrame:
    """Starts per pilot over the same weeks, and the "N cum. in <pilot>" text."""
    d = initiations_daily(events, ctx)
    per = d.groupBy("pilot").agg(F.sum("n").cast("bigint").alias("n"))
    return per.select("pilot", "n", F.concat(L.short_scale("n", 0), F.lit(" cum. in "),
                                             F.col("pilot")).alias("pilot_cum"))


def initiations_caption(events: DataFrame, ctx: PilotContext) -> DataFrame:
    """The per-pilot texts joined with " vs. " in pilot order."""
    t = initiations_daily_total(events, ctx)
    return t.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pilot", "pilot_cum"))),
                                          lambda x: x["pilot_cum"]), " vs. ").alias("caption"))


# -- C14 -----------------------------------------------------------------------
def submission_share(events: DataFrame, ctx: PilotContext) -> DataFrame:
    """Latest pilot to date (weeks > 0): applicants / events that started and
    completed, and completed / started."""
    ev = cumulative(events, ctx).where(
        (F.col("pilot") == ctx.latest) & (F.col("pilot_wk") > 0) &
        F.col("event").isin(C.VIEWED_AGREEMENT, C.SHARED_INCOME_SUMMARY))
    agg = ev.groupBy("pilot", "event").agg(n_distinct_keep_null("distinct_id").alias("applicants"),
                                           F.count("*").alias("events"))
    long = agg.unpivot(["pilot", "event"], ["applicants", "events"], "denom", "value")
    names = [C.VIEWED_AGREEMENT, C.SHARED_INCOME_SUMMARY]
    wide = long_to_wide(long, ["pilot", "denom"], "event", "value", names, fill=0)
    return wide.select("pilot", "denom", *[F.col(n).cast("bigint").alias(n) for n in names],
                       ratio(C.SHARED_INCOME_SUMMARY, C.VIEWED_AGREEMENT).alias("share"))
