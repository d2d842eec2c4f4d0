"""Dashboard-ready frames (C16-C18): headline cards, run facts for the
narrative, and labels that carry group sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import Params
from ..functions import labels as L
from ..functions.nulls import filter_out
from ..operators.lookup import literal_frame
from .report import funnel
from .weekly import PilotContext, duration_stats, weekly_funnel, weekly_kpi


def kpi_cards(events: DataFrame, ctx: PilotContext, week: int = C.CUMULATIVE_WEEK) -> DataFrame:
    """The seven headline cards of the dashboard for the shown week (default:
    cumulative), each with its value and change text (J5)."""
    spark = events.sparkSession
    spec = literal_frame(spark, [(d, m, t, i + 1) for i, (d, m, t) in enumerate(C.DASHBOARD_CARDS)],
                         "denom string, metric string, title string, card_order int")
    # One week of the KPI table: at most 2 denominators x 10 metrics rows.
    k = weekly_kpi(events, ctx).where(F.col("pilot_wk") == week)
    return spec.join(F.broadcast(k), ["denom", "metric"], "left").select(
        "card_order", "title", "denom", "metric", "val_fmt", "text_fmt", "direction")


def week_display(ctx: PilotContext, week: int = C.CUMULATIVE_WEEK):
    """"{latest week} (cum.)" when the cumulative week is shown."""
    if week == C.CUMULATIVE_WEEK:
        return F.concat(ctx.week.cast("string"), F.lit(" (cum.)"))
    return F.lit(str(week))


def narrative(events: DataFrame, ctx: PilotContext, week: int = C.CUMULATIVE_WEEK) -> DataFrame:
    """Facts of the header: week shown, state, pilot, invitations sent in that
    week (events, latest pilot only: Q15), prior pilot.  One filtered count."""
    weeks = F.col("pilot_wk").between(F.lit(1), ctx.week) if week == C.CUMULATIVE_WEEK else F.col("pilot_wk") == week
    sent = events.where((F.col("event") == C.CASEWORKER_INVITED) & (F.col("pilot") == ctx.latest) & weeks)
    return sent.agg(F.count("*").alias("invitations")).select(
        week_display(ctx, week).alias("week_disp"), ctx.state.alias("pilot_state"), ctx.latest.alias("pilot_latest"),
        ctx.prior.alias("pilot_prior"), "invitations", L.comma("invitations").alias("invitations_fmt"))


def funnel_labels(events: DataFrame, ctx: PilotContext, params: Params, week: int = C.CUMULATIVE_WEEK) -> DataFrame:
    """Weekly funnel rows of the shown week with "step (n = 1.2K)" labels."""
    f = weekly_funnel(events, ctx, params).where(F.col("pilot_wk") == week)
    return f.select("event_clean", "step_order", "curr", "curr_lag", "loss_share",
                    F.concat(F.col("event_clean"), F.lit(" (n = "), L.short_scale("curr", 1, unscaled_digits=0),
                             F.lit(")")).alias("label"))


def duration_labels(events: DataFrame, ctx: PilotContext, week: int = C.CUMULATIVE_WEEK) -> DataFrame:
    """Group labels of the two duration charts for the shown week:
    "pilot (n = 1,234)" for minutes to complete, "employment type (n = ...)"
    for sync time (rows without employment type left out)."""
    d = duration_stats(events, ctx).where(F.col("pilot_wk") == week)
    done = F.col("metric") == "flow_started_minutes_ago"
    d = filter_out(d, ~done & F.col("employment_type").isNull())
    named = F.when(done, F.col("pilot")).otherwise(F.col("employment_type"))
    return d.select("metric", "pilot", "employment_type", "n", "median",
                    F.concat(named, F.lit(" (n = "), L.comma("n"), F.lit(")")).alias("label"),
                    F.when(done, L.number("median", 1, "m")).otherwise(L.number("median", 0, "s")).alias("median_fmt"))


def report_funnel_labels(events: DataFrame, params: Params) -> DataFrame:
    """Standard-report funnel rows with "step (1.2K)" labels."""
    f = funnel(events, params)
    return f.withColumn("label", F.concat(F.col("event_clean"), F.lit(" ("),
                                          L.short_scale("n", 1, unscaled_digits=0), F.lit(")")))
