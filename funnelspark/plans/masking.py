"""Masked demo event set (C15): clone a seeded 60% of applicants under new
ids, shift every timestamp far into the future, relabel pilots by the month
of their first shifted date and replace the state name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Params
from ..operators.sample import in_sample, sample_cutoff
from ..sources.tables import DAY
from .weekly import PilotContext

CLONE_SUFFIX = "-c"
CLONE_FLOW_OFFSET = 1_000_000


def _shifted(params: Params, ts: str) -> Column:
    return F.col(ts) + F.expr(f"INTERVAL {params.mask_days} DAY") + F.expr(f"INTERVAL {params.mask_years} YEAR")


def mask_copies(events: DataFrame, params: Params) -> DataFrame:
    """``events`` must carry ``pilot``/``pilot_wk``.  NULL persons are never
    sampled (they are not one applicant)."""
    # The sample is a predicate against a one-row cutoff, and a sampled row is
    # doubled in place: cloning needs no join and no second scan.
    cutoff = sample_cutoff(events, "distinct_id", params.mask_share, params.mask_seed)
    sampled = in_sample(F.col("distinct_id"), cutoff, params.mask_seed)
    both = events.drop(DAY).withColumn(
        "is_copy", F.explode(F.when(sampled, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    copy = F.col("is_copy")

    both = both.withColumns({
        "distinct_id": F.when(copy, F.concat(F.col("distinct_id"), F.lit(CLONE_SUFFIX))).otherwise(F.col("distinct_id")),
        "cbv_flow_id": F.when(copy, F.col("cbv_flow_id") + F.lit(CLONE_FLOW_OFFSET)).otherwise(F.col("cbv_flow_id")),
        "timestamp": _shifted(params, "timestamp")})
    first_day = _by_pilot(events).select("pilot", _masked_day(params, "_first").alias("_label")).withColumn(
        "_label", F.date_format("_label", "MMM yyyy"))
    out = both.join(F.broadcast(first_day), "pilot", "left")
    return out.withColumn("pilot", F.col("_label")).withColumn("pilot_state", F.lit(params.mask_state)).drop("_label")


def _by_pilot(events: DataFrame) -> DataFrame:
    """First and last time and last week of each pilot present: one row for each
    (bounded by the pilot calendar).  The shift of the mask keeps the order of
    times, so these are all that is needed of the masked events."""
    return events.where(F.col("pilot").isNotNull()).groupBy("pilot").agg(
        F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last"), F.max("pilot_wk").alias("_week"))


def _masked_day(params: Params, ts: str) -> Column:
    return F.to_date(_shifted(params, ts))


def masked_context(events: DataFrame, params: Params) -> PilotContext:
    """The run facts of the masked set, from the events before masking.  Its
    calendar has one row per relabelled pilot, starting on its first masked date,
    so pilots order by first appearance (the demo's "first level is the prior
    pilot", Q21)."""
    masked = _by_pilot(events).select(_masked_day(params, "_first").alias("_from"), _masked_day(params, "_last").alias("_to"), "_week")
    cal = masked.groupBy(F.date_format("_from", "MMM yyyy").alias("pilot")).agg(
        F.min("_from").alias("start_date"), F.max("_to").alias("end_date"), F.max("_week").alias("week"))
    cal = cal.withColumns({"state": F.lit(params.mask_state), "client_agency": F.lit(params.agency)})
    present = cal.select("pilot", F.col("state").alias("pilot_state"), "week")
    return PilotContext(events, cal.drop("week"), present=present)
