"""Adapter from the generic ``events`` table of the test data
(``event_id, ts, user_id, event_type, value, props``) to the analytics event
log the metrics read.  The mapping is documented in FIXTURES.md §4 and is
mirrored, expression for expression, by the SQL in :mod:`funnelspark.oracle`.

It is a pure projection (no shuffle): at scale it runs inside the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CASEWORKER_INVITED, FINISHED_SYNC, SEARCHED_EMPLOYER, SHARED_INCOME_SUMMARY

# --- fixed values: how the synthetic generator's codes map to event names ----
SIGNUP_EVENTS = ((20, "ClickedCBVInvitationLink"), (35, "ClickedGenericLink"),
                 (40, "RestartedWithGenericLinkOnTimeout"), (50, None), (None, "ViewedAgreement"))
VIEW_EVENTS = ((60, "SearchedForEmployer"), (75, "AccessedMissingResultsPage"),
               (None, "SelectedEmployerOrPlatformItem"))
CLICK_EVENTS = ((30, "AttemptedLogin"), (50, "SucceededWithLogin"), (60, "OpenedHelpModal"),
                (70, "ViewedHelpTopic"), (75, "ViewedHelpText"), (85, "BeganLinkingEmployer"),
                (None, "CopiedInvitationLink"))
PURCHASE_EVENTS = ((50, "FinishedSync"), (None, "SharedIncomeSummary"))
SEARCH_TEXTS = ("  The  Red-Plate, Inc. ", "red plate", "Hot Ring LLC", "hot   ring", "Wal-Mart", "The Co")
TEST_STATE = "Testland"


def _ladder(k: Column, steps) -> Column:
    out = None
    for bound, name in steps:
        label = F.lit(CASEWORKER_INVITED if name is None else "Applicant" + name)
        if bound is None:
            return out.otherwise(label) if out is not None else label
        out = F.when(k < bound, label) if out is None else out.when(k < bound, label)
    return out


def adapt_driver_events(raw: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    et = F.col("event_type")
    event = (F.when(et == "signup", _ladder(k, SIGNUP_EVENTS))
             .when(et == "view", _ladder(k, VIEW_EVENTS))
             .when(et == "click", _ladder(k, CLICK_EVENTS))
             .when(et == "purchase", _ladder(k, PURCHASE_EVENTS))
             .when(et == "error", F.lit("ApplicantEncounteredError")))
    staged = raw.select(
        "event_id", F.col("ts").alias("timestamp"), "user_id", "value", k.alias("_k"), event.alias("event"))
    k = F.col("_k")
    ev = F.col("event")
    search_text = F.element_at(F.array(*[F.lit(s) for s in SEARCH_TEXTS]), (k % 6 + 1).cast("int"))
    return staged.select(
        "event_id",
        "event",
        "timestamp",
        F.when(k != 99, F.col("user_id").cast("string")).alias("distinct_id"),
        F.when((k != 99) & (ev != CASEWORKER_INVITED),
               F.col("user_id") * 100 + F.floor((F.dayofmonth("timestamp") - 1) / F.lit(7.0))
               ).cast("bigint").alias("cbv_flow_id"),
        F.lit(TEST_STATE).alias("pilot_state"),
        F.when(k % 4 == 1, "smartphone").when(k % 4 == 2, "desktop").when(k % 4 == 3, "tablet").alias("device_type"),
        F.when(k % 3 == 1, "sms").when(k % 3 == 2, "email").alias("origin"),
        F.when(k % 5 == 0, "gig").when(k % 5 < 4, "w2").alias("employment_type"),
        F.when((ev == FINISHED_SYNC) & (k % 4 != 0), F.concat(F.lit("Employer "), (k % 7).cast("string"))
               ).alias("employer_name"),
        F.when(ev == SEARCHED_EMPLOYER, search_text).alias("query"),
        F.when(ev == FINISHED_SYNC, F.col("value")).alias("sync_duration_seconds"),
        F.when(ev == SHARED_INCOME_SUMMARY, F.col("value") * 60).alias("flow_started_seconds_ago"),
    )


def read_driver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
