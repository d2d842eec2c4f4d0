"""Registered queries: one per operator / metric of the survey's inventory.

Each takes ``(spark, sf_dir)`` and reads the test data's ``events`` table.  The
table is landed once per application (:mod:`funnelspark.sources.landing`): as
export files for the scan queries and as a Parquet event log, partitioned by
agency and day, for the metrics.  While a frame is built, only the first and last
day are read, from the table's partitions.  ``roundtrip_parquet`` and
``stream_ingest`` write a table in the shared folder and read it back, because
writing is what they show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import config as C
from .config import Params
from .functions import labels as L
from .functions.nulls import filter_out
from .functions.text import initiation_label, normalize_search
from .operators.lookup import recode
from .plans import frames, masking, periods, report, rollup, runs, weekly
from .session import ensure_checkpoint_dir, shared_table_path
from .sources import extract, landing, publish, tables
from .sources.export import REPORT_PROPERTIES, WEEKLY_PROPERTIES, normalise, read_export
from .sources.pilots import pilot_frame

Query = Callable[[SparkSession, str], DataFrame]

MONTH = Params(pilots=C.TEST_PILOTS, report_type="month")
#: The tables of the two runs.
PUBLISHED = ("report_period", "report_dropoff", "report_addtl", "report_ban", "report_trend", "report_searches",
             "wkly_ban", "wkly_device_origin", "wkly_duration", "wkly_dropoff")
WEEK = Params(pilots=C.TEST_PILOTS, report_type="week")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.event_log(spark, sf_dir)


def _piloted(spark: SparkSession, sf_dir: str, params: Params = MONTH) -> DataFrame:
    return periods.add_pilot_week(_log(spark, sf_dir), params.pilots)


def _ctx(spark: SparkSession, sf_dir: str, params: Params = MONTH, pilots_only: bool = False
         ) -> tuple[DataFrame, weekly.PilotContext]:
    """The piloted log and its facts; ``pilots_only`` for tables that leave out
    events of no pilot, which then read the calendar's days only."""
    ev = _piloted(spark, sf_dir, params)
    pil = pilot_frame(spark, params.pilots)
    during = periods.during_pilots(ev, params.pilots)
    return (during if pilots_only else ev), weekly.PilotContext(during, pil)


def _export(spark: SparkSession, sf_dir: str, properties, **kw) -> DataFrame:
    """Scan the landed export files (S1/S3) with the chosen property keys."""
    return read_export(spark, landing.export_dir(spark, sf_dir), properties, **kw)


# -- sources / projections -------------------------------------------------------
def q_scan_props(spark, sf_dir):
    ev = normalise(_export(spark, sf_dir, REPORT_PROPERTIES))
    return ev.select("event_id", "event", "timestamp", "distinct_id", "cbv_flow_id", "pilot_state",
                     "sync_duration_seconds", "flow_started_minutes_ago", "device_type", "employment_type",
                     "employer_name", "query")


def q_applicant_only(spark, sf_dir):
    ev = _export(spark, sf_dir, WEEKLY_PROPERTIES, applicant_only=True)
    return ev.select("event_id", "event", "distinct_id", "origin")


def q_cast_units(spark, sf_dir):
    ev = normalise(_export(spark, sf_dir, WEEKLY_PROPERTIES))
    ev = ev.where(F.col("event").isin(C.FINISHED_SYNC, C.SHARED_INCOME_SUMMARY))
    return ev.select("event_id", "cbv_flow_id", "sync_duration_seconds", "flow_started_minutes_ago")


def q_stream_ingest(spark, sf_dir):
    """Land the export files incrementally (file stream) into a fresh landing
    table, then read the landed table, repeated events once."""
    from .streaming import ingest_exports
    ensure_checkpoint_dir(spark)
    land, ckpt = shared_table_path(spark, "stream-landing"), shared_table_path(spark, "stream-checkpoint")
    ingest_exports(spark, landing.export_dir(spark, sf_dir), land, ckpt, MONTH.agency)
    return tables.read_landed(spark, land).select("event_id", "event", "timestamp", "distinct_id", "cbv_flow_id",
                                                  "client_agency", "event_date")


def q_range_extract(spark, sf_dir):
    as_of = MONTH.as_of or tables.last_day(_log(spark, sf_dir))
    start, end = periods.lookback_bounds(MONTH.pilots, MONTH.agency, as_of, MONTH.report_type)
    return tables.range_extract(spark, landing.event_log_path(spark, sf_dir), MONTH.agency, start, end).select(
        "event_id", "event", "timestamp", "distinct_id")


def _source(spark, sf_dir):
    """The export files of an agency's days, as the extract asks for them."""
    def lines(agency, start, end):
        files = spark.read.schema("value string, agency string, day date").text(landing.export_by_day(spark, sf_dir))
        files = files.where((F.col("agency") == agency) & F.col("day").between(F.lit(start), F.lit(end)))
        return files.select("value", F.col("_metadata.file_path").alias("source_file"))
    return lines


def _extracted(spark, sf_dir, source, root: str | None = None) -> str:
    """An extract of all days in three overlapping runs, of which the last finds nothing to do."""
    first, last = tables.day_bounds(_log(spark, sf_dir))
    root, middle = root or shared_table_path(spark, "extract"), first + (last - first) * 0.6
    for a, b in ((first, middle), (first + (last - first) * 0.3, last), (first, last)):
        extract.extract(spark, root, MONTH.agency, a, b, source, buckets=2)
    return root


def q_extract_once(spark, sf_dir):
    """Overlapping extracts: events of each day, and how often it was asked for."""
    root = _extracted(spark, sf_dir, _source(spark, sf_dir))
    asked = extract.ledger(spark, root).select(F.explode(F.sequence("first_day", "last_day")).alias("event_date"))
    asked = asked.groupBy("event_date").agg(F.count("*").alias("n_asked"))  # one row a day
    n = tables.read_table(spark, f"{root}/events").groupBy("event_date").agg(F.count("*").alias("n_events"))
    return asked.join(n, "event_date", "left").select("event_date", "n_asked", F.coalesce("n_events", F.lit(0)).alias("n_events"))


def q_late_keys(spark, sf_dir):
    """Property keys chosen when the landed extract is read."""
    root = landing.derived(spark, sf_dir, "extract", lambda path: _extracted(spark, sf_dir, _source(spark, sf_dir), path))
    days = tables.day_bounds(tables.read_table(spark, f"{root}/events"))
    ev = extract.read_extract(spark, root, MONTH.agency, *days, {"link_origin": "origin", "flow": "cbv_flow_id", "never_sent": "provider"})
    return ev.select(F.col("event_id").cast("bigint").alias("event_id"), "event", "link_origin", "flow", "never_sent")


def q_export_quarantine(spark, sf_dir):
    """Every line of an export in which some are cut short and some have no
    time: landed (no reason) or set aside."""
    whole = _source(spark, sf_dir)
    number = F.regexp_extract("value", r'"event_id":"(\d+)"', 1).cast("bigint")

    def spoilt(agency, start, end):
        cut = F.expr("substring(value, 1, cast(length(value) * 2 / 3 as int))")
        timeless = F.regexp_replace("value", r'"timestamp":"[^"]*",', "")
        value = F.when(number % 97 == 0, cut).when(number % 89 == 1, timeless).otherwise(F.col("value"))
        return whole(agency, start, end).select(value.alias("value"), "source_file")

    root = _extracted(spark, sf_dir, spoilt)
    landed = tables.read_table(spark, f"{root}/events").select(
        extract.property_text("event_id").cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("reason"))
    return landed.unionByName(extract.quarantined(spark, root).select(number.alias("event_id"), "reason"))


def q_pilot_week(spark, sf_dir):
    return _piloted(spark, sf_dir).select("event_id", "pilot_state", "pilot", "pilot_wk")


def q_recode_events(spark, sf_dir):
    ev = _log(spark, sf_dir)
    return ev.groupBy("event", recode("event", C.WEEKLY_LOOKUP).alias("event_ban")).agg(F.count("*").alias("n"))


def q_roundtrip_parquet(spark, sf_dir):
    """Publish one of the run's named tables, read it back."""
    root = shared_table_path(spark, "published")
    publish.publish(spark, runs.report_tables(_piloted(spark, sf_dir), MONTH), root, only=["report_dropoff"])
    return publish.read_published(spark, root, "report_dropoff")


def _published(name: str) -> Query:
    """A table of a whole run, six tables of the report and four of the
    dashboard, published once as one version each."""
    def read(spark, sf_dir):
        def build(root: str) -> None:
            ev, ctx = _ctx(spark, sf_dir)
            publish.publish(spark, runs.report_tables(_piloted(spark, sf_dir), MONTH), root)
            publish.publish(spark, runs.dashboard_tables(ev, ctx, MONTH), root)
        return publish.read_published(spark, landing.derived(spark, sf_dir, "published", build), name)
    return read


# -- filters / periods -----------------------------------------------------------
def q_filter_out(spark, sf_dir):
    ev = periods.classify_period(_log(spark, sf_dir), "week", within=2)
    ev = filter_out(ev, F.col("device_type") == "tablet")
    return ev.groupBy("period", "device_type").agg(F.count("*").alias("n"))


def q_period_class(spark, sf_dir):
    ev = _log(spark, sf_dir)
    parts = [periods.classify_period(ev, rt).groupBy("period").agg(F.count("*").alias("n"))
             .select(F.lit(rt).alias("report_type"), "period", "n") for rt in ("month", "week")]
    return parts[0].unionByName(parts[1])


def q_latest_pilot(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir)
    return ev.agg(F.count("*").alias("n_events")).select(ctx.latest.alias("pilot_latest"), "n_events")


def q_prior_pilot(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir, pilots_only=True)
    return ev.agg(F.count("*").alias("n_events")).select(
        ctx.state.alias("pilot_state"), ctx.latest.alias("pilot_latest"), ctx.prior.alias("pilot_prior"))


def q_latest_week(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir, pilots_only=True)
    return ev.where(F.col("pilot") == ctx.latest).agg(F.count("*").alias("n_events")).select(
        ctx.latest.alias("pilot_latest"), ctx.week.alias("pilot_week"), "n_events")


def q_extract_window(spark, sf_dir):
    """The current pilot's window with the number of events of the data in it."""
    ev = _log(spark, sf_dir)
    as_of = MONTH.as_of or tables.last_day(ev)
    win = periods.extract_window(pilot_frame(spark, MONTH.pilots), as_of)
    bounds = periods.extract_bounds(MONTH.pilots, as_of)
    return win.crossJoin(tables.count_between(ev, *bounds))  # one row each


def q_cumulative_week(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir)
    return weekly.cumulative(ev, ctx).groupBy("pilot", "pilot_wk").agg(F.count("*").alias("n"))


# -- standard report ---------------------------------------------------------------
def q_report_period(spark, sf_dir):
    return report.report_period(_log(spark, sf_dir), MONTH)


def q_funnel(spark, sf_dir):
    return report.funnel(_piloted(spark, sf_dir), MONTH)


def q_period_kpi(spark, sf_dir):
    return report.period_kpi(_log(spark, sf_dir), WEEK)


def q_period_kpi_month(spark, sf_dir):
    return report.period_kpi(_log(spark, sf_dir), MONTH)


def q_kpi_table(spark, sf_dir):
    return report.kpi_table(_log(spark, sf_dir), MONTH)


def q_kpi_table_fmt(spark, sf_dir):
    return report.kpi_table_fmt(_log(spark, sf_dir), WEEK)


def q_ban_kpi(spark, sf_dir):
    return report.ban_kpi(_log(spark, sf_dir), WEEK)


def q_ban_kpi_month(spark, sf_dir):
    return report.ban_kpi(_log(spark, sf_dir), MONTH)


def q_trend(spark, sf_dir):
    return report.trend(_log(spark, sf_dir), MONTH)


def q_weekend_days(spark, sf_dir):
    return report.weekend_days(_log(spark, sf_dir), MONTH)


def q_search_lead(spark, sf_dir):
    return report.search_lead(_log(spark, sf_dir), MONTH)


def q_search_normalize(spark, sf_dir):
    ev = _log(spark, sf_dir).where(F.col("query").isNotNull())
    return ev.groupBy("query", normalize_search(F.col("query")).alias("query_clean")).agg(F.count("*").alias("n"))


def q_top_searches(spark, sf_dir):
    return report.top_searches(_log(spark, sf_dir), MONTH)


def q_search_line(spark, sf_dir):
    return report.search_line(_log(spark, sf_dir), MONTH)


def q_fmt_labels(spark, sf_dir):
    """Every label formatter on numbers derived from the data: per event, its
    count, its share of all events, a scaled count and a duration."""
    ev = _log(spark, sf_dir)
    per = ev.groupBy("event").agg(F.count("*").alias("n"))
    per = per.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
    return per.select(
        "event", "n",
        L.pct("share").alias("pct"),
        L.pct(F.col("share") - F.lit(0.06)).alias("pct_delta"),
        L.comma(F.col("n") * 997).alias("comma"),
        L.number(F.col("n") / 7, 1, "m").alias("number_m"),
        L.short_scale(F.col("n") * 1234.5, 1).alias("short"),
        L.short_scale(F.col("n"), 1, unscaled_digits=0).alias("short_count"),
        L.timespan(F.col("n") / 3, "mins", 0).alias("span_mins"),
        L.timespan(F.col("n") / 3, "secs", 0).alias("span_secs"),
    )


# -- weekly dashboard ----------------------------------------------------------------
def q_weekly_events_applicants(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir)
    return weekly.weekly_events_applicants(ev, ctx)


def q_multi_employer(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir)
    return weekly.multi_employer(ev, ctx)


def q_weekly_kpi(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir, pilots_only=True)
    return weekly.weekly_kpi(ev, ctx)


def q_initiation_label(spark, sf_dir):
    ev = _log(spark, sf_dir)
    return ev.groupBy("event", initiation_label(F.col("event")).alias("initiation")).agg(F.count("*").alias("n"))


def q_fill_updown(spark, sf_dir):
    ev = weekly.flow_filled(_piloted(spark, sf_dir))
    return ev.select("event_id", "device_type", "origin", "initiation")


def q_device_mix(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir)
    return weekly.device_mix(ev, ctx)


def q_duration_stats(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir)
    return weekly.duration_stats(ev, ctx)


def q_weekly_funnel(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir, pilots_only=True)
    return weekly.weekly_funnel(ev, ctx, MONTH)


def q_initiations_daily(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir, pilots_only=True)
    return weekly.initiations_daily(ev, ctx)


def q_initiations_daily_total(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir, pilots_only=True)
    return weekly.initiations_daily_total(ev, ctx)


def q_initiations_caption(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir, pilots_only=True)
    return weekly.initiations_caption(ev, ctx)


def q_submission_share(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir, pilots_only=True)
    return weekly.submission_share(ev, ctx)


def _rollup(spark, sf_dir) -> tuple[str, DataFrame, weekly.PilotContext]:
    """The pre-aggregate by day, made once in two runs of which the second reads
    new days only; its rows with pilot and week, and the run's facts."""
    def build(path: str) -> None:
        ev = _log(spark, sf_dir)
        first, last = tables.day_bounds(ev)
        rollup.refresh(ev, path, MONTH.agency, start=first, end=first + (last - first) * 0.7)
        rollup.refresh(ev, path, MONTH.agency)
    root = landing.derived(spark, sf_dir, "rollup", build)
    days = _with_pilots(rollup.bits(spark, root, MONTH.agency))
    return root, days, weekly.PilotContext(periods.during_pilots(days, MONTH.pilots), pilot_frame(spark, MONTH.pilots))


def _with_pilots(days: DataFrame) -> DataFrame:
    return periods.add_pilot_week(days, MONTH.pilots, "event_date")


def q_rollup_weekly_kpi(spark, sf_dir):
    root, days, ctx = _rollup(spark, sf_dir)
    return rollup.weekly_kpi(days, _with_pilots(rollup.employers(spark, root, MONTH.agency)), ctx)


def q_rollup_weekly_funnel(spark, sf_dir):
    _, days, ctx = _rollup(spark, sf_dir)
    return rollup.weekly_funnel(days, ctx, MONTH)


def q_rollup_trend(spark, sf_dir):
    root, _, _ = _rollup(spark, sf_dir)
    return rollup.trend(rollup.bits(spark, root, MONTH.agency), MONTH)


def q_rollup_submission_share(spark, sf_dir):
    _, days, ctx = _rollup(spark, sf_dir)
    return rollup.submission_share(days, ctx)


def q_mask_copies(spark, sf_dir):
    m = masking.mask_copies(_piloted(spark, sf_dir), MONTH)
    return m.select("event_id", "event", "timestamp", "distinct_id", "cbv_flow_id", "pilot", "pilot_wk",
                    "pilot_state", "is_copy")


def q_weekly_kpi_masked(spark, sf_dir):
    """The demo path: weekly KPI table computed on the masked event set, pilots
    ordered by their first masked date."""
    ev = _piloted(spark, sf_dir)
    return weekly.weekly_kpi(masking.mask_copies(ev, MONTH), masking.masked_context(ev, MONTH))


def q_report_funnel_labels(spark, sf_dir):
    return frames.report_funnel_labels(_piloted(spark, sf_dir), MONTH)


def q_kpi_cards(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir, pilots_only=True)
    return frames.kpi_cards(ev, ctx)


def q_narrative(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir, pilots_only=True)
    return frames.narrative(ev, ctx)


def q_funnel_labels(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir, pilots_only=True)
    return frames.funnel_labels(ev, ctx, MONTH)


def q_duration_labels(spark, sf_dir):
    ev, ctx = _ctx(spark, sf_dir)
    return frames.duration_labels(ev, ctx)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
} | {f"published_{name}": _published(name) for name in PUBLISHED}
