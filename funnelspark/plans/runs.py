"""The named tables of a run: six of the standard report, four of the weekly
dashboard, each as a function that builds it.  ``sources.publish`` builds the
ones asked for and commits them as one version."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..config import Params
from . import report, weekly
from .weekly import PilotContext


def report_tables(events: DataFrame, params: Params) -> dict[str, Callable[[], DataFrame]]:
    return {
        "report_period": lambda: report.report_period(events, params),
        "report_dropoff": lambda: report.funnel(events, params),
        "report_addtl": lambda: report.kpi_table_fmt(events, params),
        "report_ban": lambda: report.ban_kpi(events, params),
        "report_trend": lambda: report.trend(events, params),
        "report_searches": lambda: report.top_searches(events, params),
    }


def dashboard_tables(events: DataFrame, ctx: PilotContext, params: Params) -> dict[str, Callable[[], DataFrame]]:
    return {
        "wkly_ban": lambda: weekly.weekly_kpi(events, ctx),
        "wkly_device_origin": lambda: weekly.device_mix(events, ctx),
        "wkly_duration": lambda: weekly.duration_stats(events, ctx, params.approx),
        "wkly_dropoff": lambda: weekly.weekly_funnel(events, ctx, params),
    }
