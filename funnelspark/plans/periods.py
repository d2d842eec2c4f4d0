"""Time-period operators: report period class, pilot/week assignment, the run
facts derived from the pilot calendar, and the cumulative week.

Day bounds are literals: the last day of the agency's events is read from the
landed table's partitions and pilot dates come from the calendar, so a report on
a month of years of events reads that month.  The latest timestamp stays a
scalar subquery (over the last day only).
"""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CUMULATIVE_WEEK, Pilot
from ..functions.nulls import filter_out
from ..operators.lookup import DEFAULT_BROADCAST_MAX_ROWS
from ..sources.pilots import pilot_frame
from ..sources.tables import DAY, between_days, last_day

_UNITS = {"month": "MONTH", "week": "WEEK"}
PERIODS = ("curr", "prior")
#: Pilots of a calendar that becomes an expression (two changes each at most, nine conditions deep).
SEARCH_MAX = 200


def period_interval(report_type: str, n: int) -> Column:
    unit = _UNITS[report_type]
    if unit == "WEEK":
        return F.expr(f"INTERVAL {7 * n} DAY")
    return F.expr(f"INTERVAL {n} {unit}")


def days_before(day: dt.date, report_type: str, n: int) -> dt.date:
    """``day`` minus n periods; months clamp to month end."""
    if report_type == "week":
        return day - dt.timedelta(days=7 * n)
    y, m = divmod(day.year * 12 + day.month - 1 - n, 12)
    return dt.date(y, m + 1, min(day.day, calendar.monthrange(y, m + 1)[1]))


def classify_period(events: DataFrame, report_type: str = "month", ts: str = "timestamp",
                    within: int | None = None) -> DataFrame:
    """``curr`` = within one period of the latest event, ``prior`` = the
    period before, else ``oob`` (also for NULL timestamps).  Month arithmetic
    clamps to month end (Mar 31 - 1 month = Feb 29).  ``within`` keeps only the
    rows of the last ``within`` periods (1 or 2), and reads only their days."""
    last = last_day(events) if DAY in events.columns else None
    newest = events if last is None else between_days(events, last, last)
    max_ts = newest.agg(F.max(ts)).scalar()
    if within and last is not None:
        events = between_days(events, days_before(last, report_type, within), last)
    t = F.col(ts)
    period = (F.when(t > max_ts - period_interval(report_type, 1), "curr")
              .when(t > max_ts - period_interval(report_type, 2), "prior")
              .otherwise("oob"))
    out = events.withColumn("period", period)
    return out.where(F.col("period").isin(list(PERIODS[:within]))) if within else out


def during_pilots(events: DataFrame, pilots: Iterable[Pilot]) -> DataFrame:
    """Only the days the calendar spans: for tables that leave out events of no
    pilot anyway."""
    pilots = list(pilots)
    if not pilots:
        return events
    return between_days(events, min(p.start_date for p in pilots), max(p.end_date for p in pilots))


def pilot_days(pilots: DataFrame) -> DataFrame:
    """The calendar by day: one row per state and day.  Where runs of a state
    overlap, a day belongs to the run that started last (equal starts: to the
    larger name), so no event is counted twice."""
    days = pilots.select(F.col("state").alias("_p_state"), F.explode(F.sequence("start_date", "end_date")).alias("_p_day"),
                         F.struct("start_date", "pilot").alias("_run"))
    return days.groupBy("_p_state", "_p_day").agg(F.max("_run").alias("_run")).select(
        "_p_state", "_p_day", F.col("_run.pilot").alias("_p_pilot"), F.col("_run.start_date").alias("_p_start"))


def pilot_stretches(pilots: Iterable[Pilot]) -> dict[str, list[tuple[dt.date, Pilot | None]]]:
    """For each state the days on which the running pilot changes, in order,
    with the pilot from then on.  Of overlapping runs the one that started last
    (equal starts: the larger name) has the day, as in :func:`pilot_days`."""
    out: dict[str, list[tuple[dt.date, Pilot | None]]] = {}
    by_state: dict[str, list[Pilot]] = {}
    for p in pilots:
        by_state.setdefault(p.state, []).append(p)
    for state, runs in by_state.items():
        changes: list[tuple[dt.date, Pilot | None]] = []
        for day in sorted({d for p in runs for d in (p.start_date, p.end_date + dt.timedelta(days=1))}):
            now = max((p for p in runs if p.start_date <= day <= p.end_date), key=lambda p: (p.start_date, p.pilot), default=None)
            if not changes or changes[-1][1] != now:
                changes.append((day, now))
        out[state] = changes
    return out


def _searched(day: Column, changes: list[tuple[dt.date, Pilot | None]], value) -> Column:
    """Binary search for the last change on or before ``day``, as nested conditions."""
    if not changes:
        return F.lit(None)
    if len(changes) == 1:
        return F.when(day >= F.lit(changes[0][0]), value(changes[0][1]))
    middle = len(changes) // 2
    return F.when(day >= F.lit(changes[middle][0]), _searched(day, changes[middle:], value)).otherwise(
        _searched(day, changes[:middle], value))


def _pilot_week_by_search(events: DataFrame, pilots: Iterable[Pilot], ts: str) -> DataFrame:
    day, state = F.to_date(F.col(ts)), F.col("pilot_state")

    def look(value) -> Column:
        out = F.when(F.lit(False), value(None))
        for name, changes in pilot_stretches(pilots).items():
            out = out.when(state == name, _searched(day, changes, value))
        return out

    pilot = look(lambda p: F.lit(p.pilot if p else None).cast("string"))
    start = look(lambda p: F.lit(p.start_date if p else None).cast("date"))
    week = (F.floor(F.datediff(day, start) / F.lit(7)) + 1).cast("int")
    return events.drop("pilot", "pilot_wk").withColumns({"pilot": pilot, "pilot_wk": week})


def add_pilot_week(events: DataFrame, pilots: DataFrame | Iterable[Pilot], ts: str = "timestamp", *,
                   pilot_rows: int | None = None, broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                   search_max: int = SEARCH_MAX) -> DataFrame:
    """Attach ``pilot`` and ``pilot_wk`` (1 = first 7 days of the pilot).

    A calendar given as :class:`Pilot` rows, of at most ``search_max``, becomes an
    expression: a binary search over the days on which a state's pilot changes.
    There is no join, and the pilot is known inside the scan's stage.

    A calendar in a table, or a longer one, is joined by (state, day) to the
    calendar by day, which is broadcast when it is within ``broadcast_max_rows``
    (``pilot_rows``: calendar rows if known, else its days are counted), so the
    event side is never shuffled; a larger one joins by shuffle, where AQE splits
    a busy day."""
    if not isinstance(pilots, DataFrame):
        pilots = list(pilots)
        if len(pilots) <= search_max:
            return _pilot_week_by_search(events, pilots, ts)
        pilots, pilot_rows = pilot_frame(events.sparkSession, pilots), len(pilots)
    p = pilot_days(pilots)
    small = (pilot_rows is not None and pilot_rows * 366 <= broadcast_max_rows) or (
        p.limit(broadcast_max_rows + 1).count() <= broadcast_max_rows)
    base = events.drop("pilot", "pilot_wk").withColumn("_day", F.to_date(F.col(ts)))
    side = F.broadcast(p) if small else p
    joined = base.join(side, (base["pilot_state"] == p["_p_state"]) & (base["_day"] == p["_p_day"]), "left")
    wk = (F.floor(F.datediff("_day", F.col("_p_start")) / F.lit(7)) + 1).cast("int")
    return (joined.withColumn("pilot", F.col("_p_pilot"))
            .withColumn("pilot_wk", F.when(F.col("_p_pilot").isNotNull(), wk))
            .drop("_day", "_p_state", "_p_day", "_p_pilot", "_p_start"))


def with_cumulative_week(events: DataFrame, pilot_week: Column) -> DataFrame:
    """Every event of weeks 1..``pilot_week`` appears once more with
    ``pilot_wk = -1`` (the cumulative week).  One scan and an ``explode``
    instead of a self-union, so the source is read once."""
    wk = F.col("pilot_wk")
    weeks = F.when(wk.between(F.lit(1), pilot_week), F.array(wk, F.lit(CUMULATIVE_WEEK))).otherwise(F.array(wk))
    return events.withColumn("pilot_wk", F.explode(weeks))


def extract_window(pilots: DataFrame, as_of: dt.date | Column) -> DataFrame:
    """The current pilot's extraction window: drop pilots that start after
    ``as_of``, end the window at ``min(as_of, end_date)``, and carry the
    previous pilot's window (by start date) alongside the last one."""
    a = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    p = filter_out(pilots, F.col("start_date") > a)
    p = p.withColumn("api_end", F.least(a, F.col("end_date")))
    p = p.withColumn("path_dates", F.concat(F.col("start_date").cast("string"), F.lit("_to_"),
                                            F.col("api_end").cast("string")))
    w = Window.orderBy("start_date", "pilot")
    p = p.withColumn("prior_path_dates", F.lag("path_dates").over(w)) \
         .withColumn("_rn", F.row_number().over(w.orderBy(F.col("start_date").desc(), F.col("pilot").desc())))
    return p.where(F.col("_rn") == 1).select("start_date", "api_end", "client_agency", "path_dates",
                                             "prior_path_dates")


def extract_bounds(pilots: Iterable[Pilot], as_of: dt.date) -> tuple[dt.date, dt.date] | None:
    """First and last day of :func:`extract_window` for a literal calendar."""
    begun = [p for p in pilots if p.start_date <= as_of]
    if not begun:
        return None
    p = max(begun, key=lambda p: (p.start_date, p.pilot))
    return p.start_date, min(as_of, p.end_date)


def lookback_bounds(pilots: Iterable[Pilot], agency: str, as_of: dt.date, report_type: str) -> tuple[dt.date, dt.date]:
    """[max(start of the agency's on-going pilot, as_of - 2 periods), as_of].
    Two periods, so that the prior one is there to compare with (Q2).  Pilots
    planned for later than ``as_of`` do not count."""
    back = days_before(as_of, report_type, 2)
    return max([back, *(p.start_date for p in pilots if p.client_agency == agency and p.start_date <= as_of)]), as_of
