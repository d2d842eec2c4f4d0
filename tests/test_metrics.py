"""Metric tables on hand-made fixtures covering the reference's traps."""

import datetime as dt

from pyspark.sql import functions as F

from logs import make_log
from funnelspark import config as C
from funnelspark.config import Params, Pilot
from funnelspark.plans import periods, report, weekly
from funnelspark.sources.export import REPORT_PROPERTIES, normalise, parse_export_lines
from funnelspark.sources.pilots import pilot_frame

VIEW, DONE, SYNC, SEARCH, SELECT = (C.VIEWED_AGREEMENT, C.SHARED_INCOME_SUMMARY, C.FINISHED_SYNC,
                                    C.SEARCHED_EMPLOYER, C.SELECTED_EMPLOYER)
PILOTS = (Pilot("Testland", "tst", "P1", dt.date(2024, 1, 1), dt.date(2024, 1, 14)),
          Pilot("Testland", "tst", "P2", dt.date(2024, 2, 1), dt.date(2024, 2, 14)))


def piloted(spark, rows, pilots=PILOTS):
    ev = periods.add_pilot_week(make_log(spark, rows), pilot_frame(spark, pilots))
    return ev, weekly.PilotContext(ev, pilot_frame(spark, pilots))


def test_period_class_month_end_clamps(spark):
    rows = [{"event": VIEW, "timestamp": t} for t in
            ("2024-03-31 12:00:00", "2024-02-29 12:00:01", "2024-02-29 12:00:00", "2024-01-29 12:00:00",
             "2024-01-29 11:00:00")]
    got = [r["period"] for r in periods.classify_period(make_log(spark, rows), "month")
           .orderBy(F.col("timestamp").desc()).collect()]
    # Mar 31 - 1 month = Feb 29 (leap year, clamped); - 2 months = Jan 31
    assert got == ["curr", "curr", "prior", "oob", "oob"]


def test_report_period_labels(spark):
    def label(a, b):
        ev = make_log(spark, [{"event": VIEW, "timestamp": a}, {"event": VIEW, "timestamp": b}])
        return report.report_period(ev, Params()).first()["period"]
    assert label("2024-03-01 00:00:00", "2024-03-31 10:00:00") == "March 01 - 31"
    assert label("2024-03-10 00:00:00", "2024-04-09 10:00:00") == "March 10 - April 09"
    # same month number, different year: not the same month (Q5)
    assert label("2023-03-10 00:00:00", "2024-03-09 10:00:00") == "March 10 - March 09"


def test_pilot_week_and_cumulative(spark):
    rows = [{"event": VIEW, "timestamp": t, "distinct_id": "u"} for t in
            ("2024-01-01 01:00:00", "2024-01-08 01:00:00", "2024-01-14 23:00:00", "2024-01-20 00:00:00",
             "2024-02-01 00:00:00")]
    ev, ctx = piloted(spark, rows)
    wk = [(r["pilot"], r["pilot_wk"]) for r in ev.orderBy("timestamp").collect()]
    assert wk == [("P1", 1), ("P1", 2), ("P1", 2), (None, None), ("P2", 1)]
    cum = {(r["pilot"], r["pilot_wk"]): r["n"] for r in weekly.cumulative(ev, ctx)
           .groupBy("pilot", "pilot_wk").agg(F.count("*").alias("n")).collect()}
    # latest week of the latest pilot is 1: only week-1 rows are copied to -1
    assert cum[("P1", -1)] == 1 and cum[("P2", -1)] == 1 and cum[("P1", 2)] == 2


def test_no_prior_pilot_and_zero_denominator(spark):
    one_pilot = PILOTS[:1]
    rows = [{"event": DONE, "timestamp": "2024-01-02 00:00:00", "distinct_id": "u", "cbv_flow_id": 1,
             "flow_started_minutes_ago": 5.0}]
    ev, ctx = piloted(spark, rows, one_pilot)
    k = {(r["denom"], r["metric"]): r for r in weekly.weekly_kpi(ev, ctx).where("pilot_wk = 1").collect()}
    r = k[("applicants", "share_complete")]
    assert r["curr"] is None                 # completions but no starts: no share
    assert r["prior"] is None and r["text_fmt"] == C.NO_PRIOR
    assert k[("applicants", "n_started")]["val_fmt"] == "0"


def test_multi_employer_counts(spark):
    def sync(pid, emp, day):
        return {"event": SYNC, "timestamp": f"2024-01-0{day} 00:00:00", "distinct_id": pid, "cbv_flow_id": 1,
                "employer_name": emp}
    rows = [sync("same", "A", 2), sync("same", "A", 3),          # one employer twice -> 1
            sync("two", "A", 2), sync("two", "B", 3),            # two employers -> multi
            sync("nul", None, 2), sync("nul", "A", 3)]           # missing + one -> multi
    ev, ctx = piloted(spark, rows, PILOTS[:1])
    got = {r["pilot_wk"]: r["multi_employers"] for r in weekly.multi_employer(ev, ctx).collect()}
    assert got == {1: 2, -1: 2}


def test_weekly_funnel_step_only_in_prior_sorts_last(spark):
    rows = []
    for i, (d, e) in enumerate([("2024-01-02", VIEW), ("2024-01-02", SEARCH), ("2024-01-03", C.BEGAN_LINKING),
                                ("2024-02-02", VIEW), ("2024-02-03", C.BEGAN_LINKING)]):
        rows.append({"event": e, "timestamp": f"{d} 0{i}:00:00", "distinct_id": "u", "cbv_flow_id": 1})
    ev, ctx = piloted(spark, rows)
    f = {r["event_clean"]: r for r in weekly.weekly_funnel(ev, ctx, Params()).where("pilot_wk = 1").collect()}
    assert f["Consented"]["curr"] == 1 and f["Consented"]["curr_lag"] is None
    assert f["Began Linking"]["curr_lag"] == 1          # skips the prior-only search step
    assert f["Searched Employer"]["curr"] is None and f["Searched Employer"]["prior"] == 1
    assert f["Searched Employer"]["curr_lag"] == 1      # appended after the current steps


def test_top_searches_ties_and_outcomes(spark):
    rows = []
    t = 0
    for q, n, ok in [("zeta", 2, True), ("alpha", 2, True), ("mid", 1, True), ("lost", 3, False)]:
        for _ in range(n):
            t += 1
            flow = 100 + t
            rows.append({"event": SEARCH, "timestamp": f"2024-01-05 00:{t:02d}:00", "distinct_id": str(flow),
                         "cbv_flow_id": flow, "query": q})
            rows.append({"event": SELECT if ok else C.MISSING_RESULTS, "timestamp": f"2024-01-05 00:{t:02d}:01",
                         "distinct_id": str(flow), "cbv_flow_id": flow})
    ev = make_log(spark, rows)
    top = report.top_searches(ev, Params(top_n=2)).collect()
    got = sorted((r["is_successful"], r["rank"], r["event_count"]) for r in top)
    assert got == [(False, 1, "LOST (3)"), (True, 1, "ALPHA (2)"), (True, 2, "ZETA (2)")]


def test_selection_at_same_instant_sorts_before_search(spark):
    rows = [{"event": SEARCH, "timestamp": "2024-01-05 00:00:00", "distinct_id": "u", "cbv_flow_id": 1,
             "query": "x"},
            {"event": SELECT, "timestamp": "2024-01-05 00:00:00", "distinct_id": "u", "cbv_flow_id": 1},
            {"event": C.MISSING_RESULTS, "timestamp": "2024-01-05 00:00:05", "distinct_id": "u", "cbv_flow_id": 1}]
    s = report.search_lead(make_log(spark, rows), Params()).collect()
    assert [r["lead_event"] for r in s] == ["Missing Results"]


def test_bad_numbers_become_null(spark):
    lines = spark.createDataFrame([
        ('{"event": "ApplicantFinishedSync", "properties": {"event_id": "1", "timestamp": "2024-01-01 00:00:00", '
         '"cbv_flow_id": "abc", "sync_duration_seconds": ""}}',),
        ('{"event": "ApplicantFinishedSync", "properties": {"event_id": "2", "timestamp": "2024-01-01 00:00:01", '
         '"cbv_flow_id": "12", "sync_duration_seconds": "3.5", "flow_started_seconds_ago": "90"}}',)], "value string")
    got = {r["event_id"]: r for r in normalise(parse_export_lines(lines, REPORT_PROPERTIES)).collect()}
    assert got["1"]["cbv_flow_id"] is None and got["1"]["sync_duration_seconds"] is None
    assert got["2"]["cbv_flow_id"] == 12 and got["2"]["sync_duration_seconds"] == 3.5
    assert got["2"]["flow_started_minutes_ago"] == 1.5


def test_ban_kpi_missing_prior(spark):
    rows = [{"event": VIEW, "timestamp": "2024-01-05 00:00:00", "distinct_id": "a"},
            {"event": DONE, "timestamp": "2024-01-05 01:00:00", "distinct_id": "a",
             "flow_started_minutes_ago": 12.0}]
    b = {r["metric"]: r for r in report.ban_kpi(make_log(spark, rows), Params(report_type="month")).collect()}
    assert b["n_started"]["curr"] == 1.0 and b["n_started"]["delta_fmt"] == C.NO_PRIOR
    assert b["share_completed"]["curr_fmt"] == "100%"
    assert b["duration_complete"]["curr_fmt"] == "12.0m"
    assert b["share_missing_searches"]["curr"] is None


def test_approx_mode_is_close_to_exact(spark):
    import random
    rnd = random.Random(1)
    rows = []
    for i in range(600):
        day = 1 + i % 20
        rows.append({"event": DONE if i % 3 else VIEW, "timestamp": f"2024-01-{day:02d} 0{i % 10}:00:00",
                     "distinct_id": f"u{i % 97}", "cbv_flow_id": i % 150,
                     "flow_started_minutes_ago": rnd.uniform(1, 60)})
    ev = make_log(spark, rows)
    exact = {r["period"]: r for r in report.period_kpi(ev, Params(report_type="week")).collect()}
    approx = {r["period"]: r for r in report.period_kpi(ev, Params(report_type="week", approx=True)).collect()}
    assert exact.keys() == approx.keys()
    for p, r in exact.items():
        # within three documented standard errors of the sketch
        assert abs(approx[p]["n_applicants"] - r["n_applicants"]) <= 3 * Params().approx_rsd * r["n_applicants"]
        assert abs(approx[p]["duration_complete"] - r["duration_complete"]) <= 3.0


def test_pilot_week_day_join_equals_broadcast_join(spark):
    rows = [{"event": VIEW, "timestamp": t, "distinct_id": "u"} for t in
            ("2024-01-01 01:00:00", "2024-01-14 23:00:00", "2024-01-20 00:00:00", "2024-02-03 00:00:00")]
    ev = make_log(spark, rows)
    cal = pilot_frame(spark, PILOTS)
    a = periods.add_pilot_week(ev, cal).select("event_id", "pilot", "pilot_wk").collect()
    b = periods.add_pilot_week(ev, cal, broadcast_max_rows=0).select("event_id", "pilot", "pilot_wk").collect()
    assert sorted(a, key=str) == sorted(b, key=str)


TWO_STATES = (Pilot("X", "tst", "X1", dt.date(2024, 1, 1), dt.date(2024, 12, 31)),
              Pilot("Y", "tst", "Y1", dt.date(2024, 2, 1), dt.date(2024, 2, 14)),
              Pilot("Y", "tst", "Y2", dt.date(2024, 2, 15), dt.date(2024, 2, 28)))


def test_latest_pilot_is_the_last_started(spark):
    rows = [{"event": VIEW, "timestamp": t, "pilot_state": s} for s, t in
            (("X", "2024-01-05 00:00:00"), ("Y", "2024-02-03 00:00:00"), ("Y", "2024-02-16 00:00:00"),
             ("Y", "2024-02-24 00:00:00"), ("X", "2024-05-01 00:00:00"), ("X", "2024-05-01 00:00:00"))]
    ev, ctx = piloted(spark, rows, TWO_STATES)
    r = ev.agg(F.count("*").alias("n")).select(ctx.latest.alias("l"), ctx.state.alias("s"), ctx.week.alias("w"),
                                               ctx.prior.alias("p")).first()
    assert (r["l"], r["s"], r["w"], r["p"]) == ("Y2", "Y", 2, "Y1")
    # Y2 without events: the one before it is the latest; it has no prior.
    ev, ctx = piloted(spark, rows[:2], TWO_STATES)
    r = ev.agg(F.count("*").alias("n")).select(ctx.latest.alias("l"), ctx.prior.alias("p")).first()
    assert (r["l"], r["p"]) == ("Y1", None)
    # Equal starts: the larger name.
    tie = (Pilot("X", "tst", "A", dt.date(2024, 1, 1), dt.date(2024, 1, 9)),
           Pilot("Y", "tst", "B", dt.date(2024, 1, 1), dt.date(2024, 1, 9)))
    ev, ctx = piloted(spark, [dict(r, timestamp="2024-01-02 00:00:00") for r in rows[:2]], tie)
    assert ev.agg(F.count("*").alias("n")).select(ctx.latest.alias("l")).first()["l"] == "B"


def test_overlapping_runs_count_an_event_once(spark):
    cal = (Pilot("Testland", "tst", "long", dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
           Pilot("Testland", "tst", "short", dt.date(2024, 1, 10), dt.date(2024, 1, 12)))
    rows = [{"event": VIEW, "timestamp": f"2024-01-{d:02d} 08:00:00"} for d in (9, 10, 12, 13)] + [{"event": VIEW, "timestamp": None}]
    for limit in (100_000, 0):
        ev = periods.add_pilot_week(make_log(spark, rows), pilot_frame(spark, cal), broadcast_max_rows=limit)
        got = [(r["event_id"], r["pilot"], r["pilot_wk"]) for r in ev.orderBy("event_id").collect()]
        assert got == [(0, "long", 2), (1, "short", 1), (2, "short", 1), (3, "long", 2), (4, None, None)]


def test_lookback_takes_two_periods():
    day = dt.date(2024, 3, 31)
    assert periods.lookback_bounds((), "tst", day, "month") == (dt.date(2024, 1, 31), day)
    assert periods.lookback_bounds((), "tst", day, "week") == (dt.date(2024, 3, 17), day)
    assert periods.lookback_bounds(PILOTS, "tst", day, "month") == (dt.date(2024, 2, 1), day)
    assert periods.lookback_bounds(PILOTS, "other", day, "month") == (dt.date(2024, 1, 31), day)
    assert periods.days_before(dt.date(2024, 3, 31), "month", 1) == dt.date(2024, 2, 29)
    assert periods.extract_bounds(PILOTS, dt.date(2024, 1, 20)) == (dt.date(2024, 1, 1), dt.date(2024, 1, 14))
    assert periods.extract_bounds(PILOTS, dt.date(2023, 1, 1)) is None


def test_pilot_search_equals_the_calendar_join(spark):
    """Overlaps, equal starts, one-day runs, gaps, states without runs: the expression and the join agree on every day."""
    import random

    r, day = random.Random(4), dt.date(2024, 1, 1)
    runs = []
    for i in range(25):
        start = day + dt.timedelta(days=r.randrange(80))
        runs.append(Pilot(r.choice("XYZ"), "tst", f"p{i:02d}", start, start + dt.timedelta(days=r.choice([0, 1, 6, 13, 30]))))
    runs.append(Pilot("X", "tst", "p99", runs[0].start_date, runs[0].end_date))
    rows = [{"event": VIEW, "timestamp": f"{day + dt.timedelta(days=d)} 23:59:59", "pilot_state": s}
            for d in range(-3, 125) for s in ("X", "Y", "Z", "none", None)] + [{"event": VIEW, "timestamp": None, "pilot_state": "X"}]
    ev = make_log(spark, rows)
    cols = ["event_id", "pilot", "pilot_wk"]
    found = periods.add_pilot_week(ev, runs)
    joined = periods.add_pilot_week(ev, pilot_frame(spark, runs))
    assert found.dtypes == joined.select(found.columns).dtypes
    assert sorted(map(tuple, found.select(*cols).collect()), key=str) == sorted(map(tuple, joined.select(*cols).collect()), key=str)
    long = periods.add_pilot_week(ev, runs, search_max=3).select(*cols)
    assert sorted(map(tuple, long.collect()), key=str) == sorted(map(tuple, found.select(*cols).collect()), key=str)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert periods.add_pilot_week(ev, []).where("pilot is not null or pilot_wk is not null").count() == 0
