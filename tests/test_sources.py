"""Landing table, date-ranged extract with partition pruning, export scan."""

import json
import os
import re
import tempfile

import pytest

from logs import make_log
from funnelspark.queries import QUERIES
from funnelspark.sources.export import WEEKLY_PROPERTIES, read_export
from funnelspark.sources.tables import distinct_events, land_events, last_day, range_extract, read_landed


def test_range_extract_prunes_and_dedupes(spark):
    rows = [{"event_id": i, "event": "ApplicantViewedAgreement", "timestamp": f"2024-01-{d:02d} 10:00:00",
             "distinct_id": str(i)} for i, d in enumerate([1, 2, 3, 4, 5, 6], start=1)]
    path = os.path.join(tempfile.mkdtemp(prefix="funnelspark-land-"), "events")
    land_events(make_log(spark, rows), path, "tst")
    # an overlapping batch lands days 5-6 again
    land_events(make_log(spark, rows[4:]), path, "tst")
    import datetime as dt
    got = range_extract(spark, path, "tst", dt.date(2024, 1, 4), dt.date(2024, 1, 6))
    assert sorted(r["event_id"] for r in got.collect()) == [4, 5, 6]
    assert last_day(spark.read.parquet(path)) == dt.date(2024, 1, 6)
    assert read_landed(spark, path).count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan
    assert range_extract(spark, path, "other", dt.date(2024, 1, 1), dt.date(2024, 1, 9)).count() == 0


def test_export_scan_of_mixed_files(spark):
    d = tempfile.mkdtemp(prefix="funnelspark-export-")
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write(json.dumps({"event": "ApplicantViewedAgreement",
                            "properties": {"event_id": "1", "timestamp": "2024-01-01 00:00:00",
                                           "device_type": "desktop", "origin": "sms"}}) + "\n")
    with open(os.path.join(d, "b.json"), "w") as f:   # older exporter: no origin key, extra unknown key
        f.write(json.dumps({"event": "CaseworkerInvitedApplicantToFlow",
                            "properties": {"event_id": "2", "timestamp": "2024-01-02 00:00:00",
                                           "device_type": "smartphone", "unknown_key": 5}}) + "\n")
    all_rows = {r["event_id"]: r for r in read_export(spark, d, WEEKLY_PROPERTIES).collect()}
    assert all_rows["1"]["origin"] == "sms" and all_rows["2"]["origin"] is None
    applicants = read_export(spark, d, WEEKLY_PROPERTIES, applicant_only=True).collect()
    assert [r["event_id"] for r in applicants] == ["1"]
    lineage = {r["event_id"]: r["source_file"] for r in
               read_export(spark, d, WEEKLY_PROPERTIES, with_source_file=True).collect()}
    assert lineage["1"].endswith("a.json") and lineage["2"].endswith("b.json")
    # A key nobody declared, chosen by the caller.
    chosen = {r["event_id"]: r["other"] for r in read_export(spark, d, {"other": "unknown_key"}).collect()}
    assert chosen == {"1": None, "2": "5"}


def test_rows_without_an_id_are_all_kept(spark):
    df = spark.createDataFrame([("a1", 1), ("a1", 1), ("b-2", 2), (None, 3), (None, 3), (None, 4)], "event_id string, x int")
    got = sorted(((r["event_id"] or "", r["x"]) for r in distinct_events(df.repartition(3)).collect()))
    assert got == [("", 3), ("", 3), ("", 4), ("a1", 1), ("b-2", 2)]



@pytest.mark.parametrize("name", ["funnel", "period_kpi", "ban_kpi", "trend", "weekly_kpi", "weekly_funnel", "narrative",
                                  "range_extract", "extract_window", "initiations_daily"])
def test_scans_are_bounded_by_day(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)", plan)
    assert filters and all("event_date" in f for f in filters), filters


@pytest.mark.parametrize("name, scans", [("period_kpi", 3), ("ban_kpi", 3), ("mask_copies", 2)])
def test_scan_counts(spark, name, scans):
    """Counts in one scan, exact medians in two; the masked set in two.  (Beside
    them: the latest timestamp, over the last day, and the sample's cutoff.)"""
    leaves = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert sum("parquet" in leaves.apply(i).toString() for i in range(leaves.size())) == scans


def test_each_agency_has_periods_of_its_own(spark):
    """One agency's events end 18 days before the other's: its report is that of its events alone."""
    import datetime as dt

    from funnelspark.config import SEARCHED_EMPLOYER, SHARED_INCOME_SUMMARY, VIEWED_AGREEMENT, Params, Pilot
    from funnelspark.plans import periods, report
    from funnelspark.sources.pilots import pilot_frame

    def log(last, n):
        rows = []
        for i in range(n):
            day = last - dt.timedelta(days=i % 12)
            for h, e in enumerate((VIEWED_AGREEMENT, SEARCHED_EMPLOYER, SHARED_INCOME_SUMMARY)):
                rows.append({"event_id": 10 * i + h, "event": e, "timestamp": f"{day} {h + i % 9:02d}:30:00", "distinct_id": f"u{i % 17}",
                             "cbv_flow_id": i, "device_type": "smartphone" if i % 2 else "desktop", "flow_started_minutes_ago": float(i)})
        return make_log(spark, rows)

    path = os.path.join(tempfile.mkdtemp(prefix="funnelspark-land-"), "events")
    early, late = dt.date(2024, 3, 12), dt.date(2024, 3, 30)
    land_events(log(early, 40), path, "aaa")
    land_events(log(late, 30), path, "bbb")
    cal = pilot_frame(spark, [Pilot("Testland", "aaa", "P", dt.date(2024, 3, 1), dt.date(2024, 3, 31))])
    run = Params(agency="aaa", report_type="week")
    tables = {"period_kpi": report.period_kpi, "ban_kpi": report.ban_kpi, "trend": report.trend, "period": report.report_period,
              "funnel": lambda ev, p: report.funnel(periods.add_pilot_week(ev, cal), p)}
    for agency, last, n in (("aaa", early, 40), ("bbb", late, 30)):
        landed = spark.read.parquet(path).where(f"client_agency = '{agency}'")
        cut = range_extract(spark, path, agency, last - dt.timedelta(days=13), last)
        for name, table in tables.items():
            alone = sorted(map(tuple, table(log(last, n), run).collect()), key=str)
            assert alone and sorted(map(tuple, table(landed, run).collect()), key=str) == alone, (agency, name)
            assert sorted(map(tuple, table(cut, run).collect()), key=str) == alone, (agency, name, "extract")
    assert sorted(r["period"] for r in report.period_kpi(spark.read.parquet(path).where("client_agency = 'aaa'"), run).collect()) == ["curr", "prior"]


def test_planned_pilots_do_not_move_the_lookback():
    import datetime as dt

    from funnelspark.config import Pilot
    from funnelspark.plans.periods import lookback_bounds
    runs = [Pilot("X", "tst", "now", dt.date(2024, 1, 3), dt.date(2024, 1, 31)), Pilot("X", "tst", "next", dt.date(2024, 3, 1), dt.date(2024, 3, 31))]
    assert lookback_bounds(runs, "tst", dt.date(2024, 1, 15), "month") == (dt.date(2024, 1, 3), dt.date(2024, 1, 15))
