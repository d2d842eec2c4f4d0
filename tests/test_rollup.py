"""The shared pre-aggregate: exact, merging, and only new days are read."""

import datetime as dt
import random

import pytest
from logs import make_log
from pyspark.sql import functions as F

from funnelspark import config as C
from funnelspark.config import Params, Pilot
from funnelspark.plans import periods, report, rollup, weekly
from funnelspark.sources.pilots import pilot_frame
from funnelspark.sources.tables import land_events

PILOTS = (Pilot("Testland", "aaa", "P1", dt.date(2024, 1, 1), dt.date(2024, 1, 14)),
          Pilot("Testland", "aaa", "P2", dt.date(2024, 1, 15), dt.date(2024, 1, 31)))
RUN = Params(agency="aaa", pilots=PILOTS)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    r, rows = random.Random(5), []
    events = sorted({e for e, _ in C.WEEKLY_LOOKUP} | set(C.KEY_EVENTS) | {"Other"})
    for i in range(1500):
        rows.append({"event_id": i, "event": r.choice(events), "timestamp": f"2024-01-{r.randrange(1, 31):02d} {r.randrange(24):02d}:00:00",
                     "distinct_id": r.choice([None, *(f"u{k}" for k in range(60))]), "cbv_flow_id": i % 50,
                     "employer_name": r.choice([None, "A", "B"])})
    path = str(tmp_path_factory.mktemp("log") / "events")
    land_events(make_log(spark, rows), path, "aaa")
    return spark.read.parquet(path)


def tables(spark, ev, root):
    cal = pilot_frame(spark, PILOTS)
    place = lambda df, ts="timestamp": periods.add_pilot_week(df, cal, ts, pilot_rows=2)
    log, days, pairs = place(ev), place(rollup.bits(spark, root, "aaa"), "event_date"), place(rollup.employers(spark, root, "aaa"), "event_date")
    a, b = weekly.PilotContext(log, cal), weekly.PilotContext(days, cal)
    return {
        "kpi": (weekly.weekly_kpi(log, a), rollup.weekly_kpi(days, pairs, b)),
        "counts": (weekly.weekly_events_applicants(log, a), rollup.weekly_events_applicants(days, b)),
        "funnel": (weekly.weekly_funnel(log, a, RUN), rollup.weekly_funnel(days, b, RUN)),
        "share": (weekly.submission_share(log, a), rollup.submission_share(days, b)),
        "trend": (report.trend(ev, RUN), rollup.trend(rollup.bits(spark, root, "aaa"), RUN))}


def same(pairs):
    for name, (log, own) in pairs.items():
        assert log.columns == own.columns, name
        got = sorted(map(tuple, own.collect()), key=str)
        assert got and got == sorted(map(tuple, log.collect()), key=str), name


def test_tables_equal_those_of_the_log(spark, landed, tmp_path):
    root = str(tmp_path)
    day = dt.date(2024, 1, 20)
    rollup.refresh(landed, root, "aaa", end=day)
    made = rollup.refresh(landed, root, "aaa")
    assert made == [(day + dt.timedelta(days=1), dt.date(2024, 1, 30))]
    same(tables(spark, landed, root))
    assert rollup.refresh(landed, root, "aaa") == []


def test_only_new_days_are_read(spark, landed, tmp_path):
    root, day = str(tmp_path), dt.date(2024, 1, 10)
    rollup.refresh(landed, root, "aaa", end=day)
    new = landed.withColumn("event", F.when(F.col("event_date") > F.lit(day), F.col("event")).otherwise(F.raise_error(F.lit("old day read"))))
    assert rollup.refresh(new, root, "aaa") == [(day + dt.timedelta(days=1), dt.date(2024, 1, 30))]


def test_persons_keep_their_numbers(spark, landed, tmp_path):
    root = str(tmp_path)
    for end in (5, 12, 30):
        rollup.refresh(landed, root, "aaa", end=dt.date(2024, 1, end))
    people = spark.read.parquet(f"{root}/people")
    n = people.agg(F.count("*"), F.count_distinct("person"), F.count_distinct("distinct_id")).first()
    assert n[0] == n[1] == n[2] == landed.select("distinct_id").distinct().where("distinct_id is not null").count()


def test_days_not_complete_are_made_anew(spark, landed, tmp_path):
    root, last = str(tmp_path), dt.date(2024, 1, 30)
    early = landed.where("event_date < '2024-01-30' or event_id % 2 = 0")
    rollup.refresh(early, root, "aaa", complete_until=dt.date(2024, 1, 29))
    assert rollup.refresh(landed, root, "aaa") == [(last, last)]
    same(tables(spark, landed, root))


def test_sets_merge_to_any_days(spark, landed, tmp_path):
    root = str(tmp_path)
    rollup.refresh(landed, root, "aaa")
    own = rollup.bits(spark, root, "aaa").where("event_date between '2024-01-03' and '2024-01-17'")
    twice = rollup.merged(rollup.merged(own, ["event", "event_date"]), ["event"])
    got = {r.event: (r.persons, r.events) for r in rollup.counted(twice, ["event"]).collect()}
    ev = landed.where("event_date between '2024-01-03' and '2024-01-17'").groupBy("event").agg(
        F.count_distinct("distinct_id").alias("p"), F.count("*").alias("n"))
    assert got == {r.event: (r.p, r.n) for r in ev.collect()}


def test_no_events(spark, landed, tmp_path):
    assert rollup.refresh(landed.where("client_agency = 'zzz'"), str(tmp_path), "zzz") == []
    assert rollup.bits(spark, str(tmp_path), "zzz").count() == 0
