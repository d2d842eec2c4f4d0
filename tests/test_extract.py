"""The extract: each day once, late property keys, quarantine, first and last day."""

import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from funnelspark.config import VIEWED_AGREEMENT as VIEW
from funnelspark.config import Params
from funnelspark.plans import report
from funnelspark.sources import extract as E
from funnelspark.sources.tables import day_bounds

DAY = lambda n: dt.date(2024, 3, 1) + dt.timedelta(days=n)


def line(event_id, day, **props):
    p = {"timestamp": f"{day} 10:00:00", **props} if day else dict(props)
    if event_id is not None:
        p["event_id"] = event_id
    return json.dumps({"event": VIEW, "properties": p})


class Source:
    """Lines by day; remembers what it was asked for."""

    def __init__(self, spark, by_day):
        self.spark, self.by_day, self.asked = spark, by_day, []

    def __call__(self, agency, start, end):
        self.asked.append((start, end))
        rows = [(x, f"{agency}_{start}_to_{end}.json") for d, lines in self.by_day.items() if start <= d <= end for x in lines]
        return self.spark.createDataFrame(rows, "value string, source_file string").repartition(3)


@pytest.fixture
def source(spark):
    return Source(spark, {DAY(i): [line(f"e{i}", DAY(i), color=str(i)), line(None, DAY(i)), line(None, DAY(i))] for i in range(10)})


def events(spark, root, a=DAY(0), b=DAY(9), agency="aaa", **keys):
    return E.read_extract(spark, root, agency, a, b, keys or {"color": "color"})


def test_a_range_is_brought_once(spark, source, tmp_path):
    root = str(tmp_path)
    assert E.extract(spark, root, "aaa", DAY(2), DAY(5), source) == [(DAY(2), DAY(5))]
    assert E.extract(spark, root, "aaa", DAY(0), DAY(7), source) == [(DAY(0), DAY(1)), (DAY(6), DAY(7))]
    first = sorted(map(tuple, events(spark, root).collect()), key=str)
    asked = list(source.asked)
    assert E.extract(spark, root, "aaa", DAY(1), DAY(7), source) == [] and source.asked == asked
    assert sorted(map(tuple, events(spark, root).collect()), key=str) == first and len(first) == 8 * 3  # NULL ids too
    assert E.extract(spark, root, "bbb", DAY(1), DAY(1), source) == [(DAY(1), DAY(1))]  # another agency's days are its own
    assert events(spark, root).count() == 24 and events(spark, root, agency="bbb").count() == 3
    merged = {(r.client_agency, r.first_day, r.last_day) for r in E.coverage(E.ledger(spark, root)).collect()}
    assert merged == {("aaa", DAY(0), DAY(7)), ("bbb", DAY(1), DAY(1))}


def test_a_run_that_died_leaves_no_trace(spark, source, tmp_path, monkeypatch):
    root, real = str(tmp_path), E.uuid.uuid4
    old = Source(spark, {DAY(0): [line("gone", DAY(0))], DAY(1): [line("old", DAY(1)), "{broken"]})

    def die(*a, **k):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:  # dies after the events were written, before the ledger
        m.setattr(E, "_land", lambda *a: (real_land(*a), die()))
        with pytest.raises(RuntimeError):
            E.extract(spark, root, "aaa", DAY(0), DAY(2), old)
    assert events(spark, root).count() == 2 and E.quarantined(spark, root).count() == 0
    del source.by_day[DAY(0)]  # that day has no event any more
    assert E.extract(spark, root, "aaa", DAY(0), DAY(2), source) == [(DAY(0), DAY(2))]
    got = events(spark, root).collect()
    assert sorted(r.event_id or "" for r in got) == ["", "", "", "", "e1", "e2"]
    assert real


real_land = E._land


def test_days_that_are_not_complete_are_brought_anew(spark, source, tmp_path):
    root = str(tmp_path)
    E.extract(spark, root, "aaa", DAY(0), DAY(3), source, complete_until=DAY(2))
    source.by_day[DAY(3)].append(line("late", DAY(3)))
    assert E.extract(spark, root, "aaa", DAY(0), DAY(3), source) == [(DAY(3), DAY(3))]
    assert events(spark, root).count() == 13 and E.missing_days(spark, root, "aaa", DAY(0), DAY(3)) == []


def test_every_line_is_an_event_or_set_aside(spark, tmp_path):
    root = str(tmp_path)
    good = [line("a", DAY(0)), line("a", DAY(0)), line("b", DAY(1), n=5)]
    bad = ['{"event": "x", "prop', "[]", "", "not json", json.dumps({"event": VIEW}), line("c", None), line("d", "no day"), line("e", DAY(7))]
    src = Source(spark, {DAY(0): good + bad})
    E.extract(spark, root, "aaa", DAY(0), DAY(1), src)
    aside = E.quarantined(spark, root).collect()
    assert sorted(r.value for r in aside) == sorted(bad)
    reasons = {r.value: r.reason for r in aside}
    assert [reasons[b] for b in bad] == [E.UNREADABLE] * 4 + [E.NO_TIME] * 3 + [E.OTHER_DAY]
    assert {r.source_file for r in aside} == {f"aaa_{DAY(0)}_to_{DAY(1)}.json"}
    n = E.ledger(spark, root).first()
    assert (n.n_events, n.n_repeated, n.n_quarantined) == (2, 1, 8) and n.n_events + n.n_repeated + n.n_quarantined == len(good + bad)
    assert sorted(r.event_id for r in events(spark, root).collect()) == ["a", "b"]


def test_keys_are_chosen_when_read(spark, tmp_path):
    root = str(tmp_path)
    props = {"a b": "sp", "n": 87, "nested": {"x": 1}, "none": None, "cbv_flow_id": "12", "sync_duration_seconds": "bad"}
    E.extract(spark, root, "aaa", DAY(0), DAY(0), Source(spark, {DAY(0): [line("1", DAY(0), **props)]}))
    df = E.read_extract(spark, root, "aaa", DAY(0), DAY(0), {"space": "a b", "n": "n", "none": "none", "absent": "zz", "sync_duration_seconds": "sync_duration_seconds"})
    r = df.first()
    assert (r.space, r.n, r.none, r.absent, r.cbv_flow_id, r.sync_duration_seconds) == ("sp", "87", None, None, 12, None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "properties:struct<" in plan  # paths, not the whole object


def test_no_source_and_empty_ranges(spark, tmp_path):
    root, src = str(tmp_path), Source(spark, {})
    assert E.missing_days(spark, root, "aaa", DAY(0), DAY(1)) == [(DAY(0), DAY(1))]
    assert E.extract(spark, root, "aaa", DAY(0), DAY(1), src) == [(DAY(0), DAY(1))]
    assert E.extract(spark, root, "aaa", DAY(0), DAY(1), src) == []
    assert E.ledger(spark, root).first().n_events == 0 and E.extract(spark, root, "aaa", DAY(3), DAY(2), src) == []


@given(st.tuples(st.integers(0, 30), st.integers(0, 30)), st.lists(st.tuples(st.integers(0, 30), st.integers(0, 9)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_ranges_are_subtracted_by_days(wanted, covered):
    a, b = wanted
    gaps = E.without((DAY(a), DAY(b)), [(DAY(x), DAY(x + n)) for x, n in covered])
    got = [d for x, y in gaps for d in range((x - DAY(0)).days, (y - DAY(0)).days + 1)]
    assert got == [d for d in range(a, b + 1) if not any(x <= d <= x + n for x, n in covered)]
    assert all((y2 - x1).days > 1 for (_, x1), (y2, _) in zip(gaps, gaps[1:]))


def test_bounds_come_from_the_partitions_of_the_agency(spark, source, tmp_path):
    root = str(tmp_path)
    E.extract(spark, root, "aaa", DAY(0), DAY(3), source)
    E.extract(spark, root, "bbb", DAY(2), DAY(9), source)
    landed = spark.read.parquet(f"{root}/events")
    for f in tmp_path.glob("events/*/*/*.parquet"):
        f.write_bytes(b"no parquet")  # a data file that is read is an error
    assert day_bounds(landed) == (DAY(0), DAY(9))
    own = landed.where(F.col("client_agency") == "aaa")
    assert day_bounds(own) == (DAY(0), DAY(3))
    assert day_bounds(own.where(F.col("event_date") > F.lit(DAY(1)))) == (DAY(2), DAY(3))
    assert day_bounds(own.where("client_agency = 'ccc'")) == (None, None)
    r = report.report_period(own, Params()).first()
    assert (r["date_start"], r["date_end"], r["period"]) == (DAY(0), DAY(3), "March 01 - 04")
