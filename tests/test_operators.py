"""Operators: fill, lead, quantiles (both paths), keyed sample, top-N, reshape."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from funnelspark.operators.keys import join_null_safe
from funnelspark.operators.quantiles import exact_quantiles
from funnelspark.operators.reshape import long_to_wide_periods
from funnelspark.operators.sample import sample_keys
from funnelspark.operators.topn import top_n_per_group
from funnelspark.operators.window_ops import fill_updown, lead_within


def test_fill_updown_directions(spark):
    rows = [
        # flow 1: leading null, inner null between two values, trailing null
        ("p", 1, 1, None), ("p", 1, 2, "a"), ("p", 1, 3, None), ("p", 1, 4, "b"), ("p", 1, 5, None),
        # flow 2: all null
        ("p", 2, 1, None), ("p", 2, 2, None),
        # NULL person and flow form one group, as in R
        (None, None, 1, None), (None, None, 2, "z"),
    ]
    df = spark.createDataFrame(rows, "pid string, flow long, t int, v string")
    out = fill_updown(df, ["pid", "flow"], [F.col("t")], ["v"])
    got = {(r["pid"], r["flow"], r["t"]): r["v"] for r in out.collect()}
    assert [got[("p", 1, t)] for t in range(1, 6)] == ["a", "a", "b", "b", "b"]
    assert [got[("p", 2, t)] for t in (1, 2)] == [None, None]
    assert got[(None, None, 1)] == "z"


def test_lead_within_null_key_has_no_next(spark):
    rows = [(1, 10, 1, "x"), (2, 10, 2, "y"), (3, 10, 3, "z"), (4, None, 1, "q"), (5, None, 2, "r")]
    df = spark.createDataFrame(rows, "id int, k long, t int, v string")
    out = {r["id"]: r["nxt"] for r in lead_within(df, "k", [F.col("t")], "v", "nxt").collect()}
    assert out == {1: "y", 2: "z", 3: None, 4: None, 5: None}


def _type7(values, p):
    return float(np.percentile(np.array(values, dtype=float), p * 100, method="linear"))


def test_exact_quantiles(spark):
    rnd = random.Random(7)
    rows = []
    for g, n in (("a", 1), ("b", 2), ("c", 57), (None, 40)):
        for _ in range(n):
            rows.append((g, rnd.choice([rnd.random() * 100, float(rnd.randint(0, 5))])))
    rows.append(("c", None))
    rows.append(("c", float("nan")))
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    for g in ("a", "b", "c", None):
        vals = [v for gg, v in rows if gg == g and v is not None and not math.isnan(v)]
        r = got[g]
        assert r["n"] == len(vals)
        assert r["min"] == min(vals) and r["max"] == max(vals)
        for name, p in probs.items():
            assert math.isclose(r[name], _type7(vals, p), rel_tol=1e-12, abs_tol=1e-12), (g, name)
        assert r["q25"] <= r["median"] <= r["q75"]


def test_exact_quantiles_all_equal_values(spark):
    df = spark.createDataFrame([("k", 5.0)] * 50, "g string, v double")
    r = exact_quantiles(df, ["g"], "v", {"median": 0.5}).first()
    assert r["median"] == 5.0 and r["n"] == 50


def test_exact_quantiles_outliers_signs_and_no_groups(spark):
    rnd = random.Random(3)
    vals = [rnd.lognormvariate(3, 1) for _ in range(3000)] + [1e300, -1e300, 0.0, -0.0, 5e-324, float("inf"), -7.5, -7.25]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(5)
    probs = {f"p{i}": i / 20 for i in range(21)}
    r = exact_quantiles(df, [], "v", probs).first()
    for name, p in probs.items():
        if p < 1:
            assert math.isclose(r[name], _type7(sorted(vals)[:-1] + [1e308], p), rel_tol=1e-12, abs_tol=1e-12), name
    assert r["max"] == float("inf") and r["min"] == -1e300


def test_exact_quantiles_plan_joins_by_broadcast_and_starts_no_job(spark):
    df = spark.range(10_000).selectExpr("id % 2 as g", "cast(id as double) as v")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("quantile-build", "")
        q = exact_quantiles(df, ["g"], "v", {"median": 0.5})
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert not tracker.getJobIdsForGroup("quantile-build")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert {r["g"]: r["median"] for r in q.collect()} == {0: 4999.0, 1: 5000.0}


def test_sample_keys_exact_size_and_deterministic(spark):
    ids = [str(i) for i in range(1, 501)]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,), ("7",)], "distinct_id string")
    got = sorted(r[0] for r in sample_keys(df, "distinct_id", 0.6, "42").collect())
    expected = sorted(sorted(ids, key=lambda s: (hashlib.md5((s + "42").encode()).hexdigest(), s))[:300])
    assert got == expected
    again = sorted(r[0] for r in sample_keys(df.repartition(13), "distinct_id", 0.6, "42").collect())
    assert again == got


def test_top_n_ties_broken_by_key(spark):
    rows = [(True, f"q{i:02d}", 5 if i < 12 else 1) for i in range(15)] + [(False, "x", 3)]
    df = spark.createDataFrame(rows, "g boolean, q string, n long")
    top = top_n_per_group(df, ["g"], [F.col("n").desc(), F.col("q").asc()], 10)
    got = sorted((r["g"], r["q"]) for r in top.collect())
    assert [q for g, q in got if g] == [f"q{i:02d}" for i in range(10)]
    assert [q for g, q in got if not g] == ["x"]


def test_long_to_wide_missing_period_is_null(spark):
    df = spark.createDataFrame([("curr", 3, 0.5)], "period string, a long, b double")
    rows = {r["metric"]: (r["curr"], r["prior"]) for r in long_to_wide_periods(df, ["a", "b"], ["curr", "prior"])
            .collect()}
    assert rows == {"a": (3.0, None), "b": (0.5, None)}


def test_join_null_safe_matches_null_keys(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, b int")
    got = sorted(((r["k"], r["a"], r["b"]) for r in join_null_safe(a, b, ["k"]).collect()), key=str)
    assert got == sorted([(None, 1, 10), ("x", 2, 20)], key=str)


def _random_events(spark, seed=3, n=400):
    import datetime as dt
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        flow = rnd.choice([1, 2, 3, None])
        person = rnd.choice(["a", "b", None]) if flow is None else ("p" if rnd.random() < 0.9 else "q")
        t = base + dt.timedelta(seconds=rnd.randint(0, 600))       # ~10 one-minute chunks
        v = rnd.choice([None, None, "x", "y", "z"])
        w = rnd.choice([None, "u", "v"])
        rows.append((i, person, flow, t, v, w))
    return spark.createDataFrame(rows, "id long, pid string, flow long, ts timestamp_ntz, v string, w string")


def _in_order(rows, key, *order):
    """Rows of each key, ascending by ``order`` with NULLs last."""
    by = {}
    for r in rows:
        by.setdefault(tuple(r[k] for k in key), []).append(r)
    return [sorted(own, key=lambda r: tuple((r[c] is None, r[c]) for c in order)) for own in by.values()]


def _cut_finely(monkeypatch, per_cut=2):
    from funnelspark.operators import window_ops
    monkeypatch.setattr(window_ops, "PER_CUT", per_cut)


def test_lead_over_chunks(spark, monkeypatch):
    """Cut every 2 or 40 rows of a hot flow, or not at all: the next row's value either way."""
    df = _random_events(spark).repartition(5)
    expect = {}
    for own in _in_order(df.collect(), ["flow"], "pid", "ts", "id"):
        for r, nxt in zip(own, [*own[1:], None]):
            expect[r["id"]] = nxt["v"] if nxt and r["flow"] is not None else None
    order = [F.col(c) for c in ("pid", "ts", "id")]
    _cut_finely(monkeypatch)
    for hot_rows, max_cuts in ((2, 100_000), (40, 100_000), (2, 7), (10**9, 100_000)):
        got = lead_within(df, "flow", order, "v", "nxt", hot_rows=hot_rows, max_cuts=max_cuts)
        assert {r["id"]: r["nxt"] for r in got.collect()} == expect and got.columns == [*df.columns, "nxt"]
    kept = lead_within(df, "flow", order, "v", "nxt", keep=F.col("v") == "x", hot_rows=2)
    assert {r["id"]: r["nxt"] for r in kept.collect()} == {r["id"]: expect[r["id"]] for r in df.collect() if r["v"] == "x"}


def test_fill_over_chunks(spark, monkeypatch):
    df = _random_events(spark, seed=11).withColumn("w", F.when(F.col("id") % 40 == 0, F.col("w"))).repartition(5)  # long stretches of NULLs
    expect = {}
    for own in _in_order(df.collect(), ["pid", "flow"], "ts", "id"):
        for i, r in enumerate(own):
            pick = lambda c: next((x[c] for x in [*own[i:], *own[:i][::-1]] if x[c] is not None), None)  # noqa: E731,B023
            expect[r["id"]] = (pick("v"), pick("w"))
    _cut_finely(monkeypatch)
    for hot_rows, max_cuts in ((2, 100_000), (40, 100_000), (2, 5), (10**9, 100_000)):
        got = fill_updown(df, ["pid", "flow"], [F.col("ts"), F.col("id")], ["v", "w"], hot_rows=hot_rows, max_cuts=max_cuts)
        assert {r["id"]: (r["v"], r["w"]) for r in got.collect()} == expect and got.columns == df.columns


def test_fill_looks_at_each_row_once(spark):
    """No frame that is built anew for every row: one long group (the rows without person and flow) is filled in
    time that grows with its rows.  Rows equal in the order are filled from each other."""
    n, every = 30_000, 1_000
    df = spark.range(n).select(F.col("id"), F.lit(None).cast("long").alias("flow"),
                               F.when((F.col("id") % every == 0) & (F.col("id") > 0), F.col("id")).alias("v"))
    out = fill_updown(df, ["flow"], [F.col("id")], ["v"])
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "unboundedfollowing" not in plan.replace("unboundedpreceding$(), unboundedfollowing", "whole")
    last = (n - 1) // every * every
    assert [r["v"] for r in out.orderBy("id").collect()] == [min(max(every, -(-i // every) * every), last) for i in range(n)]
    tied = spark.createDataFrame([(1, None, None), (1, "x", None), (1, None, "y"), (1, None, None)], "t int, v string, w string")
    for hot_rows in (2, 10**9):
        got = fill_updown(tied, [], [F.col("t")], ["v", "w"], hot_rows=hot_rows).collect()
        assert [(r["v"], r["w"]) for r in got] == [("x", "y")] * 4


def test_one_second_of_one_flow_is_spread(spark):
    """A flow with all its rows in one second, and a NULL one, are cut evenly; small flows are not; no job runs meanwhile."""
    import datetime as dt

    from funnelspark.operators import window_ops

    ids = spark.range(6000).repartition(7)
    df = ids.select("id", F.when(F.col("id") < 4000, F.lit(1)).when(F.col("id") < 5000, F.lit(None)).otherwise(F.col("id")).cast("long").alias("flow"),
                    F.lit(dt.datetime(2024, 1, 1, 9)).alias("ts"), F.concat(F.lit("v"), "id").alias("v"))
    order = [F.col("ts"), F.col("id")]
    chunks = window_ops._chunked(df, ["flow"], order, 160).groupBy("flow", "_chunk").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    by = {}
    for r in chunks.collect():
        by.setdefault(r["flow"], []).append(r)
    assert len(by[1]) > 12 and max(r["n"] for r in by[1]) < 1000 and len(by[None]) > 3
    assert all(len(own) == 1 for f, own in by.items() if f not in (1, None))
    in_order = sorted(by[1], key=lambda r: r["_chunk"])
    assert all(x["b"] < y["a"] for x, y in zip(in_order, in_order[1:]))  # chunks follow the order
    few = window_ops._chunked(df, ["flow"], order, 160, max_cuts=4).select("flow", "_chunk").distinct().where("_chunk > 0").count()
    assert 0 < few <= 4
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    lead = lead_within(df, "flow", order, "v", "nxt", hot_rows=160)
    fill = fill_updown(df, ["flow"], order, ["v"], hot_rows=160)
    assert len(jobs.getJobIdsForGroup(None)) == before
    assert lead.where("flow = 1 and nxt = concat('v', id + 1)").count() == 3999 and fill.count() == 6000


def test_quantiles_of_many_groups_by_shuffle(spark, monkeypatch):
    """The exact way beyond the broadcast's bound gives the same rows; the broadcast refuses there."""
    import random

    import pytest

    from funnelspark.operators import quantiles as Q

    r = random.Random(2)
    rows = [(r.choice([None, *range(80)]), r.choice([None, 0.0, -1.5, 3.0, r.uniform(-5, 900)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(5)
    probs = {"q25": 0.25, "median": 0.5}
    few = sorted(map(tuple, Q.exact_quantiles(df, ["k"], "v", probs).collect()), key=str)
    monkeypatch.setattr(Q, "MAX_GROUPS", 5)
    many = Q.exact_quantiles(df, ["k"], "v", probs, many_groups=True)
    assert sorted(map(tuple, many.collect()), key=str) == few and len(few) == 81
    with pytest.raises(Exception, match="many_groups"):
        Q.exact_quantiles(df, ["k"], "v", probs).collect()
