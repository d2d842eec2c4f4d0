"""Incremental export landing: only new files, repeated events dropped."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from funnelspark.sources.tables import read_landed
from funnelspark.streaming import ingest_exports


def _write(dir_, name, events):
    with open(os.path.join(dir_, name), "w") as f:
        for e in events:
            f.write(json.dumps(e) + "\n")


def _ev(i, day, event="ApplicantViewedAgreement"):
    return {"event": event, "properties": {"event_id": str(i), "timestamp": f"2024-01-{day:02d} 10:00:00",
                                           "distinct_id": f"u{i}", "cbv_flow_id": f"10{i}"}}


def test_incremental_landing_deduplicates(spark):
    root = tempfile.mkdtemp(prefix="funnelspark-stream-")
    src, land, ckpt = (os.path.join(root, d) for d in ("exports", "landing", "ckpt"))
    os.makedirs(src)
    _write(src, "a.json", [_ev(1, 1), _ev(2, 2), _ev(3, 3)])
    ingest_exports(spark, src, land, ckpt, "tst")
    assert read_landed(spark, land).count() == 3
    # An overlapping export repeats events 2 and 3 and adds 4 and 5.
    _write(src, "b.json", [_ev(2, 2), _ev(3, 3), _ev(4, 4), _ev(5, 5)])
    ingest_exports(spark, src, land, ckpt, "tst")
    landed = read_landed(spark, land)
    assert sorted(r[0] for r in landed.select("event_id").collect()) == ["1", "2", "3", "4", "5"]
    # Nothing new: a third run lands nothing.
    ingest_exports(spark, src, land, ckpt, "tst")
    assert read_landed(spark, land).count() == 5
    assert landed.where(F.col("client_agency") == "tst").select("event_date").distinct().count() == 5


def test_late_text_and_missing_ids_are_landed(spark):
    root = tempfile.mkdtemp(prefix="funnelspark-stream-")
    src, land, ckpt = (os.path.join(root, d) for d in ("exports", "landing", "ckpt"))
    os.makedirs(src)
    recent = [_ev(f"id-{i}", 10 + i) for i in range(5)]
    for e in recent:
        e["properties"]["timestamp"] = e["properties"]["timestamp"].replace("2024-01", "2024-06")
    _write(src, "june.json", recent)
    ingest_exports(spark, src, land, ckpt, "tst")
    # An older pilot's export arrives second; it repeats nothing and is landed whole.
    old = [_ev(f"old-{i}", 1 + i) for i in range(5)]
    blank = _ev("x", 9)
    del blank["properties"]["event_id"]
    _write(src, "january.json", old + [old[0]] + [blank, blank])
    ingest_exports(spark, src, land, ckpt, "tst")
    ids = sorted(r[0] or "" for r in read_landed(spark, land).select("event_id").collect())
    assert ids == ["", "", *sorted([f"id-{i}" for i in range(5)] + [f"old-{i}" for i in range(5)])]
