"""Versioned publishing: a run's tables appear together or not at all."""

import pytest

from funnelspark.plans import runs
from funnelspark.sources import publish as P


def n(spark, root, name, version=None):
    return P.read_published(spark, root, name, version).count()


def test_a_run_is_seen_whole(spark, tmp_path):
    root = str(tmp_path)
    assert P.publish(spark, {"a": lambda: spark.range(3), "b": lambda: spark.range(4)}, root) == 1

    def fails():
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):  # dies after its first table was written
        P.publish(spark, {"a": lambda: spark.range(30), "b": fails}, root)
    assert (n(spark, root, "a"), n(spark, root, "b")) == (3, 4) and P.versions(spark, root) == [1]
    assert P.publish(spark, {"a": lambda: spark.range(5), "b": fails}, root, only=["a"]) == 2  # b is neither built nor lost
    assert (n(spark, root, "a"), n(spark, root, "b")) == (5, 4)
    assert (n(spark, root, "a", 1), n(spark, root, "b", 1)) == (3, 4)


def test_readers_keep_their_version(spark, tmp_path):
    root = str(tmp_path)
    P.publish(spark, {"a": lambda: spark.range(3)}, root)
    held = P.read_published(spark, root, "a")
    P.publish(spark, {"a": lambda: spark.range(9)}, root)
    assert held.count() == 3 and n(spark, root, "a") == 9


def test_vacuum_removes_what_no_kept_version_names(spark, tmp_path):
    root = str(tmp_path)
    for k in range(4):
        P.publish(spark, {"a": lambda: spark.range(k), "b": lambda: spark.range(k + 1)}, root, only=["a"] if k else None)
    (tmp_path / "versions" / "unfinished" / "a").mkdir(parents=True)
    gone = P.vacuum(spark, root, keep=2)
    assert "unfinished" in gone and len(gone) == 2 and P.versions(spark, root) == [3, 4]
    assert (n(spark, root, "a"), n(spark, root, "a", 3), n(spark, root, "b")) == (3, 2, 1)  # b is still that of the first run


def test_two_runs_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    root, real, raced = str(tmp_path), P.versions, []

    def slow(spark_, root_):  # another run commits between looking and creating
        seen = real(spark_, root_)
        if not raced:
            raced.append(1)
            P._commit(spark, root, {"a": "versions/x/a"})
        return seen
    monkeypatch.setattr(P, "versions", slow)
    assert P._commit(spark, root, {"b": "versions/y/b"}) == 2
    assert P.manifest(spark, root) == {"a": "versions/x/a", "b": "versions/y/b"}


def test_nothing_published(spark, tmp_path):
    assert P.versions(spark, str(tmp_path)) == [] and P.manifest(spark, str(tmp_path)) == {} and P.vacuum(spark, str(tmp_path)) == []
    with pytest.raises(ValueError):
        P.read_published(spark, str(tmp_path), "a")


def test_tables_of_a_run_are_built_when_asked_for():
    tables = runs.report_tables(None, None)  # no frame is touched
    assert list(tables) == ["report_period", "report_dropoff", "report_addtl", "report_ban", "report_trend", "report_searches"]
    assert list(runs.dashboard_tables(None, None, None)) == ["wkly_ban", "wkly_device_origin", "wkly_duration", "wkly_dropoff"]
