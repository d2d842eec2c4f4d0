"""Publishing the tables of a run as one version.

A run writes its tables below ``versions/<id>`` and then commits them all by one
manifest, a small file that names the folder of every table.  Readers resolve
the newest manifest, so they see the tables of one run, whole: a run that dies
half-way leaves the version before it in place.  Manifests are numbered, and a
number is taken by whoever creates its file first; the other run tries the next.
Tables that a run does not write are carried over from the version before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_folder

Table = Callable[[], DataFrame]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, the oldest first."""
    fs, folder = _fs(spark, f"{root}/manifests")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Table -> folder of a version (default: the newest; no version: nothing)."""
    known = versions(spark, root)
    if version is None:
        if not known:
            return {}
        version = known[-1]
    fs, path = _fs(spark, f"{root}/manifests/{version:08d}.json")
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _commit(spark: SparkSession, root: str, tables: Mapping[str, str]) -> int:
    """Create the next manifest; never over another run's."""
    fs, draft = _fs(spark, f"{root}/manifests/.{uuid.uuid4().hex}")
    while True:
        before = versions(spark, root)
        merged = {**manifest(spark, root, before[-1] if before else None), **tables}
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(merged, indent=1, sort_keys=True).encode()))
        out.close()
        number = before[-1] + 1 if before else 1
        _, target = _fs(spark, f"{root}/manifests/{number:08d}.json")
        if not fs.exists(target) and fs.rename(draft, target):
            return number


def publish(spark: SparkSession, tables: Mapping[str, Table], root: str, only: Sequence[str] | None = None) -> int:
    """Build and write the tables of a run (``only`` those named) and commit
    them together; the version's number."""
    root, run = root.rstrip("/"), uuid.uuid4().hex
    chosen = [n for n in tables if only is None or n in only]
    for name in chosen:
        tables[name]().write.parquet(f"{root}/versions/{run}/{name}")
    return _commit(spark, root, {name: f"versions/{run}/{name}" for name in chosen})


def read_published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table of a version (default: the newest)."""
    root = root.rstrip("/")
    folders = manifest(spark, root, version)
    if name not in folders:
        raise ValueError(f"{name} is not published; there are {sorted(folders)}")
    return spark.read.parquet(f"{root}/{folders[name]}")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the versions before the last ``keep``, and folders of runs that no
    kept version names (also of a run that is still writing: call it between
    runs).  Returns the folders removed."""
    root = root.rstrip("/")
    known = versions(spark, root)
    used = {f.split("/")[1] for v in known[-keep:] for f in manifest(spark, root, v).values()}
    fs, folder = _fs(spark, f"{root}/versions")
    gone = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    gone = [n for n in gone if n not in used]
    for v in known[:-keep]:
        delete_folder(spark, f"{root}/manifests/{v:08d}.json")
    for n in gone:
        delete_folder(spark, f"{root}/versions/{n}")
    return gone
