"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.session import shared_table_path

#: Text handled at once inside a Python task: bounds the worker's memory
#: whatever the size of an Arrow batch.
BLOCK_BYTES = 2 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: they need
    not have it installed, nor share the driver's working folder."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    import funnelspark

    root = os.path.dirname(os.path.abspath(funnelspark.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="funnelspark-ship-"), "funnelspark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_table_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: str | Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (NULL id: the empty text)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(m))


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes of ``column``
    (one row at least; rows are never cut)."""
    n = batch.num_rows
    if n == 0:
        return
    arr = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(arr), 0).to_pylist()
    lo, held = 0, 0
    for i, s in enumerate(sizes):
        if i > lo and held + s > limit:
            yield batch.slice(lo, i - lo)
            lo, held = i, 0
        held += s
    yield batch.slice(lo, n - lo)


def chosen_ids(labelled: DataFrame, per_class: int) -> list[tuple[int, object]]:
    """For each class of ``labelled`` (id, class; an id once) the ``per_class``
    ids that come first by hash.  Classes are counted, ids below a cutoff of the
    hash that holds a few more than wanted are collected, and the surplus goes
    here: nothing is ranked by class on the cluster, and the choice is the same
    under any partitioning.  At most about ``per_class`` ids a class come here."""
    n = {r[0]: r[1] for r in labelled.groupBy("class").count().collect()}
    few = 6 * int(per_class**0.5) + 20  # more than chance ever leaves short
    h, below = F.xxhash64("id"), F.lit(False)
    for c, count in n.items():
        edge = min((1 << 63) - 1, int((1 << 64) * min(1.0, (per_class + few) / count)) - (1 << 63))
        below = below | ((F.col("class") == F.lit(c)) & (h <= F.lit(edge)))
    out: list[tuple[int, object]] = []
    rows = sorted((r["class"], r["h"], r["id"]) for r in labelled.where(below).select("class", h.alias("h"), "id").collect())
    for c in n:
        out += [(i, k) for k, _, i in [r for r in rows if r[0] == c][:per_class]]
    return out


def texts_of(docs: DataFrame, ids: list[tuple[int, object]]) -> list[tuple]:
    """(id, text, class) of the ids, sorted; of an id's texts the least."""
    if not ids:
        return []
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(i,) for i, _ in ids], "_id long")  # as many as were chosen
    rows = (docs.select("doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("_id"))
            .groupBy("_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).collect())
    of = dict(ids)
    return sorted((r["_id"], r["text"], of[r["_id"]]) for r in rows)


def one_class(rows: DataFrame, column: str) -> DataFrame:
    """id, class of the ids that have one value of ``column``; ids with several
    (and NULL ids and values) are nothing to learn from."""
    known = rows.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    return (known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min(column).alias("class"), F.max(column).alias("_most"))
            .where(F.col("class") == F.col("_most")).drop("_most"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int, used: Column) -> tuple[list, dict[int, int]]:
    """A bounded, deterministic sample of rows labelled 0 or 1 among the rows
    where ``used`` holds: (doc_id, text, label) of ``per_class`` ids per label,
    whole texts; and the number of usable ids of each label.  Other label values
    are not used."""
    labelled = one_class(labels.where(used & F.col(label).isin(0, 1)).withColumn(label, F.col(label).cast("int")), label)
    share = {r[0]: r[1] for r in labelled.groupBy("class").count().collect()}
    return texts_of(docs, chosen_ids(labelled, per_class)), share
