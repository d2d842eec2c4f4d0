"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a report job wants on any cluster: adaptive execution (coalesces the
# many small post-aggregation partitions, splits skewed join partitions) and a
# fixed session zone so dates never depend on where the driver runs.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # The driver keeps per-query plan graphs and job/stage records for the
    # status store; report jobs run many multi-stage queries in one application,
    # so keep that history short.
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "funnelspark",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; only when it is unset (tests) set our own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # Executors must see the folder and it must outlive them.
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder (HDFS/object store)")
        import tempfile

        configured = fallback or tempfile.mkdtemp(prefix="funnelspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table inside the shared folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def written_once(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back, for several uses that
    are over at the end of the block; the table is removed then."""
    spark, path = df.sparkSession, shared_table_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)


def file_stamp(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """(length, modification time) of a file or folder in any store Hadoop
    knows; None if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    status = fs.getFileStatus(p)
    return status.getLen(), status.getModificationTime()
