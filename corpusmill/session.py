"""Session helpers: builder defaults and the shared scratch folder.

Lineage is cut either with ``DataFrame.checkpoint`` or with a table written
under the folder the cluster names in ``spark.checkpoint.dir``.  Both survive
the loss of executors; nothing here keeps state only in executor memory.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "corpusmill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on and a pinned UTC time zone."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster's ``spark.checkpoint.dir`` wins.  A temporary folder is made
    only for a local master, where every task sees the same disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        sc = spark.sparkContext
        existing = sc._jsc.sc().getCheckpointDir()
        if existing.isDefined():
            return existing.get()
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="corpusmill-")
        sc.setCheckpointDir(root)
    elif not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run of one named intermediate table."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable eager checkpoint; keeps the partitioning of the plan it ends."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str, folder: str | None = None, codec: str | None = None) -> DataFrame:
    """Write once as Parquet, read back: later readers prune its columns.  With ``folder``, in one that the caller deletes."""
    path = f"{folder}/{name}" if folder else scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries made inside delete their shuffle files when they end.

    For loops of many small queries that each write what the next one reads:
    else the files of all rounds stay until the driver collects garbage.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rebalance a scan with fewer splits than cores before per-row heavy work.

    On a large table the scan already has enough splits and nothing moves.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, key)
    return df


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that a newer one replaces; only inside the scratch folder."""
    if not path.startswith(scratch_root(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not a scratch table")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
