"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",  # bad text must fail a cast
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys even where a later step needs one more exchange for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Directories and batches of changed keys up to this size spare the ledger a shuffle.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # A small partition of tiles unfolds into many days: keep all cores busy with them.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}

_local_folders: dict[str, str] = {}
_scope: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def build_session(
    app_name: str = "slotledger", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings this package is tuned for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A local master may go without; a cluster may not, since a folder of one
    machine is lost with that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folders.setdefault(context.applicationId, tempfile.mkdtemp(prefix="slotledger-"))


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch of the steps inside once they are done.

    For steps that leave nothing but stored tables: frames built on scratch
    cannot be read afterwards.
    """
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            files, target = _hadoop(spark, path)
            files.delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; it goes with its scope or else the application."""
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is None:
        files, target = _hadoop(spark, path)
        files.deleteOnExit(target)
    else:
        scope.append(path)
    return path


def cut(df: DataFrame, label: str, by: str | None = None, gathered: bool = False) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and go on from the files.

    Everything that follows reads the same rows, however often and on whichever
    executors it runs, with column pruning and known sizes. ``by`` names a column
    of few values that later reads filter on; rows are first gathered by it, but not where
    they are ``gathered``, or a shuffle would cost more than a file for each task and value.
    """
    path = scratch_path(df.sparkSession, label)
    if by:
        (df if gathered else df.hint("rebalance", by)).write.partitionBy(by).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
