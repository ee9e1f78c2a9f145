"""Session settings, and the shared scratch folder used to cut lineage or stage files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on at scale. Join sides are broadcast by Spark's own size check
# (static statistics, then AQE's measured shuffle sizes); hot keys are split by AQE's skew join,
# also where that costs one extra exchange.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # streaming state on local disk with checkpointed changes, not on the executors' heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "kpimill", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else the context's checkpoint dir.

    Only a local-mode session without either gets a temporary folder; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="kpimill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing exists there yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """The tables staged inside a ``scratch_scope``; those named by ``keep`` outlive it."""

    def __init__(self):
        self.paths: list[str] = []

    def keep(self, path: str) -> None:
        self.paths.remove(path)
        outer = _scopes[: _scopes.index(self)][-1:]
        for scope in outer:
            scope.paths.append(path)


_scopes: list[Scratch] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scratch]:
    """Remove at the end what was staged inside: ``with scratch_scope(spark): query(spark, sf).write.parquet(out)``.

    A frame that reads staged tables must be written before the scope ends. Scopes nest; what an inner one keeps belongs to
    the outer one.
    """
    scope = Scratch()
    _scopes.append(scope)
    try:
        yield scope
    finally:
        _scopes.remove(scope)
        discard(spark, *scope.paths)


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table once to the shared folder; gives it back with its path, for ``discard`` when its result is written."""
    path = scratch_path(df.sparkSession, name)
    for scope in _scopes[-1:]:
        scope.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove staged tables that nothing reads any more."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared folder and read it back.

    Lineage ends there, lost executors cost nothing, and the plan that uses the table sees its true size, so
    Spark's own check decides whether it is broadcast.
    """
    return staged(df, name)[0]
