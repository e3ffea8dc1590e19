"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Text timestamps are rendered and parsed in the session zone, so it is pinned.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key of a join even where that costs an exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def spark_session(app_name: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the run-time settings on a session someone else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the session's checkpoint folder.

    A local session without one gets a fresh temporary folder. On a cluster a
    machine-local folder would lose data with its machine, so there it is an error.
    """
    context = spark.sparkContext
    root = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def store(df: DataFrame, label: str = "stage") -> str:
    """Write ``df`` to a new folder under the scratch folder as Parquet; its path."""
    path = f"{scratch_root(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for stages in _open_scopes:
        stages.append(path)
    return path


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage, so values that depend on how rows were partitioned stay fixed
    for every later reader, and keeps column pruning and min/max row-group skipping.
    """
    return df.sparkSession.read.schema(df.schema).parquet(store(df, label))


_open_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Removes the stages stored inside it when it ends, also after an error.

    Results that read them must be written or collected before that.
    """
    stages: list[str] = []
    _open_scopes.append(stages)
    try:
        yield stages
    finally:
        # By identity: lists of equal content are equal.
        _open_scopes[:] = [s for s in _open_scopes if s is not stages]
        paths = spark._jvm.org.apache.hadoop.fs.Path
        for stage in stages:
            path = paths(stage)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
