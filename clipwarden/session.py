"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[str | None] = ContextVar("scratch scope", default=None)


def build_session(app: str = "clipwarden", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators expect; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # pixel rows are large: this bounds what a Python worker holds at a time
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    }
    defaults.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if root is None and sc.getCheckpointDir() is not None:
        root = sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="spark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, or under the folder of the scope that is open."""
    root = _scope.get() or shared_dir(spark)
    return f"{root.rstrip('/')}/clipwarden-{uuid.uuid4().hex}/{name}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Scratch tables and checkpoints written inside are deleted at the end.

    Store results before that: a frame built inside may still read them.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/scope-{uuid.uuid4().hex}"
    sc = spark.sparkContext
    before, token = sc.getCheckpointDir(), _scope.set(folder)
    sc.setCheckpointDir(f"{folder}/checkpoints")
    try:
        yield folder
    finally:
        _scope.reset(token)
        # Spark appends a folder of its own to a checkpoint folder
        sc.setCheckpointDir(before.rsplit("/", 1)[0])
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder; its partitions and their order stay fixed from here on."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
