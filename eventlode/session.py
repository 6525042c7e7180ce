"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session. Shuffle parallelism is left to the cluster:
# adaptive execution coalesces or splits whatever value it is given.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Gap sessions are merged inside each map task before they are shuffled, so one busy user
    # sends a handful of partial sessions instead of every event.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_base: str | None = None


def build_session(app_name: str = "eventlode", master: str | None = None, **conf: str) -> SparkSession:
    """Start a session. Keyword arguments are extra settings with ``__`` standing for a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _RUNTIME_CONF.items():
        builder = builder.config(key, value)
    # Recording the call site of every column expression slows plan building down noticeably.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    builder = builder.config("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    builder = builder.config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the library relies on to a session somebody else built."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster the executors would not
    see it, so a missing setting is an error there.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="eventlode-")
        base = _local_base
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    Used where rows feed several branches of a plan: they are computed once, and losing an executor
    later costs a re-read instead of a recomputation.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
