"""Starting and supervising streaming queries."""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None):
    """Settings a query freezes when it first starts: where state lives and over how many partitions.

    The partition count of a stateful query cannot change later, so it is chosen here, one per core
    of the cluster unless given, and not left to the batch setting.
    """
    wanted = dict(_STATE_CONF)
    wanted["spark.sql.shuffle.partitions"] = str(partitions or spark.sparkContext.defaultParallelism)
    saved = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in saved.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def with_trigger(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    """``available_now`` reads what is there and ends; anything else is a processing-time interval."""
    return writer.trigger(availableNow=True) if trigger == "available_now" else writer.trigger(processingTime=trigger)


def start_parquet(df: DataFrame, path: str, checkpoint: str, trigger: str, name: str,
                  partition_by: tuple[str, ...] = (), state_partitions: int | None = None) -> StreamingQuery:
    """Append a stream to a Parquet table. The checkpoint makes every batch land exactly once."""
    writer = (
        df.writeStream.format("parquet").outputMode("append").queryName(name)
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with state_settings(df.sparkSession, state_partitions):
        return with_trigger(writer, trigger).start()


def finish(queries: list[StreamingQuery]) -> None:
    """Wait for queries that end by themselves; the first failure is raised."""
    for query in queries:
        query.awaitTermination()


def supervise(queries: list[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Run until any query ends or fails, then stop the others and raise the failure.

    Watching all of them at once matters: waiting on one after another would leave a query that
    fails early unseen while the first runs on.
    """
    try:
        while all(query.isActive for query in queries):
            time.sleep(poll_seconds)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    for query in queries:
        if query.exception() is not None:
            raise query.exception()
