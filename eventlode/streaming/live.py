"""Live counters over the republished feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from eventlode.sources.batches import BatchFolders
from eventlode.streaming.run import state_settings, with_trigger


def revenue(feed: DataFrame) -> DataFrame:
    """Running purchase revenue and count, from the payload of the decoded feed."""
    amount = F.expr("try_cast(payload['total_amount'] as decimal(15,2))")
    return feed.where(F.col("event_type") == "purchase").agg(
        F.coalesce(F.sum(amount), F.lit(0)).alias("live_revenue"), F.count("*").alias("purchases")
    )


def distinct_users(events: DataFrame) -> DataFrame:
    """Users seen since the stream began."""
    return events.where(F.col("user_id").isNotNull()).select("user_id").dropDuplicates(["user_id"]).agg(
        F.count("*").alias("live_users")
    )


def users_per_day(events: DataFrame, since: str | None = None) -> DataFrame:
    """Exact distinct users per day; state holds one row per (day, user) from ``since`` on.

    Streams cannot count distinct values directly, so pairs are first reduced to one each. Spread
    over the pairs, no task depends on how busy a day or a user is.
    """
    if since is not None:
        events = events.where(F.col("event_timestamp") >= F.lit(since).cast("timestamp"))
    pairs = events.where(F.col("user_id").isNotNull()).select(
        F.to_date("event_timestamp").alias("day"), "user_id"
    ).dropDuplicates(["day", "user_id"])
    return pairs.groupBy("day").agg(F.count("*").alias("live_users"))


def users_per_day_approx(events: DataFrame, error: float = 0.02) -> DataFrame:
    """Approximate distinct users per day, with state of a fixed size per day."""
    return events.groupBy(F.to_date("event_timestamp").alias("day")).agg(
        F.approx_count_distinct("user_id", error).alias("live_users")
    )


def keep_totals(totals: DataFrame, path: str, checkpoint: str, trigger: str, name: str, keep: int = 4) -> StreamingQuery:
    """Write the whole result of every batch; the newest ``keep`` results stay."""
    layout = totals.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        BatchFolders(batch.sparkSession, path, layout, keep).write(batch, batch_id)

    writer = (
        totals.writeStream.outputMode("complete").queryName(name).option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    with state_settings(totals.sparkSession):
        return with_trigger(writer, trigger).start()


def read_totals(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The newest result under ``path``; no rows before the first."""
    return BatchFolders(spark, path, layout).read()


def keep_recent(events: DataFrame, path: str, checkpoint: str, trigger: str, rows: int = 10, keep: int = 4) -> StreamingQuery:
    """Keep the ``rows`` most recent events: each batch is merged with what the batch before kept."""
    layout = events.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        store = BatchFolders(batch.sparkSession, path, layout, keep)
        both = batch.unionByName(store.read(before=batch_id))
        store.write(both.orderBy(F.desc("event_timestamp"), F.desc("event_id")).limit(rows), batch_id)

    writer = (
        events.writeStream.outputMode("append").queryName("recent").option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return with_trigger(writer, trigger).start()
