"""Distinct users per day that can be merged: stored days and a live stream share users, and none may count twice.

Two forms are kept beside the daily mart. *Key sets* are exact, a row per day and user. *Sketches* are a row per day of a
fixed size whatever the number of users; merging two gives the sketch of all their users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from eventlode.sources.batches import BatchFolders
from eventlode.sources.tables import ParquetStore
from eventlode.streaming.run import start_parquet, state_settings, with_trigger

# log2 of a sketch's registers. 12 keeps a day in 4 KB with a standard error of about 1.6 %.
SKETCH_BITS = 12
KEYS, SKETCHES = "active_user_keys", "active_user_sketches"
KEYS_LAYOUT = T.StructType().add("user_id", "string").add("day", "date")
SKETCHES_LAYOUT = T.StructType().add("day", "date").add("sketch", "binary")


def _user_days(events: DataFrame) -> DataFrame:
    return events.where(F.col("user_id").isNotNull() & F.col("event_timestamp").isNotNull()).select(
        F.to_date("event_timestamp").alias("day"), F.col("user_id").cast("string").alias("user_id")
    )


def day_keys(events: DataFrame) -> DataFrame:
    """Each day's users once. Equal rows meet in the map tasks first, so a busy user or day is spread."""
    return _user_days(events).distinct()


def count_keys(*parts: DataFrame) -> DataFrame:
    """Exact users per day over the key sets together."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.distinct().groupBy("day").agg(F.count("*").alias("users"))


def day_sketches(events: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """A sketch of each day's users. Tasks build and send a sketch per day, never the users."""
    return _user_days(events).groupBy("day").agg(F.hll_sketch_agg("user_id", bits).alias("sketch"))


def merge_sketches(*parts: DataFrame) -> DataFrame:
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("day").agg(F.hll_union_agg("sketch").alias("sketch"))


def count_sketches(sketches: DataFrame) -> DataFrame:
    return sketches.select("day", F.hll_sketch_estimate("sketch").alias("users"))


def store_load(store: ParquetStore, events: DataFrame, bits: int = SKETCH_BITS) -> None:
    """Add the users of one load to the stored key sets and sketches.

    Only keys that are not stored yet are appended, looked up among the days of the load alone. Sketches of one day from
    several loads are merged when they are read. A load that is repeated changes no count.
    """
    keys = day_keys(events)
    if store.exists(KEYS):
        days = [r.day for r in keys.select("day").distinct().collect()]
        known = store.read(KEYS, KEYS_LAYOUT).where(F.col("day").isin(days) if days else F.lit(False))
        keys = keys.join(known, ["day", "user_id"], "left_anti")
    store.append(KEYS, keys, ("day",))
    store.append(SKETCHES, day_sketches(events, bits))


def stored_keys(store: ParquetStore) -> DataFrame:
    return store.read(KEYS, KEYS_LAYOUT).select("day", "user_id")


def stored_sketches(store: ParquetStore) -> DataFrame:
    return merge_sketches(store.read(SKETCHES, SKETCHES_LAYOUT))


def keep_live_keys(events: DataFrame, path: str, checkpoint: str, trigger: str, delay: str = "1 day") -> StreamingQuery:
    """Append each (day, user) of a stream when it is first seen.

    State holds the pairs of about ``delay``, not of all time: a pair that comes again later is written again, and counts
    once when the keys are merged.
    """
    dated = events.withColumn("_day", F.to_date("event_timestamp")).withWatermark("event_timestamp", delay)
    pairs = _user_days(dated.dropDuplicatesWithinWatermark(["_day", "user_id"]))
    return start_parquet(pairs, path, checkpoint, trigger, "live_keys")


def keep_live_sketches(events: DataFrame, path: str, checkpoint: str, trigger: str, bits: int = SKETCH_BITS,
                       keep: int = 4) -> StreamingQuery:
    """Keep a sketch per day of a stream, replaced with every batch. State is a row per day."""
    sketches = day_sketches(events, bits)
    layout = sketches.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        BatchFolders(batch.sparkSession, path, layout, keep).write(batch, batch_id)

    writer = (
        sketches.writeStream.outputMode("complete").queryName("live_sketches").option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    with state_settings(events.sparkSession):
        return with_trigger(writer, trigger).start()


def patch_trend(trend: DataFrame, users: DataFrame) -> DataFrame:
    """The stored trend with each of its days' users over stored and live rows; days only seen live are added.

    ``trend`` has date (text) and daily_active_users, ``users`` day and users. Both have a row per day.
    """
    live = users.select(F.col("day").cast("string").alias("date"), "users")
    return trend.join(live, "date", "full").withColumn(
        "daily_active_users", F.coalesce("users", "daily_active_users")
    ).drop("users")
