"""The streaming pipeline: messages to bronze, bronze to dead letters, sessions and the live feed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlode.functions.parse import add_ingestion_columns, decode_messages, parse_events
from eventlode.operators import sessions, validate
from eventlode.operators.dedup import keep_first_streaming
from eventlode.schemas import (
    BRONZE, BRONZE_TRIGGER, DEAD_LETTER_TRIGGER, FEED_TRIGGER, SESSION_WINDOW, SILVER_TRIGGER, WATERMARK_DELAY,
)
from eventlode.sources.streams import bronze_stream
from eventlode.streaming.compact import TARGET_BYTES, CompactedTable
from eventlode.streaming.late import punctual, split_late
from eventlode.streaming.run import finish, start_parquet, supervise, with_trigger


@dataclass(frozen=True)
class Lake:
    """Folders of one deployment. Every query has a checkpoint of its own."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{name}"


def bronze_rows(messages: DataFrame) -> DataFrame:
    return add_ingestion_columns(parse_events(decode_messages(messages))).select(*BRONZE.names)


def ingest_bronze(messages: DataFrame, lake: Lake, trigger: str = BRONZE_TRIGGER,
                  files_per_partition: int = 0) -> StreamingQuery:
    """Parsed messages, with their raw text, partitioned by date and event type.

    A live batch holds a date or two and is written as it arrives. A backlog holds many dates, and
    every task would open a file in every folder; ``files_per_partition`` first gathers each folder's
    rows in that many tasks, split evenly by a hash of the text so that no busy folder is one task.
    """
    rows = bronze_rows(messages)
    if files_per_partition:
        part = F.pmod(F.xxhash64("raw_value", "kafka_key"), F.lit(files_per_partition))
        rows = rows.repartition("date", "event_type", part)
    return start_parquet(rows, lake.table("bronze"), lake.checkpoint("bronze"), trigger, "bronze",
                         ("date", "event_type"))


def compacted_bronze(spark: SparkSession, lake: Lake, target_bytes: int = TARGET_BYTES) -> CompactedTable:
    return CompactedTable(spark, lake.table("bronze"), lake.table("bronze_packed"), BRONZE, ("date", "event_type"), target_bytes)


def route_dead_letters(routed: DataFrame, lake: Lake, trigger: str = DEAD_LETTER_TRIGGER) -> StreamingQuery:
    return start_parquet(validate.dead_letters(routed), lake.table("dead_letters"), lake.checkpoint("dead_letters"),
                         trigger, "dead_letters")


def watermarked(valid: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    return valid.withWatermark("event_timestamp", delay)


def write_sessions(valid: DataFrame, lake: Lake, trigger: str = SILVER_TRIGGER, delay: str = WATERMARK_DELAY,
                   window: str = SESSION_WINDOW, kind: str = "tumbling", parts: int = 1, slide: str | None = None,
                   state_partitions: int | None = None) -> StreamingQuery:
    """Deduplicated sessions of a stream of valid events, written once their window has closed."""
    unique = keep_first_streaming(watermarked(valid, delay))
    if kind == "tumbling":
        rows = sessions.tumbling_sessions_streaming(unique, window, slide, parts)
    elif kind == "gap":
        rows = sessions.gap_sessions_streaming(unique, window).withColumn(
            "date", F.to_date("session_start").cast("string")
        )
    else:
        raise ValueError(f"unknown session kind {kind!r}")
    return start_parquet(rows, lake.table(f"silver_{kind}"), lake.checkpoint(f"silver_{kind}"), trigger,
                         f"silver_{kind}", ("date",), state_partitions)


def feed_rows(valid: DataFrame) -> DataFrame:
    """Key and JSON value of every valid event, repeats included."""
    return valid.select(F.col("user_id").cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def publish_feed(valid: DataFrame, lake: Lake, trigger: str = FEED_TRIGGER, sink: str = "parquet",
                 **options: str) -> StreamingQuery:
    """Republish valid events for live readers, to a topic (``sink='kafka'`` and its options) or to files."""
    rows = feed_rows(valid)
    if sink != "kafka":
        return start_parquet(rows, lake.table("feed"), lake.checkpoint("feed"), trigger, "feed")
    writer = rows.writeStream.format("kafka").queryName("feed").option("checkpointLocation", lake.checkpoint("feed"))
    for key, value in options.items():
        writer = writer.option(key, value)
    return with_trigger(writer, trigger).start()


def process_silver(spark: SparkSession, lake: Lake, trigger: str | None = None, strict: bool = True,
                   kind: str = "tumbling", delay: str = WATERMARK_DELAY, window: str = SESSION_WINDOW,
                   parts: int = 1, feed: bool = True, feed_sink: str = "parquet", feed_options: dict | None = None,
                   state_partitions: int | None = None, keep_late: bool = False) -> list[StreamingQuery]:
    """Queries over bronze: dead letters, sessions, and the live feed.

    With ``keep_late`` a query of its own first splits off the rows that sessions would drop (see ``streaming.late``), and
    sessions read the others.
    """
    routed = validate.route(bronze_stream(spark, lake.table("bronze")), strict)
    valid = validate.accepted(routed)
    queries = [route_dead_letters(routed, lake, trigger or DEAD_LETTER_TRIGGER)]
    timely = valid
    if keep_late:
        path = lake.table("by_lateness")
        queries.append(split_late(valid, path, lake.checkpoint("by_lateness"), trigger or SILVER_TRIGGER, delay))
        if trigger == "available_now":
            finish(queries[-1:])
        timely = punctual(spark, path, valid.schema)
    queries.append(write_sessions(timely, lake, trigger or SILVER_TRIGGER, delay, window, kind, parts,
                                  state_partitions=state_partitions))
    if feed:
        queries.append(publish_feed(valid.drop("event_timestamp"), lake, trigger or FEED_TRIGGER, feed_sink,
                                    **(feed_options or {})))
    return queries


MODES = ("bronze", "silver", "both")


def run_stream(spark: SparkSession, messages: DataFrame | None, lake: Lake, mode: str = "both",
               trigger: str | None = None, files_per_partition: int = 0, **silver: object) -> None:
    """Run bronze, silver or both until stopped; with ``available_now`` until the input is used up."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if trigger == "available_now":
        # Silver reads what bronze wrote, so bronze has to be done first.
        if mode != "silver":
            finish([ingest_bronze(messages, lake, trigger, files_per_partition)])
        if mode != "bronze":
            finish(process_silver(spark, lake, trigger, **silver))
        return
    queries = []
    if mode != "silver":
        queries.append(ingest_bronze(messages, lake, trigger or BRONZE_TRIGGER, files_per_partition))
    if mode != "bronze":
        queries.extend(process_silver(spark, lake, trigger, **silver))
    supervise(queries)
