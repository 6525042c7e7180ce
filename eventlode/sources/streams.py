"""Stream sources and sinks. The format is an argument: Kafka in production, files elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlode.schemas import BRONZE, EVENT_JSON

# Options of the broker source
KAFKA_SOURCE_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of one topic, from the earliest offset unless told otherwise."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    for key, value in {**KAFKA_SOURCE_OPTIONS, **options}.items():
        reader = reader.option(key, value)
    return reader.load()


def live_messages(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Messages of the republished feed from now on, for live readers.

    Every reader sees the whole feed: the source assigns partitions itself, readers share no group.
    """
    return kafka_messages(spark, servers, topic, startingOffsets="latest")


def file_stream(spark: SparkSession, path: str, layout: T.StructType, file_format: str = "parquet",
                **options: str) -> DataFrame:
    reader = spark.readStream.format(file_format).schema(layout)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def bronze_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The bronze table as a stream, with its layout stated so nothing is inferred."""
    return file_stream(spark, path, BRONZE, **options)


def decode_feed(messages: DataFrame) -> DataFrame:
    """Decode the republished feed (key, value JSON) back into event columns."""
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.from_json(F.col("value").cast("string"), EVENT_JSON).alias("event"),
    ).select("key", "event.*")
