"""Time, device and event-type dimensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlode.functions.calendar import CALENDAR_END, CALENDAR_START, calendar_columns
from eventlode.functions.inline import inline_rows
from eventlode.schemas import DEVICE_ROWS, DIM_DEVICE, DIM_EVENT_TYPE, EVENT_TYPE_ROWS


def time_dimension(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per hour from ``start`` to ``end``, both included."""
    hours = int((datetime.fromisoformat(end) - datetime.fromisoformat(start)).total_seconds()) // 3600 + 1
    first = F.unix_seconds(F.lit(start).cast("timestamp"))
    ids = spark.range(0, hours, 1, numPartitions=8)
    return calendar_columns(ids.select(F.timestamp_seconds(first + F.col("id") * 3600).alias("full_timestamp")))


def hours_of(events: DataFrame, column: str = "event_timestamp") -> DataFrame:
    """Time-dimension rows of the hours that occur in ``column``."""
    hours = events.select(F.date_trunc("hour", column).alias("full_timestamp")).where("full_timestamp is not null")
    return calendar_columns(hours.distinct())


def device_dimension(spark: SparkSession) -> DataFrame:
    rows = [(key, *row) for key, row in enumerate(DEVICE_ROWS, start=1)]
    listed = inline_rows(
        spark,
        rows,
        "device_key int, device_type string, device_category string, os_family string, browser_family string, "
        "is_mobile boolean, is_tablet boolean, is_desktop boolean",
    )
    return (
        listed.withColumn("os_version", F.lit(None).cast("string"))
        .withColumn("browser_version", F.lit(None).cast("string"))
        .withColumn("created_at", F.current_timestamp())
        .withColumn("updated_at", F.current_timestamp())
        .select(*DIM_DEVICE.names)
    )


def event_type_dimension(spark: SparkSession) -> DataFrame:
    rows = [(key, *row) for key, row in enumerate(EVENT_TYPE_ROWS, start=1)]
    listed = inline_rows(
        spark,
        rows, "event_type_key int, event_type string, event_category string, description string"
    )
    return (
        listed.withColumn("is_active", F.lit(True)).withColumn("created_at", F.current_timestamp())
        .select(*DIM_EVENT_TYPE.names)
    )


def absent_from(existing: DataFrame, offered: DataFrame, natural_key: list[str]) -> DataFrame:
    """Offered rows whose natural key the table does not hold yet (insert if absent)."""
    return offered.join(existing.select(*natural_key), natural_key, "left_anti")


def canonical_devices(dim_device: DataFrame) -> DataFrame:
    """One device row per type, the smallest key, so that looking up a type never multiplies rows."""
    return dim_device.groupBy("device_type").agg(F.min("device_key").alias("device_key"))


def lookup_device(events: DataFrame, dim_device: DataFrame) -> DataFrame:
    """Add ``device_key``; a type without a row of its own gets the ``unknown`` device."""
    canonical = canonical_devices(dim_device)
    own = canonical.select(F.col("device_type").alias("_type"), F.col("device_key").alias("_own"))
    spare = canonical.select(F.col("device_type").alias("_spare_type"), F.col("device_key").alias("_spare"))
    fallback = F.when(F.col("_own").isNull(), "unknown")
    return (
        events.join(own, F.col("device_type") == F.col("_type"), "left")
        .join(spare, fallback == F.col("_spare_type"), "left")
        .withColumn("device_key", F.coalesce("_own", "_spare"))
        .drop("_type", "_own", "_spare_type", "_spare")
    )


def lookup_time(events: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Add the ``time_key`` of the event's hour; NULL outside the calendar."""
    hours = dim_time.select("time_key", F.col("full_timestamp").alias("_hour"))
    return events.join(hours, F.date_trunc("hour", "event_timestamp") == F.col("_hour"), "left").drop("_hour")


def lookup_user(events: DataFrame, dim_user: DataFrame) -> DataFrame:
    """Add the ``user_key`` of the user's current row; NULL for an unknown user."""
    current = dim_user.where("is_current").select(F.col("user_id").alias("_user"), "user_key")
    return events.join(current, F.col("user_id") == F.col("_user"), "left").drop("_user")


def lookup_event_type(events: DataFrame, dim_event_type: DataFrame) -> DataFrame:
    kinds = dim_event_type.select(F.col("event_type").alias("_kind"), "event_type_key", "event_category")
    return events.join(kinds, F.col("event_type") == F.col("_kind"), "left").drop("_kind")


def lookup_product(events: DataFrame, dim_product: DataFrame) -> DataFrame:
    products = dim_product.select(F.col("product_id").alias("_product"), "product_key")
    return events.join(products, F.col("product_id") == F.col("_product"), "left").drop("_product")
