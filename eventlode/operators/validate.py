"""Required-field validation, dead-letter routing and registry checks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventlode.functions.inline import inline_rows
from eventlode.functions.parse import event_time
from eventlode.schemas import DEAD_LETTER_REASON, REGISTRY_ENVELOPE, REGISTRY_PAYLOAD, REQUIRED_FIELDS


def has_required_fields(fields: list[str] = REQUIRED_FIELDS) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in fields])


def split_valid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) by the required fields; together they are the input, with no overlap."""
    return events.where(has_required_fields()), events.where(~has_required_fields())


def missing_of(fields: list[str]) -> Column:
    """Names of the columns that are NULL."""
    return F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in fields]))


def route(events: DataFrame, strict: bool = True) -> DataFrame:
    """Add ``dlq_reason`` (NULL for rows to keep), ``missing_fields`` and ``event_timestamp``.

    With ``strict`` a text that is not a believable event time is a reason of its own. Without it
    such rows pass, as the required-field rule alone would have it.
    """
    timed = events.withColumn("event_timestamp", event_time("timestamp"))
    reason = F.when(~has_required_fields(), DEAD_LETTER_REASON)
    if strict:
        reason = reason.when(F.col("event_timestamp").isNull(), "invalid_timestamp")
    return timed.withColumn("missing_fields", missing_of(REQUIRED_FIELDS)).withColumn("dlq_reason", reason)


def dead_letters(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("dlq_reason").isNotNull()).withColumn("dlq_timestamp", F.current_timestamp())


def accepted(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("dlq_reason").isNull()).drop("dlq_reason", "missing_fields")


def dead_letter_rate(routed: DataFrame, by: Column, alert_rate: float) -> DataFrame:
    """Share of dead letters per group and whether it passes the alert rate."""
    bad = F.col("dlq_reason").isNotNull()
    return (
        routed.groupBy(by)
        .agg(F.count("*").alias("total"), F.count_if(bad).alias("dead"))
        .withColumn("dlq_rate", F.col("dead") / F.col("total"))
        .withColumn("over_limit", F.col("dlq_rate") > alert_rate)
    )


def registry(spark: SparkSession) -> DataFrame:
    """Required envelope and payload fields per (schema_version, event_type)."""
    rows = [(version, kind, REGISTRY_ENVELOPE, fields) for (version, kind), fields in REGISTRY_PAYLOAD.items()]
    return inline_rows(
        spark, rows, "schema_version string, event_type string, required_fields array<string>, payload_fields array<string>"
    )


def check_registry(events: DataFrame, known: DataFrame) -> DataFrame:
    """Add ``missing_fields``, ``missing_payload`` and ``registry_status`` to parsed events."""
    present = F.array_compact(
        F.array(*[F.when(F.col(name).isNotNull(), F.lit(name)) for name in REGISTRY_ENVELOPE])
    )
    payload_present = F.coalesce(
        F.map_keys(F.map_filter("payload", lambda _, v: v.isNotNull())), F.array().cast("array<string>")
    )
    joined = events.join(known, ["schema_version", "event_type"], "left")
    checked = joined.withColumn(
        "missing_fields", F.array_except("required_fields", present)
    ).withColumn("missing_payload", F.array_except("payload_fields", payload_present))
    status = (
        F.when(F.col("required_fields").isNull(), "unregistered")
        .when(F.size("missing_fields") > 0, "missing_field")
        .when(F.size("missing_payload") > 0, "invalid_payload")
        .otherwise("ok")
    )
    return checked.withColumn("registry_status", status).drop("required_fields", "payload_fields")
