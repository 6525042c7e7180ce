"""Message decoding, JSON parsing, event time and the classes of broken input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventlode.schemas import ENVELOPE_FIELDS, EVENT_JSON

# An event time before this instant, or more than a day after it was received, is not believable.
# Without the band a number such as 12345 reads as the year 12345 and drags the watermark with it.
EARLIEST_EVENT = "2000-01-01"
# A time without a date would be read as today's, and differ with the day of the run.
_BARE_TIME = r"^\s*T?\d{1,2}:"


def decode_messages(messages: DataFrame) -> DataFrame:
    """Broker records (key, value, timestamp) as text with the broker's own timestamp."""
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def parse_events(decoded: DataFrame) -> DataFrame:
    """Expand the JSON text into the envelope columns; unknown fields are ignored, the text is kept."""
    kept = [name for name in decoded.columns if name not in ENVELOPE_FIELDS]
    return decoded.withColumn("event", F.from_json("raw_value", EVENT_JSON)).select(*kept, "event.*")


def event_time(text: Column | str, received: Column | None = None) -> Column:
    """Timestamp of an ISO-8601 text, NULL when it is unreadable or outside the believable band."""
    text = F.col(text) if isinstance(text, str) else text
    instant = F.try_to_timestamp(text)
    received = F.current_timestamp() if received is None else received
    believable = (instant >= F.lit(EARLIEST_EVENT).cast("timestamp")) & (
        instant <= received + F.expr("interval 1 day")
    )
    return F.when(believable & ~text.rlike(_BARE_TIME), instant)


def add_ingestion_columns(parsed: DataFrame) -> DataFrame:
    """Partition date (NULL when the event time is unusable) and the time of ingestion."""
    return parsed.withColumn("date", F.to_date(event_time("timestamp")).cast("string")).withColumn(
        "ingestion_time", F.current_timestamp()
    )


def classify_corruption(texts: DataFrame, registry: DataFrame, raw: str = "raw_value") -> DataFrame:
    """Add ``defect``: the first defect of each raw JSON text, or ``clean``.

    Defects are tested from the outside in: unreadable text, absent envelope fields, unusable event
    time, a payload that is no object or lacks what the registry asks of the type, fields nobody
    asked for. The text is parsed once, into a variant; the steps are separate projections so that
    no later test parses it again.
    """
    document = texts.withColumn("_doc", F.try_parse_json(raw))
    members = document.withColumn("_fields", F.map_keys(F.try_variant_get("_doc", "$", "map<string,variant>")))
    read = members.withColumns({
        "_kind": F.try_variant_get("_doc", "$.event_type", "string"),
        "_version": F.try_variant_get("_doc", "$.schema_version", "string"),
        "_time": event_time(F.try_variant_get("_doc", "$.timestamp", "string")),
        "_payload": F.map_keys(F.try_variant_get("_doc", "$.payload", "map<string,variant>")),
    })
    asked = registry.select(
        F.col("schema_version").alias("_known_version"), F.col("event_type").alias("_known_kind"),
        F.col("payload_fields").alias("_asked"),
    )
    known = read.join(
        asked, (F.col("_version") == F.col("_known_version")) & (F.col("_kind") == F.col("_known_kind")), "left"
    )
    must_have = F.array(*[F.lit(n) for n in ("event_id", "user_id", "timestamp", "event_type", "schema_version")])
    allowed = F.array(*[F.lit(n) for n in ENVELOPE_FIELDS])
    wanted = F.coalesce("_asked", F.array().cast("array<string>"))
    defect = (
        F.when(F.col("_fields").isNull(), "malformed_json")
        .when(F.size(F.array_except(must_have, "_fields")) > 0, "missing_field")
        .when(F.col("_time").isNull(), "invalid_timestamp")
        .when(F.col("_payload").isNull() | (F.size(F.array_except(wanted, "_payload")) > 0), "invalid_payload")
        .when(F.size(F.array_except("_fields", allowed)) > 0, "extra_fields")
        .otherwise("clean")
    )
    return known.select(*[known[name] for name in texts.columns], defect.alias("defect"))
