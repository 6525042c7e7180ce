import json

import pytest
from pyspark.sql import functions as F

from eventlode.functions.parse import add_ingestion_columns, classify_corruption, decode_messages, event_time, parse_events
from eventlode.operators import validate
from eventlode.schemas import REGISTRY_ENVELOPE

GOOD = {
    "event_id": "1", "user_id": "2", "timestamp": "2024-01-05T10:00:00+00:00", "event_type": "purchase",
    "schema_version": "v1", "idempotency_key": "k1",
    "payload": {"transaction_id": "T", "product_id": "P", "total_amount": 1.5, "currency": "USD"},
}


def without(name):
    return json.dumps({k: v for k, v in GOOD.items() if k != name})


def with_(**changes):
    return json.dumps({**GOOD, **changes})


CASES = [
    (json.dumps(GOOD), "clean"),
    *[(without(name), "missing_field") for name in REGISTRY_ENVELOPE if name != "idempotency_key"],
    *[(with_(timestamp=value), "invalid_timestamp")
      for value in ("yesterday noon", "2024-02-30T10:00:00Z", "10:00", " ", 86400, False, ["2024-01-05"], {"at": "2024-01-05"}, None)],
    *[(text, "malformed_json")
      for text in (json.dumps(GOOD)[:-1], json.dumps(GOOD)[1:], "event_id=8;user_id=3", "<event/>", "[1, 2]", "null", "17", " ", None)],
    (with_(client_build="2211", debug=True), "extra_fields"),
    *[(with_(payload=value), "invalid_payload")
      for value in ("amount=9.90", ["P1", 2], 9.9, {}, {"transaction_id": "T"}, None)],
]


def test_corruption_classes(spark):
    texts = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "i int, raw_value string")
    found = {r.i: r.defect for r in classify_corruption(texts, validate.registry(spark)).collect()}
    assert found == {i: defect for i, (_, defect) in enumerate(CASES)}


@pytest.mark.parametrize("text, good", [
    ("2024-01-05T10:00:00+00:00", True), ("2024-01-05T10:00:00Z", True), ("2024-01-05T12:00:00+02:00", True),
    ("12345", False), ("10:00", False), ("T09:30:00Z", False), (" 7:15", False), ("1999-12-31T23:59:59Z", False), ("2999-01-01T00:00:00Z", False), ("", False), (None, False),
])
def test_event_time_band(spark, text, good):
    row = spark.createDataFrame([(text,)], "t string").select(event_time("t").alias("at")).first()
    assert (row.at is not None) == good


def test_bronze_columns_keep_the_text(spark):
    messages = spark.createDataFrame(
        [(bytearray(b"a"), bytearray(json.dumps(GOOD).encode())), (None, bytearray(b"event_id=8"))],
        "key binary, value binary",
    ).withColumn("timestamp", F.current_timestamp())
    rows = add_ingestion_columns(parse_events(decode_messages(messages))).orderBy("kafka_key").collect()
    assert rows[0].raw_value == "event_id=8" and rows[0].event_id is None and rows[0].date is None
    assert rows[1].date == "2024-01-05" and rows[1].payload["total_amount"] == "1.5"


def test_strict_and_plain_routing(spark):
    texts = spark.createDataFrame([(with_(timestamp=86400),), (without("user_id"),), (json.dumps(GOOD),)], "raw_value string")
    parsed = parse_events(texts)
    reasons = lambda strict: sorted(str(r.dlq_reason) for r in validate.route(parsed, strict).collect())
    assert reasons(True) == ["None", "invalid_timestamp", "schema_validation_failed"]
    assert reasons(False) == ["None", "None", "schema_validation_failed"]
    assert validate.accepted(validate.route(parsed)).count() + validate.dead_letters(validate.route(parsed)).count() == 3


def test_unregistered_version(spark):
    parsed = parse_events(spark.createDataFrame([(with_(schema_version="v9"),)], "raw_value string"))
    assert validate.check_registry(parsed, validate.registry(spark)).first().registry_status == "unregistered"
