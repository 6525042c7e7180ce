"""Table layouts and the fixed values every layer shares."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Event envelope
# ---------------------------------------------------------------------------------------------
EVENT_TYPES = ["user_signup", "page_view", "purchase", "payment_failed"]
DEVICE_TYPES = ["desktop", "mobile", "tablet", "other"]
REQUIRED_FIELDS = ["event_id", "user_id", "timestamp", "event_type", "idempotency_key"]
ENVELOPE_FIELDS = [
    "event_id", "user_id", "timestamp", "event_type", "schema_version", "idempotency_key",
    "device_type", "ip_address", "user_agent", "geo_location", "payload",
]

# Fields a (schema version, event type) must carry
REGISTRY_ENVELOPE = ["event_id", "user_id", "timestamp", "event_type", "schema_version", "idempotency_key"]
REGISTRY_PAYLOAD = {
    ("v1", "user_signup"): ["email", "username", "signup_source"],
    ("v1", "page_view"): ["page_url", "session_id"],
    ("v1", "purchase"): ["transaction_id", "product_id", "total_amount", "currency"],
    ("v1", "payment_failed"): ["transaction_id", "failure_reason", "error_code"],
}

# Streaming defaults
WATERMARK_DELAY = "10 minutes"
SESSION_WINDOW = "30 minutes"
BRONZE_TRIGGER = "10 seconds"
DEAD_LETTER_TRIGGER = "30 seconds"
SILVER_TRIGGER = "30 seconds"
FEED_TRIGGER = "1 second"
DEAD_LETTER_REASON = "schema_validation_failed"

# Device dimension rows
# (device_type, device_category, os_family, browser_family, is_mobile, is_tablet, is_desktop)
DEVICE_ROWS = [
    ("mobile", "smartphone", "iOS", "Safari", True, False, False),
    ("mobile", "smartphone", "iOS", "Chrome", True, False, False),
    ("mobile", "smartphone", "Android", "Chrome", True, False, False),
    ("mobile", "smartphone", "Android", "Firefox", True, False, False),
    ("mobile", "smartphone", "Android", "Samsung Browser", True, False, False),
    ("tablet", "tablet", "iOS", "Safari", False, True, False),
    ("tablet", "tablet", "Android", "Chrome", False, True, False),
    ("desktop", "laptop", "macOS", "Safari", False, False, True),
    ("desktop", "laptop", "macOS", "Chrome", False, False, True),
    ("desktop", "laptop", "macOS", "Firefox", False, False, True),
    ("desktop", "laptop", "Windows", "Chrome", False, False, True),
    ("desktop", "laptop", "Windows", "Firefox", False, False, True),
    ("desktop", "laptop", "Windows", "Edge", False, False, True),
    ("desktop", "laptop", "Linux", "Chrome", False, False, True),
    ("desktop", "laptop", "Linux", "Firefox", False, False, True),
    ("unknown", "unknown", "Unknown", "Unknown", False, False, False),
]

# Event-type dimension rows (event_type, event_category, description)
EVENT_TYPE_ROWS = [
    ("user_signup", "user_action", "User registration event"),
    ("page_view", "user_action", "Page view event"),
    ("purchase", "transaction", "Purchase completion event"),
    ("payment_failed", "transaction", "Failed payment attempt"),
    ("add_to_cart", "user_action", "Product added to cart"),
    ("remove_from_cart", "user_action", "Product removed from cart"),
    ("search", "user_action", "Search query event"),
    ("logout", "user_action", "User logout event"),
]

# Defaults of a user seen for the first time, and of an upgraded one
NEW_USER = {"plan_type": "free", "subscription_status": "active", "user_tier": "bronze", "signup_source": "organic"}
UPGRADE_FROM_PLAN = "free"
UPGRADE_TO = {"plan_type": "basic", "user_tier": "silver"}
UPGRADE_MIN_SESSIONS = 5

# Churn levels in days without activity, and the constant purchase amount
CHURN_HIGH_DAYS = 30
CHURN_MEDIUM_DAYS = 14
CHURN_LOOKBACK_DAYS = 7
CONSTANT_PURCHASE_AMOUNT = "99.99"

# Quality limits
FRESHNESS_HOURS = 24
VOLUME_THRESHOLD_PCT = 20.0
VOLUME_LOOKBACK_DAYS = 7
CRITICAL_COLUMNS = ["user_id", "session_start"]
DEAD_LETTER_ALERT_RATE = 0.01

# ---------------------------------------------------------------------------------------------
# Layouts
# ---------------------------------------------------------------------------------------------
_KINDS = {"int": T.IntegerType(), "bigint": T.LongType()}
TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def _struct(*fields: tuple[str, T.DataType | str]) -> T.StructType:
    layout = T.StructType()
    for name, kind in fields:
        layout = layout.add(name, _KINDS.get(kind, kind) if isinstance(kind, str) else kind, True)
    return layout


MESSAGE = _struct(("key", "binary"), ("value", "binary"), ("timestamp", "timestamp"))

EVENT_JSON = _struct(
    *[(name, "string") for name in ENVELOPE_FIELDS[:9]], ("geo_location", TEXT_MAP), ("payload", TEXT_MAP)
)

BRONZE = _struct(
    ("kafka_key", "string"), ("kafka_timestamp", "timestamp"), ("raw_value", "string"),
    *[(field.name, field.dataType) for field in EVENT_JSON],
    ("date", "string"), ("ingestion_time", "timestamp"),
)

SILVER_SESSION = _struct(
    ("user_id", "string"), ("window_start", "timestamp"), ("window_end", "timestamp"), ("part_no", "int"),
    ("event_count", "bigint"), ("session_start", "timestamp"), ("session_end", "timestamp"),
    ("event_types", T.ArrayType(T.StringType())), ("event_ids", T.ArrayType(T.StringType())),
    ("primary_device", "string"), ("primary_ip", "string"), ("primary_geo", TEXT_MAP),
    ("processed_at", "timestamp"), ("date", "string"),
)

DIM_TIME = _struct(
    ("time_key", "int"), ("full_timestamp", "timestamp"), ("date_actual", "date"), ("year", "int"),
    ("quarter", "int"), ("month", "int"), ("month_name", "string"), ("week_of_year", "int"),
    ("day_of_month", "int"), ("day_of_week", "int"), ("day_name", "string"), ("hour", "int"),
    ("minute", "int"), ("is_weekend", "boolean"), ("is_holiday", "boolean"),
)

DIM_DEVICE = _struct(
    ("device_key", "int"), ("device_type", "string"), ("device_category", "string"), ("os_family", "string"),
    ("os_version", "string"), ("browser_family", "string"), ("browser_version", "string"),
    ("is_mobile", "boolean"), ("is_tablet", "boolean"), ("is_desktop", "boolean"),
    ("created_at", "timestamp"), ("updated_at", "timestamp"),
)

DIM_EVENT_TYPE = _struct(
    ("event_type_key", "int"), ("event_type", "string"), ("event_category", "string"), ("description", "string"),
    ("is_active", "boolean"), ("created_at", "timestamp"),
)

DIM_PRODUCT = _struct(
    ("product_key", "bigint"), ("product_id", "string"), ("product_name", "string"), ("category", "string"),
    ("subcategory", "string"), ("price", T.DecimalType(10, 2)), ("is_active", "boolean"),
    ("created_at", "timestamp"), ("updated_at", "timestamp"),
)

DIM_USER = _struct(
    ("user_key", "bigint"), ("user_id", "string"), ("email", "string"), ("username", "string"),
    ("plan_type", "string"), ("subscription_status", "string"), ("user_tier", "string"), ("country", "string"),
    ("region", "string"), ("city", "string"), ("timezone", "string"), ("signup_date", "date"),
    ("signup_source", "string"), ("effective_start_date", "timestamp"), ("effective_end_date", "timestamp"),
    ("is_current", "boolean"), ("version_number", "int"), ("created_at", "timestamp"), ("updated_at", "timestamp"),
)

FACT_EVENTS = _struct(
    ("event_key", "bigint"), ("event_id", "string"), ("idempotency_key", "string"), ("user_key", "bigint"),
    ("time_key", "int"), ("device_key", "int"), ("event_type", "string"), ("schema_version", "string"),
    ("session_id", "string"), ("ip_address", "string"), ("geo_country", "string"), ("geo_region", "string"),
    ("geo_city", "string"), ("geo_latitude", T.DecimalType(10, 8)), ("geo_longitude", T.DecimalType(11, 8)),
    ("page_view_count", "int"), ("purchase_amount", T.DecimalType(12, 2)), ("purchase_quantity", "int"),
    ("is_conversion", "boolean"), ("is_error", "boolean"), ("payload_json", "string"),
    ("event_timestamp", "timestamp"), ("kafka_timestamp", "timestamp"), ("ingestion_timestamp", "timestamp"),
    ("warehouse_loaded_at", "timestamp"), ("data_quality_score", T.DecimalType(3, 2)),
)

FACT_PURCHASES = _struct(
    ("purchase_key", "bigint"), ("event_id", "string"), ("user_key", "bigint"), ("time_key", "int"),
    ("product_key", "bigint"), ("transaction_id", "string"), ("payment_method", "string"), ("currency", "string"),
    ("amount", T.DecimalType(15, 2)), ("tax_amount", T.DecimalType(15, 2)),
    ("discount_amount", T.DecimalType(15, 2)), ("quantity", "int"), ("status", "string"),
    ("processed_at", "timestamp"), ("event_timestamp", "timestamp"),
)

JOB_RUNS = _struct(
    ("run_id", "string"), ("job_name", "string"), ("job_type", "string"), ("status", "string"),
    ("start_time", "timestamp"), ("end_time", "timestamp"), ("records_processed", "bigint"),
    ("error_message", "string"), ("metadata", "string"), ("created_at", "timestamp"),
)

QUALITY_LOG = _struct(
    ("check_id", "string"), ("check_name", "string"), ("table_name", "string"), ("check_type", "string"),
    ("status", "string"), ("check_value", T.DecimalType(38, 10)), ("threshold_value", T.DecimalType(38, 10)),
    ("details", "string"), ("checked_at", "timestamp"),
)

# Partial aggregates of the marts, a row per user key and day of a load.
MART_PARTIALS = _struct(
    ("user_key", "bigint"), ("day", T.DateType()), ("events", "bigint"), ("last_at", T.TimestampType()),
    ("purchases", "bigint"), ("revenue", T.DecimalType(38, 2)), ("items", "bigint"),
    ("first_sale_at", T.TimestampType()), ("last_sale_at", T.TimestampType()),
)
