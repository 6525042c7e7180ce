"""Small event frames."""

from pyspark.sql import functions as F


def events(spark, rows):
    """(user, key, 'HH:MM[:SS]' on 2024-01-01 or a full timestamp[, event type]) as canonical events."""
    full = []
    for i, row in enumerate(rows):
        user, key, at, *rest = row
        at = at if "-" in at else f"2024-01-01 {at}"
        full.append((f"e{i:05d}", str(user), key, rest[0] if rest else "page_view", at))
    frame = spark.createDataFrame(full, "event_id string, user_id string, idempotency_key string, event_type string, at string")
    return frame.select(
        "event_id", "user_id", "idempotency_key", "event_type",
        F.lit("mobile").alias("device_type"), F.lit("10.0.0.1").alias("ip_address"),
        F.create_map(F.lit("country"), F.lit("US")).alias("geo_location"),
        F.col("at").cast("timestamp").alias("event_timestamp"),
        F.lit(2).alias("quantity"), F.lit("10.50").cast("decimal(12,2)").alias("total_amount"),
    )


def users(spark, rows):
    """(key, user, plan, start, end, current, version) as dimension rows."""
    from eventlode.schemas import DIM_USER

    frame = spark.createDataFrame(
        rows, "user_key bigint, user_id string, plan_type string, s string, e string, is_current boolean, version_number int"
    ).withColumns({
        "effective_start_date": F.col("s").cast("timestamp"), "effective_end_date": F.col("e").cast("timestamp"),
        "subscription_status": F.lit("active"), "user_tier": F.lit("bronze"), "signup_source": F.lit("organic"),
        "signup_date": F.lit("2023-01-01").cast("date"), "created_at": F.current_timestamp(),
        "updated_at": F.current_timestamp(),
        **{name: F.lit(None).cast("string") for name in ("email", "username", "country", "region", "city", "timezone")},
    })
    return frame.select(*DIM_USER.names)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
