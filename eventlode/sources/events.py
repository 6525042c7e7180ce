"""Adapters from the given parquet tables to the engine's inputs.

All are plain projections, so they serve batch frames and streams alike, and a scan reads only the
columns its consumer asks for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlode.session import prepare

EVENTS_LAYOUT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# The table's event types and what they are called here.
TYPE_NAMES = {"signup": "user_signup", "view": "page_view", "click": "page_view", "purchase": "purchase"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table. The layout of the events is known, so no file is opened to infer it."""
    reader = prepare(spark).read
    if name == "events":
        reader = reader.schema(EVENTS_LAYOUT)
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, layout: T.StructType, **options: str) -> DataFrame:
    """Stream one table. The trailing star lets the path be a single file or a folder of files."""
    reader = prepare(spark).readStream.schema(layout)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.parquet(f"{sf_dir}/{name}.parquet*")


def _type_name():
    name = F.lit("payment_failed")
    for source, target in TYPE_NAMES.items():
        name = F.when(F.col("event_type") == source, target).otherwise(name)
    return name


def canonical(events: DataFrame) -> DataFrame:
    """Clean events in the engine's shape. Every tenth key repeats its predecessor's."""
    event_id, user_id = F.col("event_id"), F.col("user_id")
    quantity = (F.lit(1) + event_id % 5).cast("int")
    price = F.col("value").cast("decimal(12,2)")
    surcharge = F.when(event_id % 100 == 50, 1).otherwise(0)
    user_class = user_id % 10
    return events.select(
        event_id.cast("string").alias("event_id"),
        user_id.cast("string").alias("user_id"),
        F.concat(F.lit("k"), F.when(event_id % 10 == 9, event_id - 1).otherwise(event_id).cast("string")).alias(
            "idempotency_key"
        ),
        _type_name().alias("event_type"),
        F.when(user_class < 5, "mobile").when(user_class < 8, "desktop").when(user_class == 8, "tablet")
        .otherwise("other").alias("device_type"),
        F.concat(F.lit("10.0."), (user_id % 256).cast("string"), F.lit(".1")).alias("ip_address"),
        F.create_map(
            F.lit("country"),
            F.when(user_id % 3 == 0, "US").when(user_id % 3 == 1, "DE").otherwise("BR"),
        ).alias("geo_location"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        (price * quantity + surcharge).cast("decimal(12,2)").alias("total_amount"),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(read_table(spark, sf_dir, "events"))


def stream_events(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    return canonical(stream_table(spark, sf_dir, "events", EVENTS_LAYOUT, **options))


def raw_json(events: DataFrame) -> DataFrame:
    """(event_id, ts, raw_value): the events as JSON text, fifteen of every hundred ids broken.

    The remainder of the id picks the defect, so a checker knows which row carries which.
    """
    event_id = F.col("event_id")
    kind = event_id % 100
    iso = F.concat(F.regexp_replace(F.col("ts").cast("string"), " ", "T"), F.lit("+00:00"))
    good_payload = F.concat(
        F.lit('{"email":"a@b.c","username":"u","signup_source":"organic","page_url":"https://x","session_id":"s",'
              '"transaction_id":"T'),
        event_id.cast("string"),
        F.lit('","product_id":"P","total_amount":"'),
        F.col("value").cast("decimal(12,2)").cast("string"),
        F.lit('","currency":"USD","failure_reason":"card_declined","error_code":"ERR_002"}'),
    )
    timestamp_json = (
        F.when(kind == 2, '"yesterday noon"').when(kind == 3, '"2024-02-30T10:00:00Z"').when(kind == 4, '" "')
        .when(kind == 5, "null").when(kind == 6, "86400")
        .otherwise(F.concat(F.lit('"'), iso, F.lit('"')))
    )
    payload_json = (
        F.when(kind == 12, "null").when(kind == 13, '"amount=9.90"').when(kind == 14, '["P1",2]')
        .when(kind == 15, '{"note":"nothing the registry asks for"}').otherwise(good_payload)
    )
    document = F.concat(
        F.lit('{"event_id":"'), event_id.cast("string"), F.lit('"'),
        F.when(kind == 1, "").otherwise(F.concat(F.lit(',"user_id":"'), F.col("user_id").cast("string"), F.lit('"'))),
        F.lit(',"timestamp":'), timestamp_json,
        F.lit(',"event_type":"'), _type_name(),
        F.lit('","schema_version":"v1","idempotency_key":"k'), event_id.cast("string"), F.lit('"'),
        F.when(kind == 11, ',"client_build":"2211","debug":true').otherwise(""),
        F.lit(',"payload":'), payload_json, F.lit("}"),
    )
    return events.select(
        "event_id",
        "ts",
        F.when(kind == 7, '{"event_id":"7","user_').when(kind == 8, "event_id=8;user_id=3").when(kind == 9, "[1,2]")
        .when(kind == 10, "null").otherwise(document).alias("raw_value"),
    )


def as_messages(events: DataFrame) -> DataFrame:
    """The JSON texts in the shape a broker delivers them: key, value and timestamp."""
    return raw_json(events).select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("raw_value").cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def user_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An opening user dimension from the customer table.

    Customer n is user 2n, so even users are known and odd ones are new to a load. Two of the five
    market segments are on the free plan.
    """
    from eventlode.schemas import DIM_USER

    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    start = F.lit("2023-01-01").cast("timestamp")
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        F.col("c_custkey").alias("user_key"),
        (F.col("c_custkey") * 2).cast("string").alias("user_id"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("username"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "free").otherwise("premium").alias("plan_type"),
        F.lit("active").alias("subscription_status"),
        F.lit("gold").alias("user_tier"),
        F.col("n_name").alias("country"),
        F.lit(None).cast("string").alias("region"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("timezone"),
        F.lit("2023-01-01").cast("date").alias("signup_date"),
        F.lit("organic").alias("signup_source"),
        start.alias("effective_start_date"),
        F.lit(None).cast("timestamp").alias("effective_end_date"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version_number"),
        start.alias("created_at"),
        start.alias("updated_at"),
    )
    return rows.select(*DIM_USER.names)


def plan_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log of plans: every customer starts free and moves to basic in January 2024."""
    customer = read_table(spark, sf_dir, "customer")
    user_id = (F.col("c_custkey") * 2).cast("string")
    first = customer.select(
        user_id.alias("user_id"), F.lit("free").alias("plan_type"),
        F.lit("2023-01-01").cast("timestamp").alias("changed_at"),
    )
    second = customer.select(
        user_id.alias("user_id"), F.lit("basic").alias("plan_type"),
        (F.lit("2024-01-10").cast("timestamp") + F.make_dt_interval((F.col("c_custkey") % 10).cast("int"))).alias(
            "changed_at"
        ),
    )
    return first.unionByName(second)


def product_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table as products."""
    from eventlode.schemas import DIM_PRODUCT

    part = read_table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("product_key"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.lit(True).alias("is_active"),
        F.lit("2023-01-01").cast("timestamp").alias("created_at"),
        F.lit("2023-01-01").cast("timestamp").alias("updated_at"),
    ).select(*DIM_PRODUCT.names)


def payment_events(events: DataFrame) -> DataFrame:
    """Canonical events with the purchase payload of the second warehouse layout as a text map."""
    event_id = F.col("event_id").cast("bigint")
    failed = F.col("event_type") == "payment_failed"
    return events.withColumn(
        "payload",
        F.create_map(
            F.lit("transaction_id"), F.concat(F.lit("T"), F.col("event_id")),
            F.lit("product_id"), F.concat(F.lit("P"), (event_id % 250).cast("string")),
            F.lit("currency"), F.lit("USD"),
            F.lit("payment_method"), F.when(event_id % 2 == 0, "credit_card").otherwise("paypal"),
            F.lit("quantity"), F.col("quantity").cast("string"),
            F.lit("unit_price"), F.col("unit_price").cast("string"),
            F.lit("discount_amount"), F.lit("0.00"),
            F.when(failed, "attempted_amount").otherwise("total_amount"), F.col("total_amount").cast("string"),
        ),
    )
