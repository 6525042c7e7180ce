"""Every operator as a named query over the given tables.

A query takes the session and the folder of the tables and returns a frame whose column types are
plain (see ``tidy``), so that results can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlode.functions.parse import classify_corruption, parse_events
from eventlode.operators import active_users, coltests, dims, facts, joins, kpis, marts, quality, scd2, sessions, validate
from eventlode.operators.dedup import keep_first, keep_first_streaming
from eventlode.operators.keys import assign_keys
from eventlode.operators.runlog import logged_run
from eventlode.plans import daily
from eventlode.schemas import DEAD_LETTER_ALERT_RATE, DIM_USER, MART_PARTIALS, SILVER_SESSION
from eventlode.session import materialize, prepare, work_dir
from eventlode.sources import events as given
from eventlode.sources.buckets import BucketedDimension, PartTable
from eventlode.sources.ledger import KeyLedger
from eventlode.sources.streams import decode_feed
from eventlode.sources.tables import ParquetStore, read_partition, write_partitioned
from eventlode.streaming import jobs, late, live
from eventlode.streaming.run import start_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Arguments of the compared queries.
AS_OF = "2024-02-01"
CHURN_AS_OF = "2024-02-05"
RULE = scd2.UpgradeRule(more_than=58)
SILVER_DATE = "2024-01-15"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tidy(df: DataFrame) -> DataFrame:
    """Reduce column types to text, bigint, double, boolean, date and zone-less timestamp."""
    columns = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- inputs -----------------------------------------------------------------------------------


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.read_events(spark, sf_dir)


def unique_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(events_of(spark, sf_dir))


def sessions_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = events_of(spark, sf_dir)
    return sessions.tumbling_sessions(keep_first(every), counted=every)


def parsed_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(given.raw_json(given.read_table(spark, sf_dir, "events")).select(
        F.col("event_id").alias("source_id"), "ts", "raw_value"
    ))


def messages_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.as_messages(given.stream_table(spark, sf_dir, "events", given.EVENTS_LAYOUT))


def mart_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a fact row; user n has key n + 1."""
    events = events_of(spark, sf_dir)
    return events.withColumns(facts.measures(F.col("total_amount"), F.col("quantity"))).withColumn(
        "user_key", F.col("user_id").cast("bigint") + 1
    )


def idle_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same facts moved into the past by zero to thirty-nine days, depending on the user."""
    back = (F.col("user_key") % 40).cast("int")
    return mart_facts(spark, sf_dir).withColumn(
        "event_timestamp", F.col("event_timestamp") - F.make_dt_interval(back)
    )


def mart_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension with every seventh row expired."""
    return given.user_dimension(spark, sf_dir).withColumn("is_current", F.col("user_key") % 7 != 0)


def star_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.build_facts(
        unique_events(spark, sf_dir), given.user_dimension(spark, sf_dir), dims.device_dimension(spark),
        dims.time_dimension(spark),
    )


def lake_of(spark: SparkSession, label: str) -> jobs.Lake:
    return jobs.Lake(work_dir(prepare(spark), label))


def bronze_lake(spark: SparkSession, sf_dir: str, label: str) -> jobs.Lake:
    lake = lake_of(spark, label)
    jobs.run_stream(spark, messages_of(spark, sf_dir), lake, "bronze", "available_now", files_per_partition=2)
    return lake


# --- parsing and validation -------------------------------------------------------------------


@query
def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(parsed_of(spark, sf_dir).select(
        "source_id", "event_id", "user_id", F.col("timestamp").alias("event_time_text"), "event_type",
        "schema_version", "idempotency_key", F.col("payload")["transaction_id"].alias("transaction_id"),
        F.col("payload")["currency"].alias("currency"),
    ))


@query
def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, invalid = validate.split_valid(parsed_of(spark, sf_dir))
    return tidy(
        valid.select("source_id", F.lit("valid").alias("side"))
        .unionByName(invalid.select("source_id", F.lit("invalid").alias("side")))
    )


@query
def dlq_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = validate.route(parsed_of(spark, sf_dir))
    return tidy(validate.dead_letter_rate(routed, F.to_date("ts").alias("day"), DEAD_LETTER_ALERT_RATE))


@query
def registry_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate.check_registry(parsed_of(spark, sf_dir), validate.registry(spark))
    return tidy(checked.select("source_id", "registry_status", F.size("missing_fields").alias("fields_missing"),
                               F.size("missing_payload").alias("payload_missing")))


@query
def corruption_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = given.raw_json(given.read_table(spark, sf_dir, "events")).select(
        F.col("event_id").alias("source_id"), "raw_value"
    )
    return tidy(classify_corruption(texts, validate.registry(spark)).drop("raw_value"))


# --- streams ----------------------------------------------------------------------------------


@query
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = bronze_lake(spark, sf_dir, "bronze-ingest")
    bronze = spark.read.schema(jobs.BRONZE).parquet(lake.table("bronze"))
    return tidy(bronze.select("kafka_key", "kafka_timestamp", "raw_value", "event_id", "user_id", "event_type",
                              F.col("date").alias("partition_date")))


@query
def bronze_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table after its many small files were packed: every row once, as before."""
    lake = lake_of(spark, "bronze-compacted")
    jobs.run_stream(spark, messages_of(spark, sf_dir), lake, "bronze", "available_now", files_per_partition=3)
    table = jobs.compacted_bronze(spark, lake)
    table.compact()
    return tidy(table.read().select("kafka_key", "kafka_timestamp", "raw_value", "event_id", "user_id", "event_type",
                                    F.col("date").alias("partition_date")))


@query
def dlq_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = bronze_lake(spark, sf_dir, "dlq-route")
    routed = validate.route(jobs.bronze_stream(spark, lake.table("bronze")))
    jobs.finish([jobs.route_dead_letters(routed, lake, "available_now")])
    return tidy(spark.read.parquet(lake.table("dead_letters")).select("kafka_key", "dlq_reason", "missing_fields"))


@query
def silver_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = bronze_lake(spark, sf_dir, "silver-tumbling")
    jobs.run_stream(spark, None, lake, "silver", "available_now", feed=False)
    return _session_columns(spark.read.schema(SILVER_SESSION).parquet(lake.table("silver_tumbling")))


def _session_columns(rows: DataFrame) -> DataFrame:
    return tidy(rows.select("user_id", "window_start", "window_end", "event_count", "session_start", "session_end",
                            "event_types", "event_ids", "date"))


@query
def silver_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = bronze_lake(spark, sf_dir, "silver-sessions")
    jobs.run_stream(spark, None, lake, "silver", "available_now", feed=False, kind="gap")
    return tidy(spark.read.parquet(lake.table("silver_gap")).select(
        "user_id", "session_start", "session_end", "last_event_at", "event_count"
    ))


@query
def silver_tumbling_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sessions_of(spark, sf_dir)
    return tidy(rows.select("user_id", "window_start", "window_end", "event_count", "session_start", "session_end",
                            "event_types", "event_ids", "primary_device", "primary_ip",
                            F.col("primary_geo")["country"].alias("country"), "date"))


@query
def silver_sessions_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(sessions.gap_sessions(unique_events(spark, sf_dir)))


@query
def processed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = bronze_lake(spark, sf_dir, "feed")
    valid = validate.accepted(validate.route(jobs.bronze_stream(spark, lake.table("bronze")))).drop("event_timestamp")
    jobs.finish([jobs.publish_feed(valid, lake, "available_now")])
    return tidy(decode_feed(spark.read.parquet(lake.table("feed"))).select(
        "key", "event_id", "event_type", F.col("payload")["transaction_id"].alias("transaction_id")
    ))


@query
def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream deduplication keeps whichever copy arrives first, so only the keys are compared."""
    lake = lake_of(spark, "dedup-stream")
    unique = keep_first_streaming(jobs.watermarked(given.stream_events(spark, sf_dir)))
    jobs.finish([start_parquet(unique.select("idempotency_key"), lake.table("keys"), lake.checkpoint("keys"),
                               "available_now", "dedup_stream")])
    return spark.read.parquet(lake.table("keys"))


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in two deliveries: every twentieth event is held back and arrives after all others."""
    return events_of(spark, sf_dir).withColumn(
        "delivery", F.when(F.col("event_id").cast("bigint") % 20 == 3, 2).otherwise(1)
    )


@query
def late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows after a second, late delivery: only what still falls in an open window is added."""
    lake = lake_of(spark, "late-data")
    arrivals = _arrivals(spark, sf_dir)
    for delivery in (1, 2):
        arrivals.where(F.col("delivery") == delivery).drop("delivery").write.mode("append").parquet(
            lake.table("landing")
        )
        stream = spark.readStream.schema(arrivals.drop("delivery").schema).parquet(lake.table("landing"))
        rows = sessions.tumbling_sessions_streaming(jobs.watermarked(stream))
        jobs.finish([start_parquet(rows, lake.table("windows"), lake.checkpoint("windows"), "available_now",
                                   "late_data")])
    return tidy(spark.read.parquet(lake.table("windows")).select("user_id", "window_start", "event_count"))


@query
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries split by the watermark: every event, whether it came too late, and the watermark it met."""
    lake = lake_of(spark, "late-rows")
    arrivals = _arrivals(spark, sf_dir).select("event_id", "user_id", "event_timestamp", "delivery")
    layout = arrivals.drop("delivery").schema
    for delivery in (1, 2):
        arrivals.where(F.col("delivery") == delivery).drop("delivery").write.mode("append").parquet(
            lake.table("landing")
        )
        stream = spark.readStream.schema(layout).parquet(lake.table("landing"))
        jobs.finish([late.split_late(stream, lake.table("split"), lake.checkpoint("split"), "available_now")])
    kept = late.punctual_rows(spark, lake.table("split"), layout).withColumn("dlq_reason", F.lit(None).cast("string"))
    both = kept.unionByName(late.late_rows(spark, lake.table("split"), layout))
    return tidy(both.select("event_id", "event_timestamp", "watermark", "dlq_reason"))


@query
def restart_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver query started twice over the same input: the second start adds nothing."""
    lake = bronze_lake(spark, sf_dir, "restart")
    for _ in range(2):
        jobs.run_stream(spark, None, lake, "silver", "available_now", feed=False)
    return _session_columns(spark.read.schema(SILVER_SESSION).parquet(lake.table("silver_tumbling")))


@query
def run_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole streaming job in mode ``both``; rows per output table."""
    lake = lake_of(spark, "run-stream")
    jobs.run_stream(spark, messages_of(spark, sf_dir), lake, "both", "available_now", files_per_partition=2)
    counts = [
        spark.read.parquet(lake.table(name)).agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows"
        )
        for name in ("bronze", "dead_letters", "silver_tumbling", "feed")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


def _totals(spark: SparkSession, totals: DataFrame, label: str) -> DataFrame:
    """Run a running total to the end of its input and read its last state."""
    lake = lake_of(spark, label)
    jobs.finish([live.keep_totals(totals, lake.table("totals"), lake.checkpoint("totals"), "available_now", label)])
    return live.read_totals(spark, lake.table("totals"), totals.schema)


def _live_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = validate.route(jobs.bronze_rows(messages_of(spark, sf_dir)))
    feed = decode_feed(jobs.feed_rows(validate.accepted(routed).drop("event_timestamp")))
    return _totals(spark, live.revenue(feed), "live-revenue")


@query
def live_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_live_revenue(spark, sf_dir))


@query
def live_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored summary with the live purchases on top."""
    stored = kpis.summary(_revenue_mart(spark, sf_dir), _churn_mart(spark, sf_dir))
    return tidy(kpis.with_live_revenue(stored, _live_revenue(spark, sf_dir)))


@query
def live_dau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_totals(spark, live.users_per_day(given.stream_events(spark, sf_dir)), "live-dau"))


@query
def live_dau_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored trend with the users of the live stream added to its newest date."""
    mart = _stored_mart(spark, "daily_active_users", marts.daily_active_users(mart_facts(spark, sf_dir)))
    users = _totals(spark, live.distinct_users(given.stream_events(spark, sf_dir)), "live-users")
    return tidy(kpis.with_live_users(kpis.dau_trend(mart, days=20), users))


def _stored_and_live(spark: SparkSession, sf_dir: str, label: str) -> tuple[ParquetStore, DataFrame, jobs.Lake]:
    """Users of the days before the 22nd, stored in two loads that overlap, and the stream from the 15th on."""
    lake = lake_of(spark, label)
    store = ParquetStore(spark, lake.table("store"))
    every, at = events_of(spark, sf_dir), F.col("event_timestamp")
    active_users.store_load(store, every.where(at < F.lit("2024-01-12").cast("timestamp")))
    active_users.store_load(store, every.where(at.between(F.lit("2024-01-10"), F.lit("2024-01-21 23:59:59.999999"))))
    live_events = given.stream_events(spark, sf_dir).where(at >= F.lit("2024-01-15").cast("timestamp"))
    return store, live_events, lake


@query
def live_dau_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend of the stored days with the live users in it: every user of a day once, stored, live or both."""
    store, stream, lake = _stored_and_live(spark, sf_dir, "dau-merged")
    jobs.finish([active_users.keep_live_keys(stream, lake.table("keys"), lake.checkpoint("keys"), "available_now")])
    stored = active_users.stored_keys(store)
    trend = active_users.count_keys(stored).select(
        F.col("day").cast("string").alias("date"), F.col("users").alias("daily_active_users"),
        F.col("users").alias("stored_users"))
    users = active_users.count_keys(stored, spark.read.parquet(lake.table("keys")))
    return tidy(active_users.patch_trend(trend, users))


@query
def live_dau_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same days from merged sketches: the exact count, and whether the estimate is within four standard errors."""
    store, stream, lake = _stored_and_live(spark, sf_dir, "dau-sketch")
    jobs.finish([active_users.keep_live_sketches(stream, lake.table("sketches"), lake.checkpoint("sketches"), "available_now")])
    seen = live.read_totals(spark, lake.table("sketches"), active_users.day_sketches(events_of(spark, sf_dir)).schema)
    merged = active_users.merge_sketches(active_users.stored_sketches(store), seen)
    exact = active_users.count_keys(active_users.day_keys(events_of(spark, sf_dir)))
    close = F.abs(F.col("estimate") - F.col("users")) <= F.greatest(F.lit(1.0), F.col("users") * (4 * 1.04 / 2 ** (active_users.SKETCH_BITS / 2)))
    estimates = active_users.count_sketches(merged).withColumnRenamed("users", "estimate")
    return tidy(exact.join(estimates, "day", "full").select("day", "users", close.alias("close")))


@query
def live_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = lake_of(spark, "live-recent")
    stream = given.stream_events(spark, sf_dir).select("event_id", "user_id", "event_type", "event_timestamp")
    jobs.finish([live.keep_recent(stream, lake.table("recent"), lake.checkpoint("recent"), "available_now")])
    return tidy(live.read_totals(spark, lake.table("recent"), stream.schema))


# --- batch operators over events and sessions -------------------------------------------------


@query
def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(unique_events(spark, sf_dir).select("idempotency_key", "event_id", "user_id", "event_timestamp"))


@query
def explode_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sessions.explode_sessions(sessions_of(spark, sf_dir))
    return tidy(rows.select("user_id", "event_timestamp", "event_id", "event_type", "device_type", "event_count"))


@query
def users_from_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(sessions.users_in(sessions_of(spark, sf_dir)).select("user_id", "device_type", "country", "sessions"))


@query
def high_activity_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(sessions.high_activity_users(sessions_of(spark, sf_dir), RULE.more_than))


@query
def silver_partition_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lake_of(spark, "silver-read").table("silver")
    write_partitioned(sessions_of(spark, sf_dir), path, ("date",))
    rows = read_partition(spark, path, SILVER_DATE, SILVER_SESSION)
    return tidy(rows.select("user_id", "window_start", "event_count", "date"))


# --- dimensions -------------------------------------------------------------------------------


@query
def dim_time_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar rows of the hours in which events or orders fall, each once."""
    hours = events_of(spark, sf_dir).select("event_timestamp").unionByName(
        given.read_table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("timestamp").alias("event_timestamp"))
    )
    return tidy(dims.hours_of(hours))


@query
def dim_device_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The device dimension and the events that resolve to each row."""
    devices = dims.device_dimension(spark)
    used = dims.lookup_device(events_of(spark, sf_dir), devices).groupBy("device_key").agg(F.count("*").alias("events"))
    return tidy(devices.join(used, "device_key", "left").select(
        "device_key", "device_type", "device_category", "os_family", "browser_family", "is_mobile", "is_tablet",
        "is_desktop", F.coalesce("events", F.lit(0)).alias("events"),
    ))


@query
def dim_event_type_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types seen in the data are inserted first; the listed types fill in what is absent."""
    listed = dims.event_type_dimension(spark)
    seen = listed.join(events_of(spark, sf_dir).select("event_type").distinct(), "event_type", "left_semi")
    both = seen.withColumn("from_data", F.lit(True)).unionByName(
        dims.absent_from(seen, listed, ["event_type"]).withColumn("from_data", F.lit(False))
    )
    return tidy(both.select("event_type_key", "event_type", "event_category", "description", "from_data"))


@query
def dim_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions written to a store and read back: rows and key range of each."""
    store = ParquetStore(prepare(spark), work_dir(spark, "dim-reads"))
    store.append("dim_user", given.user_dimension(spark, sf_dir))
    store.append("dim_product", given.product_dimension(spark, sf_dir))
    store.append("dim_time", dims.hours_of(events_of(spark, sf_dir)))
    parts = []
    for name, key in (("dim_user", "user_key"), ("dim_product", "product_key"), ("dim_time", "time_key")):
        parts.append(store.read(name).agg(
            F.count("*").alias("rows"), F.min(key).cast("bigint").alias("low"), F.max(key).cast("bigint").alias("high")
        ).select(F.lit(name).alias("table_name"), "rows", "low", "high"))
    return tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = assign_keys(unique_events(spark, sf_dir).select("event_id"), "event_id", "event_key", start_after=1000)
    return tidy(keyed)


@query
def time_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = dims.lookup_time(events_of(spark, sf_dir), dims.time_dimension(spark))
    return tidy(keyed.select("event_id", "event_timestamp", "time_key"))


@query
def event_type_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = given.payment_events(events_of(spark, sf_dir)).withColumn("product_id", F.col("payload")["product_id"])
    keyed = dims.lookup_product(
        dims.lookup_event_type(paid, dims.event_type_dimension(spark)), given.product_dimension(spark, sf_dir)
    )
    return tidy(keyed.select("event_id", "event_type_key", "event_category", "product_key"))


# --- user history -----------------------------------------------------------------------------


def _load_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.users_in(sessions_of(spark, sf_dir))


@query
def new_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = scd2.new_users(given.user_dimension(spark, sf_dir), _load_users(spark, sf_dir))
    return tidy(added.select("user_id", "device_type", "country"))


@query
def scd2_insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New users appended to a stored dimension, then read back."""
    store = ParquetStore(prepare(spark), work_dir(spark, "scd2-insert"))
    opening = given.user_dimension(spark, sf_dir)
    store.append("dim_user", opening)
    added = scd2.first_versions(scd2.new_users(opening, _load_users(spark, sf_dir)), AS_OF)
    store.append("dim_user", assign_keys(added, "user_id", "user_key", scd2.highest_key(opening, "user_key"))
                 .select(*DIM_USER.names))
    return _user_columns(store.read("dim_user", DIM_USER).where(F.col("effective_start_date") == F.lit(AS_OF)))


def _user_columns(dim: DataFrame) -> DataFrame:
    return tidy(dim.select("user_key", "user_id", "username", "plan_type", "subscription_status", "user_tier",
                           "country", "signup_date", "signup_source", "effective_start_date", "effective_end_date",
                           "is_current", "version_number"))


@query
def scd2_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = scd2.mark_upgrades(given.user_dimension(spark, sf_dir), _load_users(spark, sf_dir), RULE)
    return _user_columns(scd2.expire(marked, AS_OF))


@query
def scd2_upgrade(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = scd2.mark_upgrades(given.user_dimension(spark, sf_dir), _load_users(spark, sf_dir), RULE)
    versions = scd2.next_versions(marked, AS_OF, RULE)
    return tidy(versions.select("user_id", "username", "plan_type", "user_tier", "country", "effective_start_date",
                                "is_current", "version_number"))


@query
def scd2_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    opening = given.user_dimension(spark, sf_dir)
    return _user_columns(scd2.apply_scd2(opening, sessions_of(spark, sf_dir), AS_OF, RULE))


@query
def scd2_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load merged into a bucketed dimension, of which the changed buckets are rewritten."""
    root = work_dir(prepare(spark), "scd2-bucketed")
    dim = BucketedDimension(spark, f"{root}/dim_user", DIM_USER, "user_id", buckets=32)
    dim.replace(given.user_dimension(spark, sf_dir))
    scd2.merge_scd2(dim, KeyLedger(spark, f"{root}/keys"), sessions_of(spark, sf_dir), AS_OF, RULE)
    return _user_columns(dim.read())


@query
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(scd2.history_from_changes(given.plan_changes(prepare(spark), sf_dir)))


@query
def view_current_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    joins.current_users(mart_users(spark, sf_dir)).createOrReplaceTempView("current_users")
    return tidy(spark.table("current_users").select("user_key", "user_id", "plan_type", "country"))


@query
def revenue_by_plan_pit(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = scd2.history_from_changes(given.plan_changes(prepare(spark), sf_dir))
    return tidy(joins.revenue_by_plan(events_of(spark, sf_dir), versions))


@query
def revenue_by_plan_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The point-in-time join as one ordered stream of facts and versions."""
    versions = scd2.history_from_changes(given.plan_changes(prepare(spark), sf_dir))
    return tidy(joins.revenue_by_plan(events_of(spark, sf_dir), versions, merged=True))


# --- facts ------------------------------------------------------------------------------------


@query
def fact_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    real = facts.measures(F.col("total_amount"), F.col("quantity"))
    fixed = {f"constant_{name}": value for name, value in facts.measures().items() if name.startswith("purchase")}
    rows = events_of(spark, sf_dir).withColumns({**real, **fixed})
    return tidy(rows.select("event_id", *real, *fixed))


@query
def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(star_facts(spark, sf_dir).select(
        "event_id", "idempotency_key", "user_key", "time_key", "device_key", "event_type", "schema_version",
        "ip_address", "geo_country", "page_view_count", "purchase_amount", "purchase_quantity", "is_conversion",
        "is_error", "event_timestamp", "data_quality_score",
    ))


def _warehouse(spark: SparkSession, sf_dir: str, label: str) -> daily.Warehouse:
    warehouse = daily.Warehouse(prepare(spark), work_dir(spark, label),
                                fact_buckets=spark.sparkContext.defaultParallelism)
    warehouse.seed()
    warehouse.store.append("dim_user", given.user_dimension(spark, sf_dir))
    return warehouse


@query
def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load of half the month, then a second of everything: no key is stored twice."""
    warehouse = _warehouse(spark, sf_dir, "fact-upsert")
    every = events_of(spark, sf_dir)
    early = every.where(F.col("event_timestamp") < F.lit("2024-01-16").cast("timestamp"))
    first = daily.load_events(warehouse, early, "2024-01-16")
    second = daily.load_events(warehouse, every, "2024-01-31")
    return tidy(warehouse.facts.read().groupBy("load_date").agg(
        F.count("*").alias("rows"), F.count_distinct("event_key").alias("keys"),
        F.min("event_key").alias("low_key"), F.max("event_key").alias("high_key"),
        F.sum("purchase_amount").alias("amount"),
    ).withColumn("inserted", F.when(F.col("load_date") == "2024-01-16", first).otherwise(second)))


@query
def fact_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads: some keys, other keys, and everything. Only the last has to look at stored keys."""
    warehouse = _warehouse(spark, sf_dir, "fact-key-filter")
    every = events_of(spark, sf_dir).withColumn("_part", F.substring("idempotency_key", 2, 20).cast("bigint") % 4)
    done = {}
    for day, rows in (("2024-01-10", every.where("_part = 0")), ("2024-01-11", every.where("_part in (1, 2)")),
                      ("2024-01-12", every)):
        rows = facts.build_facts(rows, warehouse.dim_user, warehouse.store.read("dim_device"),
                                 warehouse.store.read("dim_time"))
        done[day] = facts.load_new_facts(warehouse.facts, rows, day)
    joined = F.create_map(*[F.lit(x) for day, load in done.items() for x in (day, len(load.joined))])
    return tidy(warehouse.facts.read().groupBy("load_date").agg(
        F.count("*").alias("rows"), F.min("event_key").alias("low_key"), F.max("event_key").alias("high_key"),
        F.count_distinct("idempotency_key").alias("keys"),
    ).withColumn("loads_joined", joined[F.col("load_date")]))


@query
def daily_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything loaded twice under one date: facts after the first load equal those after the second."""
    warehouse = _warehouse(spark, sf_dir, "daily-rerun")
    every = events_of(spark, sf_dir)
    loaded = [daily.load_events(warehouse, every, AS_OF) for _ in range(2)]
    return tidy(warehouse.facts.read().select("idempotency_key", "event_id", "event_key").withColumns(
        {"first_load": F.lit(loaded[0]), "second_load": F.lit(loaded[1])}
    ))


@query
def fact_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the parsed raw events: valid ones only, at their own time, with the payload's amount."""
    bronze = jobs.bronze_rows(given.as_messages(given.read_table(spark, sf_dir, "events")))
    rows = facts.build_facts(facts.events_of_bronze(bronze), given.user_dimension(spark, sf_dir),
                             dims.device_dimension(spark), dims.time_dimension(spark))
    return tidy(rows.select("event_id", "idempotency_key", "user_key", "time_key", "device_key", "event_type",
                            "session_id", "purchase_amount", "purchase_quantity", "is_error", "event_timestamp",
                            "kafka_timestamp"))


@query
def fact_purchases_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facts.build_purchases(
        given.payment_events(unique_events(spark, sf_dir)), given.user_dimension(spark, sf_dir),
        dims.time_dimension(spark), given.product_dimension(spark, sf_dir),
    )
    return tidy(rows.select("event_id", "user_key", "time_key", "product_key", "transaction_id", "payment_method",
                            "currency", "amount", "discount_amount", "quantity", "status", "event_timestamp"))


@query
def view_denormalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star_facts(spark, sf_dir).withColumn("event_key", F.col("event_id").cast("bigint"))
    joins.denormalized(
        rows, given.user_dimension(spark, sf_dir), dims.time_dimension(spark), dims.device_dimension(spark)
    ).createOrReplaceTempView("fact_events_denormalized")
    return tidy(spark.table("fact_events_denormalized"))


# --- marts and KPIs ---------------------------------------------------------------------------


def _stored_mart(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """Materialise a mart in full, as a consumer of the KPIs would find it."""
    store = ParquetStore(prepare(spark), work_dir(spark, name))
    store.overwrite(name, rows)
    return store.read(name)


@query
def mart_dau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(marts.daily_active_users(mart_facts(spark, sf_dir)).orderBy(F.desc("activity_date")))


@query
def mart_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(marts.revenue_per_user(mart_facts(spark, sf_dir), mart_users(spark, sf_dir)))


@query
def mart_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(marts.churn_risk(idle_facts(spark, sf_dir), mart_users(spark, sf_dir), CHURN_AS_OF))


@query
def churn_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = marts.activity_per_user(idle_facts(spark, sf_dir), mart_users(spark, sf_dir), CHURN_AS_OF)
    return tidy(activity.groupBy("churn_risk_level").agg(F.count("*").alias("users"),
                                                         F.sum("total_events").alias("events")))


@query
def mart_materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart refreshed twice: readers see the rows of the last refresh only."""
    store = ParquetStore(prepare(spark), work_dir(spark, "mart-refresh"))
    for _ in range(2):
        store.overwrite("daily_active_users", marts.daily_active_users(mart_facts(spark, sf_dir)))
    return tidy(store.read("daily_active_users"))


def _partials(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Partial aggregates of ten loads, one of them loaded twice and the first five folded into one."""
    table = PartTable(prepare(spark), work_dir(spark, label), MART_PARTIALS)
    dealt = rows.withColumn("_load", F.pmod(F.xxhash64("event_id"), F.lit(10)))
    for load in (*range(10), 3):
        table.replace(f"load-{load}", marts.partials(dealt.where(F.col("_load") == load)))
    table.fold([f"load-{n}" for n in range(5)], marts.merge_partials)
    return table.read()


@query
def mart_dau_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(marts.daily_active_users_of(_partials(spark, mart_facts(spark, sf_dir), "dau-partials")))


@query
def mart_revenue_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _partials(spark, mart_facts(spark, sf_dir), "revenue-partials")
    return tidy(marts.revenue_per_user_of(parts, mart_users(spark, sf_dir)))


@query
def mart_churn_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _partials(spark, idle_facts(spark, sf_dir), "churn-partials")
    return tidy(marts.churn_risk_of(parts, mart_users(spark, sf_dir), CHURN_AS_OF))


@query
def kpi_dau(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = _stored_mart(spark, "daily_active_users", marts.daily_active_users(mart_facts(spark, sf_dir)))
    return tidy(kpis.dau_trend(mart, days=20))


@query
def kpi_dau_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = _stored_mart(spark, "daily_active_users", marts.daily_active_users(mart_facts(spark, sf_dir)))
    return tidy(kpis.dau_trend(mart, days=20, latest=True))


def _revenue_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_mart(spark, "revenue_per_user",
                        marts.revenue_per_user(mart_facts(spark, sf_dir), mart_users(spark, sf_dir)))


def _churn_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_mart(spark, "churn_risk",
                        marts.churn_risk(idle_facts(spark, sf_dir), mart_users(spark, sf_dir), CHURN_AS_OF))


@query
def kpi_revenue_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(kpis.top_revenue(_revenue_mart(spark, sf_dir)))


@query
def kpi_churn_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(kpis.top_churn(_churn_mart(spark, sf_dir)))


@query
def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(kpis.summary(_revenue_mart(spark, sf_dir), _churn_mart(spark, sf_dir)))


# --- quality ----------------------------------------------------------------------------------


@query
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written just now are fresh, on every date, as their listing says."""
    path = lake_of(spark, "dq-freshness").table("silver")
    write_partitioned(sessions_of(spark, sf_dir), path, ("date",))
    return tidy(quality.freshness(quality.list_files(spark, path)).select("date", "check_name", "status"))


@query
def dq_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date as the target of the volume check."""
    counts = quality.daily_counts(events_of(spark, sf_dir).withColumn("date", F.to_date("event_timestamp")))
    rows = quality.volume(counts, threshold_pct=5)
    return tidy(rows.select("date", "status", F.round("check_value", 6).alias("deviation_pct")))


@query
def dq_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL profile of the parsed raw events, broken ones included."""
    parsed = parsed_of(spark, sf_dir).withColumn("date", F.to_date("ts"))
    rows = quality.null_profile(parsed, ["event_id", "user_id", "timestamp", "no_such_column"])
    return tidy(rows.select("date", "column_name", "total_count", "null_count", "status"))


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume and null checks of every date rolled up, written as JSON and read back."""
    parsed = parsed_of(spark, sf_dir).withColumn("date", F.to_date("ts").cast("string"))
    rolled = quality.report(
        quality.volume(quality.daily_counts(parsed), threshold_pct=5), quality.nulls(parsed, ["ts", "raw_value"])
    )
    path = lake_of(spark, "dq-report").table("report")
    quality.write_report(rolled, path)
    return tidy(spark.read.schema(rolled.schema).json(path).drop("checks"))


@query
def dq_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = ParquetStore(prepare(spark), work_dir(spark, "dq-log"))
    counts = quality.daily_counts(events_of(spark, sf_dir).withColumn("date", F.to_date("event_timestamp")))
    store.append("data_quality_checks", quality.log_rows(quality.volume(counts, threshold_pct=5), "events"))
    return tidy(store.read("data_quality_checks").select("check_name", "table_name", "check_type", "status",
                                                         "threshold_value"))


@query
def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over the events, logged with the records it processed."""
    store = ParquetStore(prepare(spark), work_dir(spark, "job-runs"))
    logged_run(store, "count_events", "batch", lambda: unique_events(spark, sf_dir).count())
    return tidy(store.read("job_runs").select("job_name", "job_type", "status", "records_processed", "error_message"))


@query
def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(coltests.duplicates(events_of(spark, sf_dir), "idempotency_key"))


@query
def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsed_of(spark, sf_dir)
    names = ["event_id", "user_id", "timestamp", "event_type", "schema_version"]
    tests = [coltests.ColumnTest("parsed", name, "not_null") for name in names]
    return tidy(coltests.run_column_tests(spark, {"parsed": parsed}, tests))


@query
def test_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = [
        coltests.ColumnTest("events", "event_type", "accepted_values", ("page_view", "purchase")),
        coltests.ColumnTest("events", "device_type", "accepted_values", ("mobile", "desktop", "tablet", "other")),
    ]
    return tidy(coltests.run_column_tests(spark, {"events": events_of(spark, sf_dir)}, tests))


@query
def test_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users without a dimension row, and how many events each has."""
    rows = coltests.orphans(events_of(spark, sf_dir), "user_id", given.user_dimension(spark, sf_dir), "user_id")
    return tidy(rows)


@query
def column_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared tests of the star schema and the marts, over a stored fact table."""
    fact_rows = materialize(
        star_facts(spark, sf_dir).withColumn("event_key", F.col("event_id").cast("bigint")), "tested-facts"
    )
    users = given.user_dimension(spark, sf_dir)
    tables = {
        "fact_events": fact_rows, "dim_user": users, "dim_time": dims.hours_of(events_of(spark, sf_dir)),
        "dim_device": dims.device_dimension(spark),
        "daily_active_users": marts.daily_active_users(fact_rows),
        "revenue_per_user": marts.revenue_per_user(fact_rows, users),
        "churn_risk": marts.churn_risk(fact_rows, users, CHURN_AS_OF),
    }
    return tidy(coltests.run_column_tests(spark, tables))


@query
def purchase_total_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchases = events_of(spark, sf_dir).where(F.col("event_type") == "purchase").withColumn(
        "discount_amount", F.lit(0).cast("decimal(12,2)")
    )
    return tidy(facts.wrong_totals(purchases).select("event_id", "unit_price", "quantity", "total_amount"))


for _fn in (test_unique, test_not_null, test_accepted_values, test_relationships):
    _fn.__test__ = False
