"""Sessions: fixed windows per user, and gap-based sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from eventlode.schemas import SESSION_WINDOW

# A window with more events than this is written as several rows, so that no array holds an
# unbounded group. Parts are told apart by part_no; everything downstream groups by the window.
EVENTS_PER_ROW = 100_000

# Rows of the oversized-window list that may be broadcast (about forty bytes each).
BROADCAST_ROWS = 200_000


def _first_seen():
    return F.min_by(
        F.struct("device_type", "ip_address", "geo_location"), F.struct("event_timestamp", "event_id")
    ).alias("first_seen")


def _window_rows(events: DataFrame, window: str, slide: str | None) -> DataFrame:
    """Aggregate events carrying ``part_no`` into one row per (user, window, part)."""
    entries = F.sort_array(F.collect_list(F.struct("event_timestamp", "event_id", "event_type")))
    span = F.window("event_timestamp", window, slide) if slide else F.window("event_timestamp", window)
    return (
        events.groupBy("user_id", span.alias("span"), "part_no")
        .agg(
            F.count("*").alias("event_count"),
            F.min("event_timestamp").alias("session_start"),
            F.max("event_timestamp").alias("session_end"),
            entries.alias("entries"),
            _first_seen(),
        )
        .select(
            "user_id",
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            "part_no",
            "event_count",
            "session_start",
            "session_end",
            F.col("entries.event_type").alias("event_types"),
            F.col("entries.event_id").alias("event_ids"),
            F.col("first_seen.device_type").alias("primary_device"),
            F.col("first_seen.ip_address").alias("primary_ip"),
            F.col("first_seen.geo_location").alias("primary_geo"),
            F.current_timestamp().alias("processed_at"),
            F.to_date("span.start").cast("string").alias("date"),
        )
    )


def tumbling_sessions(events: DataFrame, window: str = SESSION_WINDOW, events_per_row: int = EVENTS_PER_ROW,
                      counted: DataFrame | None = None) -> DataFrame:
    """Batch: one row per user and window with its counts and ordered event lists.

    A first job counts the events of each window (combined before the shuffle, two columns read) and
    keeps the oversized ones, of which there are at most rows / ``events_per_row``. Without any, the
    sessions are a single aggregation. Otherwise the events of oversized windows are spread over as
    many parts as needed by a hash of their id. ``counted`` may name a cheaper frame holding at
    least these events, such as the rows before deduplication.
    """
    span = F.window("event_timestamp", window)["start"]
    oversized = (
        (events if counted is None else counted)
        .groupBy("user_id", span.alias("big_start"))
        .agg(F.count("*").alias("events"))
        .where(F.col("events") > events_per_row)
        .select(F.col("user_id").alias("big_user"), "big_start",
                F.ceil(F.col("events") / events_per_row).alias("parts"))
    )
    windows = oversized.count()
    if windows == 0:
        return _window_rows(events.withColumn("part_no", F.lit(0)), window, None)
    if windows <= BROADCAST_ROWS:
        oversized = F.broadcast(oversized)
    marked = events.withColumn("_start", span).join(
        oversized, (F.col("user_id") == F.col("big_user")) & (F.col("_start") == F.col("big_start")), "left"
    )
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("event_id"), F.col("parts")))
    return _window_rows(marked.withColumn("part_no", part.cast("int")), window, None)


def tumbling_sessions_streaming(events: DataFrame, window: str = SESSION_WINDOW, slide: str | None = None,
                                parts: int = 1) -> DataFrame:
    """Streaming: the same rows from a watermarked stream.

    A stream cannot count a window before it has seen it, so the number of parts is an argument:
    raise it where one user can send more events per window than one state row should hold.
    """
    part = F.pmod(F.xxhash64("event_id"), F.lit(parts)) if parts > 1 else F.lit(0)
    return _window_rows(events.withColumn("part_no", part.cast("int")), window, slide)


def gap_sessions(events: DataFrame, gap: str = SESSION_WINDOW) -> DataFrame:
    """Batch: sessions that end after ``gap`` without an event (a gap of exactly that length does not).

    Events inside one slot of the gap's length always share a session, so they are first combined
    per (user, slot) before the shuffle. Only these summaries are ordered per user: their number
    grows with the time covered, not with how busy the user is.
    """
    slots = (
        events.groupBy("user_id", F.window("event_timestamp", gap)["start"].alias("slot"))
        .agg(
            F.count("*").alias("slot_events"),
            F.min("event_timestamp").alias("slot_first"),
            F.max("event_timestamp").alias("slot_last"),
            _first_seen(),
        )
    )
    by_user = Window.partitionBy("user_id").orderBy("slot")
    previous = F.lag("slot_last").over(by_user)
    starts = previous.isNull() | (F.col("slot_first") > previous + F.expr(f"interval {gap}"))
    return (
        slots.withColumn("_starts", starts.cast("int"))
        .withColumn("_session", F.sum("_starts").over(by_user))
        .groupBy("user_id", "_session")
        .agg(
            F.min("slot_first").alias("session_start"),
            F.max("slot_last").alias("last_event_at"),
            F.sum("slot_events").alias("event_count"),
            F.min_by("first_seen", "slot_first").alias("first_seen"),
        )
        .select(
            "user_id",
            "session_start",
            (F.col("last_event_at") + F.expr(f"interval {gap}")).alias("session_end"),
            "last_event_at",
            "event_count",
            F.col("first_seen.device_type").alias("primary_device"),
        )
    )


def gap_sessions_streaming(events: DataFrame, gap: str = SESSION_WINDOW) -> DataFrame:
    """Streaming: the same sessions from a watermarked stream."""
    return (
        events.groupBy("user_id", F.session_window("event_timestamp", gap).alias("span"))
        .agg(
            F.count("*").alias("event_count"),
            F.max("event_timestamp").alias("last_event_at"),
            _first_seen(),
        )
        .select(
            "user_id",
            F.col("span.start").alias("session_start"),
            F.col("span.end").alias("session_end"),
            "last_event_at",
            "event_count",
            F.col("first_seen.device_type").alias("primary_device"),
        )
    )


def explode_sessions(sessions: DataFrame) -> DataFrame:
    """One row per listed event. As in the source data, the session start stands in for its time."""
    return sessions.select(
        "user_id",
        F.col("session_start").alias("event_timestamp"),
        F.col("primary_device").alias("device_type"),
        F.col("primary_ip").alias("ip_address"),
        F.col("primary_geo").alias("geo_location"),
        "event_count",
        F.explode(F.arrays_zip("event_ids", "event_types")).alias("entry"),
    ).select(
        "user_id", "event_timestamp", "device_type", "ip_address", "geo_location", "event_count",
        F.col("entry.event_ids").alias("event_id"),
        F.col("entry.event_types").alias("event_type"),
    )


def users_in(sessions: DataFrame) -> DataFrame:
    """One row per user: attributes of the latest session and the number of sessions."""
    latest = F.max_by(
        F.struct("primary_device", F.col("primary_geo")["country"].alias("country"),
                 F.col("primary_geo")["region"].alias("region"), F.col("primary_geo")["city"].alias("city")),
        F.struct("window_start", "part_no"),
    )
    return (
        sessions.groupBy("user_id")
        .agg(latest.alias("latest"), F.count_distinct("window_start").alias("sessions"))
        .select("user_id", F.col("latest.primary_device").alias("device_type"), "latest.country",
                "latest.region", "latest.city", "sessions")
    )


def high_activity_users(sessions: DataFrame, more_than: int) -> DataFrame:
    return (
        sessions.groupBy("user_id").agg(F.count_distinct("window_start").alias("sessions"))
        .where(F.col("sessions") > more_than)
    )
