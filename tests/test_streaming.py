import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryException

from eventlode.operators import sessions, validate
from eventlode.operators.dedup import keep_first_streaming
from eventlode.schemas import MESSAGE
from eventlode.sources import streams
from eventlode.streaming import jobs, live
from eventlode.streaming.run import start_parquet, supervise
from helpers import events

# (user, key, time) per delivery; the watermark of one delivery judges the next.
DELIVERIES = [
    [(1, "a", "00:05"), (1, "b", "02:00"), (2, "x", "01:00"), (2, "y", "01:30"), (3, "m", "02:00:30")],
    [(1, "c", "00:06"), (1, "d", "01:51"), (1, "b", "02:00"), (1, "e", "01:45"), (1, "f", "01:20")],
    [(9, "z", "09:00")],
]


def deliver(spark, tmp_path, shape):
    lake = jobs.Lake(str(tmp_path))
    layout = None
    for i, rows in enumerate(DELIVERIES):
        frame = events(spark, rows).withColumn("event_id", F.concat(F.lit(f"{i}-"), "event_id"))
        layout = frame.schema
        frame.write.mode("append").parquet(lake.table("landing"))
        stream = jobs.watermarked(spark.readStream.schema(layout).parquet(lake.table("landing")))
        jobs.finish([start_parquet(shape(stream), lake.table("out"), lake.checkpoint("out"), "available_now", "late")])
    return spark.read.parquet(lake.table("out"))


def windows(df):
    return sorted((r.user_id, r.window_start.strftime("%H:%M"), r.event_count) for r in df.collect())


def test_late_events_enter_open_windows_only(spark, tmp_path):
    found = windows(deliver(spark, tmp_path, sessions.tumbling_sessions_streaming))
    assert found == [("1", "00:00", 1), ("1", "01:30", 2), ("1", "02:00", 2), ("2", "01:00", 1), ("2", "01:30", 1),
                     ("3", "02:00", 1)]


def test_late_events_after_dedup(spark, tmp_path):
    found = windows(deliver(spark, tmp_path, lambda s: sessions.tumbling_sessions_streaming(keep_first_streaming(s))))
    assert found == [("1", "00:00", 1), ("1", "01:30", 1), ("1", "02:00", 1), ("2", "01:00", 1), ("2", "01:30", 1),
                     ("3", "02:00", 1)]


def test_gap_sessions_merge_across_deliveries(spark, tmp_path):
    out = deliver(spark, tmp_path, sessions.gap_sessions_streaming)
    found = sorted((r.user_id, r.session_start.strftime("%H:%M"), r.session_end.strftime("%H:%M"), r.event_count)
                   for r in out.collect())
    assert found == [("1", "00:05", "00:35", 1), ("1", "01:45", "02:30", 4), ("2", "01:00", "02:00", 2),
                     ("3", "02:00", "02:30", 1)]


def test_parts_and_slide(spark, tmp_path):
    out = deliver(spark, tmp_path / "p", lambda s: sessions.tumbling_sessions_streaming(s, parts=4))
    per_window = out.groupBy("user_id", "window_start").agg(F.sum("event_count").alias("event_count"))
    assert windows(per_window)[:3] == [("1", "00:00", 1), ("1", "01:30", 2), ("1", "02:00", 2)]
    slid = deliver(spark, tmp_path / "s", lambda s: sessions.tumbling_sessions_streaming(s, slide="15 minutes"))
    assert ("1", "00:00", 1) in windows(slid) and ("1", "23:45", 1) in windows(slid)


def messages(spark, texts):
    return spark.createDataFrame([(bytearray(b"k"), bytearray(t.encode())) for t in texts], "key binary, value binary") \
        .withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")).select(*MESSAGE.names)


def event_text(i, at="2024-01-01T01:00:00Z", kind="purchase"):
    return json.dumps({"event_id": str(i), "user_id": f"u{i % 3}", "timestamp": at, "event_type": kind,
                       "schema_version": "v1", "idempotency_key": f"k{i}", "payload": {"total_amount": 2.5}})


def test_whole_job_and_restart(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path / "lake"))
    landing = str(tmp_path / "landing")
    source = lambda: streams.file_stream(spark, landing, MESSAGE)
    count = lambda name: spark.read.parquet(lake.table(name)).count()
    messages(spark, [event_text(i) for i in range(6)] + [event_text(9, at="12345"), "{", ""]).write.parquet(landing)
    for _ in range(2):
        jobs.run_stream(spark, source(), lake, "both", "available_now")
        assert (count("bronze"), count("dead_letters"), count("feed")) == (9, 3, 6)
    messages(spark, [event_text(20, at="2024-01-01T09:00:00Z")]).write.mode("append").parquet(landing)
    jobs.run_stream(spark, source(), lake, "both", "available_now")
    assert (count("bronze"), count("silver_tumbling"), count("feed")) == (10, 3, 7)
    bronze = spark.read.parquet(lake.table("bronze"))
    assert {"date", "event_type"} <= set(bronze.columns) and bronze.where("raw_value = '{'").count() == 1
    decoded = streams.decode_feed(spark.read.parquet(lake.table("feed")))
    assert decoded.where("key = user_id").count() == 7


def test_mode_is_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.run_stream(spark, None, jobs.Lake(str(tmp_path)), "gold")
    with pytest.raises(ValueError):
        jobs.write_sessions(events(spark, [(1, "a", "00:01")]), jobs.Lake(str(tmp_path)), kind="hopping")


def test_failure_of_one_query_stops_the_others(spark, tmp_path):
    events(spark, [(1, "a", "00:01")]).write.parquet(str(tmp_path / "in"))
    layout = spark.read.parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(layout).parquet(str(tmp_path / "in"))

    def fail(batch, _):
        raise RuntimeError("sink is gone")

    good = start_parquet(stream, str(tmp_path / "o"), str(tmp_path / "c1"), "1 second", "good")
    bad = stream.writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "c2")).start()
    started = time.time()
    with pytest.raises(StreamingQueryException):
        supervise([good, bad])
    assert not good.isActive and time.time() - started < 60


def test_recent_events_are_merged_over_batches(spark, tmp_path):
    landing, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for day in (3, 1, 2):
        frame = events(spark, [(1, f"{day}-{i}", f"2024-01-0{day} 00:{i:02d}:00") for i in range(8)])
        frame = frame.withColumn("event_id", F.concat(F.lit(f"{day}-"), "event_id")).select(
            "event_id", "user_id", "event_timestamp")
        frame.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(frame.schema).parquet(landing)
        jobs.finish([live.keep_recent(stream, path, checkpoint, "available_now")])
    kept = live.read_totals(spark, path, frame.schema)
    assert kept.count() == 10
    assert {r.event_timestamp.day for r in kept.collect()} == {2, 3}


def test_live_users_and_revenue_over_batches(spark, tmp_path):
    landing = str(tmp_path / "in")
    for batch in ([(1, "a", "00:01"), (1, "b", "00:02")], [(1, "c", "01:00"), (2, "d", "2024-01-02 01:00:00")]):
        frame = events(spark, batch)
        frame.write.mode("append").parquet(landing)
        totals = live.users_per_day(spark.readStream.schema(frame.schema).parquet(landing))
        jobs.finish([live.keep_totals(totals, str(tmp_path / "u"), str(tmp_path / "cu"), "available_now", "users")])
    rows = live.read_totals(spark, str(tmp_path / "u"), totals.schema)
    assert sorted((str(r.day), r.live_users) for r in rows.collect()) == [("2024-01-01", 1), ("2024-01-02", 1)]
    approx = live.users_per_day_approx(frame).collect()
    assert sum(r.live_users for r in approx) == 2
    assert live.read_totals(spark, str(tmp_path / "nothing"), totals.schema).count() == 0


def test_unclean_amounts_do_not_stop_the_counter(spark):
    feed = spark.createDataFrame(
        [("purchase", {"total_amount": "1.50"}), ("purchase", {"total_amount": "lots"}), ("page_view", {})],
        "event_type string, payload map<string,string>",
    )
    row = live.revenue(feed).first()
    assert float(row.live_revenue) == 1.5 and row.purchases == 2


def test_valid_rows_are_published_before_dedup(spark):
    parsed = jobs.bronze_rows(messages(spark, [event_text(1), event_text(1)]))
    valid = validate.accepted(validate.route(parsed)).drop("event_timestamp")
    assert jobs.feed_rows(valid).count() == 2
