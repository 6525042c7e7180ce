from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from eventlode.operators import sessions
from eventlode.operators.dedup import keep_first
from eventlode.operators.keys import assign_keys
from helpers import events, plan_of


def test_oversized_windows_are_split_and_whole(spark):
    rows = [(1, f"k{i}", f"00:{i % 30:02d}:{i % 60:02d}") for i in range(95)] + [(2, "z", "00:10")]
    frame = events(spark, rows)
    split = sessions.tumbling_sessions(frame, events_per_row=10).cache()
    whole = sessions.tumbling_sessions(frame)
    assert whole.count() == 2 and split.count() > 5
    assert split.agg(F.max(F.size("event_ids"))).first()[0] <= 30
    ids = lambda s: sorted(r.event_id for r in sessions.explode_sessions(s).collect())
    assert ids(split) == ids(whole) == sorted(r.event_id for r in frame.collect())
    assert {r.user_id: r.sessions for r in sessions.users_in(split).collect()} == {"1": 1, "2": 1}
    assert {r.user_id: r.sessions for r in sessions.high_activity_users(split, 0).collect()} == {"1": 1, "2": 1}


def test_counting_a_superset_gives_the_same_rows(spark):
    frame = events(spark, [(1, "a", "00:01"), (1, "a", "00:02"), (1, "b", "00:40")])
    unique = keep_first(frame)
    assert (sessions.tumbling_sessions(unique, counted=frame).drop("processed_at").collect()
            == sessions.tumbling_sessions(unique).drop("processed_at").collect())


def test_gap_of_exactly_thirty_minutes_merges(spark):
    frame = events(spark, [(1, "a", "01:00"), (1, "b", "01:30"), (1, "c", "02:00:01")])
    found = sorted((r.session_start, r.session_end, r.event_count) for r in sessions.gap_sessions(frame).collect())
    base = datetime(2024, 1, 1)
    assert found == [
        (base + timedelta(hours=1), base + timedelta(hours=2), 2),
        (base + timedelta(hours=2, seconds=1), base + timedelta(hours=2, minutes=30, seconds=1), 1),
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 500)), min_size=1, max_size=60))
def test_gap_sessions_match_the_built_in_window(spark, points):
    frame = events(spark, [(u, f"k{i}", f"{m // 60 % 24:02d}:{m % 60:02d}") for i, (u, m) in enumerate(points)])
    ours = sessions.gap_sessions(frame).select("user_id", "session_start", "session_end", "event_count")
    theirs = frame.groupBy("user_id", F.session_window("event_timestamp", "30 minutes").alias("w")).count().select(
        "user_id", F.col("w.start"), F.col("w.end"), "count"
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def test_dedup_keeps_the_earliest_and_limits_before_the_shuffle(spark, tmp_path):
    rows = [(1, "hot", f"00:{i:02d}") for i in range(50, 0, -1)] + [(2, "b", "00:05"), (3, "b", "00:05")]
    frame = events(spark, rows)
    kept = {r.idempotency_key: r.event_id for r in keep_first(frame).collect()}
    assert kept == {"hot": "e00049", "b": "e00050"}
    frame.write.parquet(str(tmp_path / "e"))
    plan = plan_of(keep_first(spark.read.parquet(str(tmp_path / "e"))))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_keys_are_dense_and_repeatable(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    first = {r.k: r.key for r in assign_keys(rows, "k", "key", 50, digits=2).collect()}
    second = {r.k: r.key for r in assign_keys(rows.repartition(7), "k", "key", 50, digits=2).collect()}
    third = {r.k: r.key for r in assign_keys(rows, "k", "key", 50, digits=3).collect()}
    assert first == second == third and sorted(first.values()) == list(range(51, 1051))


def test_first_attributes_follow_event_order(spark):
    frame = events(spark, [(1, "b", "00:20"), (1, "a", "00:10")]).withColumn(
        "device_type", F.when(F.col("idempotency_key") == "a", "tablet").otherwise("mobile")
    )
    row = sessions.tumbling_sessions(frame).first()
    assert row.primary_device == "tablet" and row.event_ids == ["e00001", "e00000"]
