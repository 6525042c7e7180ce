"""Distinct users over stored and live rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from eventlode.operators import active_users as au
from eventlode.sources.tables import ParquetStore
from eventlode.streaming import jobs
from helpers import events


def counted(df):
    return {str(r.day): r.users for r in df.collect()}


def test_no_user_counts_twice(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "s"))
    first = events(spark, [(1, "a", "00:01"), (2, "b", "00:02"), (1, "c", "23:59"), (3, "d", "2024-01-02 00:00")])
    second = events(spark, [(2, "e", "05:00"), (4, "f", "2024-01-02 01:00")])
    for load in (first, second, second):
        au.store_load(store, load)
    assert counted(au.count_keys(au.stored_keys(store))) == {"2024-01-01": 2, "2024-01-02": 2}
    assert store.read(au.KEYS).count() == 4
    live = au.day_keys(events(spark, [(2, "g", "06:00"), (9, "h", "06:00"), (9, "i", "2024-01-03 00:00")]))
    merged = au.count_keys(au.stored_keys(store), live)
    assert counted(merged) == {"2024-01-01": 3, "2024-01-02": 2, "2024-01-03": 1}
    trend = spark.createDataFrame([("2023-12-31", 7), ("2024-01-01", 2), ("2024-01-02", 2)], "date string, daily_active_users long")
    patched = {r.date: r.daily_active_users for r in au.patch_trend(trend, merged).collect()}
    assert patched == {"2023-12-31": 7, "2024-01-01": 3, "2024-01-02": 2, "2024-01-03": 1}


def test_rows_without_user_or_time_count_nothing(spark, tmp_path):
    frame = events(spark, [(1, "a", "00:01")]).withColumn("user_id", F.lit(None).cast("string"))
    assert au.day_keys(frame).count() == 0 and au.day_sketches(frame).count() == 0
    store = ParquetStore(spark, str(tmp_path / "s"))
    au.store_load(store, frame)
    assert au.count_keys(au.stored_keys(store)).count() == 0


@pytest.mark.parametrize("users", [10, 3_000, 60_000])
def test_error_of_merged_sketches(spark, users):
    day = F.lit(datetime.datetime(2024, 1, 1)).alias("event_timestamp")
    part = lambda low, high: spark.range(low, high).select(F.col("id").cast("string").alias("user_id"), day)
    # Both parts hold the middle third.
    a, b = part(0, users * 2 // 3), part(users // 3, users)
    found = au.count_sketches(au.merge_sketches(au.day_sketches(a), au.day_sketches(b))).first().users
    assert abs(found - users) <= max(1, 0.065 * users)
    assert len(au.day_sketches(part(0, users)).first().sketch) <= 5_000


def test_live_streams(spark, tmp_path):
    landing = str(tmp_path / "in")
    for batch in ([(1, "a", "00:01"), (1, "b", "00:02"), (2, "c", "00:03")], [(1, "d", "01:00"), (3, "e", "2024-01-02 01:00:00")]):
        frame = events(spark, batch)
        frame.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(frame.schema).parquet(landing)
        jobs.finish([au.keep_live_keys(stream, str(tmp_path / "k"), str(tmp_path / "ck"), "available_now"),
                     au.keep_live_sketches(stream, str(tmp_path / "h"), str(tmp_path / "ch"), "available_now")])
    keys = spark.read.parquet(str(tmp_path / "k"))
    assert keys.count() == 3 and counted(au.count_keys(keys)) == {"2024-01-01": 2, "2024-01-02": 1}
    from eventlode.streaming.live import read_totals
    sketches = read_totals(spark, str(tmp_path / "h"), au.day_sketches(frame).schema)
    assert counted(au.count_sketches(sketches)) == {"2024-01-01": 2, "2024-01-02": 1}
