"""Late rows with a trace, and stores that batches replace."""

import pytest
from pyspark.sql import functions as F, types as T

from eventlode.operators import sessions
from eventlode.operators.dedup import keep_first_streaming
from eventlode.schemas import MESSAGE
from eventlode.sources import streams
from eventlode.sources.batches import BatchFolders, Folders
from eventlode.streaming import jobs, late, live
from eventlode.streaming.run import start_parquet
from helpers import events
from test_streaming import DELIVERIES, event_text, messages, windows


def split(spark, tmp_path, deliveries, **options):
    path, layout = str(tmp_path / "split"), None
    for i, rows in enumerate(deliveries):
        frame = events(spark, rows).withColumn("event_id", F.concat(F.lit(f"{i}-"), "event_id"))
        layout = frame.schema
        frame.write.mode("append").parquet(str(tmp_path / "landing"))
        stream = spark.readStream.schema(layout).parquet(str(tmp_path / "landing"))
        jobs.finish([late.split_late(stream, path, str(tmp_path / "cp"), "available_now", **options)])
        yield path, layout


def keys(rows):
    return sorted(r.idempotency_key for r in rows.collect())


@pytest.mark.parametrize("window,expected", [(None, ["c", "e", "f"]), ("30 minutes", ["c", "f"])])
def test_every_row_is_on_one_side(spark, tmp_path, window, expected):
    for path, layout in split(spark, tmp_path, DELIVERIES, window=window):
        pass
    behind, kept = late.late_rows(spark, path, layout), late.punctual_rows(spark, path, layout)
    assert keys(behind) == expected
    assert sorted(keys(behind) + keys(kept)) == sorted(k for rows in DELIVERIES for _, k, _ in rows)
    row = behind.where("idempotency_key = 'c'").first()
    assert row.dlq_reason == "late_event" and row.watermark.strftime("%H:%M:%S") == "01:50:30" and row.dlq_timestamp
    marks = BatchFolders(spark, f"{path}/marks", late.MARK)
    assert marks.newest() == 2 and marks.read().first().latest.strftime("%H:%M") == "09:00"


@pytest.mark.parametrize("shape,window", [
    (sessions.tumbling_sessions_streaming, "30 minutes"),
    (lambda s: sessions.tumbling_sessions_streaming(keep_first_streaming(s)), None)])
def test_sessions_of_punctual_rows_drop_nothing_more(spark, tmp_path, shape, window):
    """As many rows as the engine drops without a trace are late here, and none is dropped after the split."""
    plain, seen = jobs.Lake(str(tmp_path / "plain")), late.DropListener()
    spark.streams.addListener(seen)
    try:
        for path, layout in split(spark, tmp_path, DELIVERIES, window=window):
            landing = spark.readStream.schema(layout).parquet(str(tmp_path / "landing"))
            for stream, name in ((landing, "engine"), (late.punctual(spark, path, layout), "traced")):
                out = start_parquet(shape(jobs.watermarked(stream)), plain.table(name), plain.checkpoint(name), "available_now", name)
                jobs.finish([out])
        found = windows(spark.read.parquet(plain.table("traced")))
        assert found == windows(spark.read.parquet(plain.table("engine")))
        late_count = late.late_rows(spark, path, layout).count()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        assert seen.dropped("traced") == 0 and seen.dropped("engine") == late_count > 0
        assert seen.rows(spark).agg(F.sum("dropped")).first()[0] == late_count
    finally:
        spark.streams.removeListener(seen)


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    """The process dies after the rows are in place and before the batch is committed: the rerun gives the same."""
    for n, (path, layout) in enumerate(split(spark, tmp_path, DELIVERIES)):
        if n == 1:
            before = keys(late.late_rows(spark, path, layout)), keys(late.punctual_rows(spark, path, layout))
            Folders(spark, str(tmp_path / "cp")).delete("commits/1")
            Folders(spark, str(tmp_path / "cp")).delete("commits/.1.crc")
            stream = spark.readStream.schema(layout).parquet(str(tmp_path / "landing"))
            jobs.finish([late.split_late(stream, path, str(tmp_path / "cp"), "available_now")])
            assert before == (keys(late.late_rows(spark, path, layout)), keys(late.punctual_rows(spark, path, layout)))


def test_whole_job_with_late_rows(spark, tmp_path):
    lake, landing = jobs.Lake(str(tmp_path / "lake")), str(tmp_path / "landing")
    for texts in ([event_text(1, "2024-01-01T05:00:00Z")], [event_text(2, "2024-01-01T01:00:00Z"), event_text(3, "2024-01-01T09:00:00Z")]):
        messages(spark, texts).write.mode("append").parquet(landing)
        jobs.run_stream(spark, streams.file_stream(spark, landing, MESSAGE), lake, "both", "available_now", keep_late=True)
    behind = spark.read.parquet(lake.table("by_lateness") + "/late/batch=*")
    assert [r.event_id for r in behind.collect()] == ["2"]
    assert spark.read.parquet(lake.table("silver_tumbling")).count() == 1
    assert spark.read.parquet(lake.table("feed")).count() == 3


def test_batches_leave_a_constant_number_of_folders(spark, tmp_path):
    layout = T.StructType().add("event_id", "string").add("n", "long")
    store = BatchFolders(spark, str(tmp_path / "s"), layout, keep=3)
    row = lambda n: spark.createDataFrame([(str(n), n)], layout).coalesce(1)
    assert store.newest() is None and store.read().count() == 0
    for n in [*range(30), 998, 999, 1_000]:
        store.write(row(n), n)
        assert len(store.folders.names()) <= 3
    assert sorted(store.folders.names()) == ["batch=1000", "batch=998", "batch=999"]
    assert len(store.read().inputFiles()) == 1 and store.read().first().n == 1_000
    assert store.read(before=1_000).first().n == 999
    # A folder that a crash left half written does not count.
    store.folders.delete("batch=1000/_SUCCESS")
    assert store.newest() == 999
    store.write(row(7), 1_000)
    assert store.read().first().n == 7
    with pytest.raises(ValueError):
        BatchFolders(spark, str(tmp_path / "s"), layout, keep=1)


def test_live_streams_keep_few_folders(spark, tmp_path):
    landing, path = str(tmp_path / "in"), str(tmp_path / "recent")
    for n in range(8):
        frame = events(spark, [(n, f"{n}", f"{n:02d}:00")]).withColumn("event_id", F.lit(f"e{n}")).select("event_id", "event_timestamp")
        frame.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(frame.schema).parquet(landing)
        jobs.finish([live.keep_recent(stream, path, str(tmp_path / "cp"), "available_now", rows=3, keep=2)])
    assert sorted(Folders(spark, path).names()) == ["batch=6", "batch=7"]
    assert sorted(r.event_id for r in live.read_totals(spark, path, frame.schema).collect()) == ["e5", "e6", "e7"]
