"""Marts from partial aggregates, packed files, listings and the merged point-in-time join."""

import math
import time

import pytest
from pyspark.sql import functions as F

from eventlode.operators import joins, marts, quality
from eventlode.plans import daily
from eventlode.schemas import MART_PARTIALS, MESSAGE
from eventlode.sources import streams
from eventlode.sources.buckets import PartTable
from eventlode.streaming import jobs
from helpers import events, plan_of, users
from test_buckets import facts_of, warehouse_of
from test_streaming import event_text, messages
from test_warehouse import OPEN


def rows_of(df):
    return sorted(map(str, df.select(*[F.col(c).cast("string") for c in sorted(df.columns)]).collect()))


def test_marts_after_ten_loads_and_a_rerun(spark, tmp_path, monkeypatch):
    warehouse = warehouse_of(spark, str(tmp_path / "w"))
    read = type(warehouse.facts).read
    for n in range(10):
        day = f"2024-01-{n + 1:02d}"
        frame = events(spark, [(f"u{n % 3}", f"k{n}-{i}", f"2024-01-{n + 1 - n % 2:02d} {i:02d}:00:00", ("purchase", "page_view")[i % 2])
                               for i in range(4)])
        daily.load_events(warehouse, frame, day)
        seen = []
        with monkeypatch.context() as m:
            m.setattr(type(warehouse.facts), "read", lambda self: seen.append(1) or read(self))
            assert daily.update_marts(warehouse, day, "2024-01-31") == [day] and len(seen) == 1
        assert daily.update_marts(warehouse, day, "2024-01-31", grown=False) == []
    assert daily.update_marts(warehouse, "2024-01-04", "2024-01-31") == ["2024-01-04"]
    names = ("daily_active_users", "revenue_per_user", "churn_risk")
    step = {name: rows_of(warehouse.mart(name)) for name in names}
    warehouse.partials.fold([f"2024-01-{d:02d}" for d in range(1, 8)], marts.merge_partials)
    assert len(warehouse.partials.read().inputFiles()) < 100
    daily.update_marts(warehouse, "2024-01-10", "2024-01-31")
    assert step == {name: rows_of(warehouse.mart(name)) for name in names}
    with pytest.raises(ValueError, match="folded"):
        daily.update_marts(warehouse, "2024-01-02", "2024-01-31")
    daily.build_marts(warehouse, "2024-01-31")
    assert step == {name: rows_of(warehouse.mart(name)) for name in names}
    assert all(step.values())


def test_a_load_reads_only_its_own_partition(spark, tmp_path):
    warehouse = warehouse_of(spark, str(tmp_path / "w"))
    for n in (1, 2):
        daily.load_events(warehouse, events(spark, [("u1", f"k{n}", "01:00")]), f"2024-01-0{n}")
    one = warehouse.facts.read().where("load_date = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(load_date" in plan_of(marts.partials(one)) and len(one.inputFiles()) == 1


def test_partials_of_odd_rows(spark, tmp_path):
    frame = events(spark, [("u1", "a", "01:00", "purchase"), ("u1", "b", "02:00", "purchase"), ("?", "c", "03:00")])
    base = frame.withColumns({
        "user_key": F.when(F.col("user_id") == "u1", 1).cast("bigint"), "purchase_quantity": F.lit(1),
        "purchase_amount": F.when(F.col("event_type") == "purchase", F.lit("2.50")).otherwise("0").cast("decimal(12,2)"),
        "event_timestamp": F.when(F.col("idempotency_key") != "b", F.col("event_timestamp"))})
    dim = users(spark, OPEN)
    table = PartTable(spark, str(tmp_path / "p"), MART_PARTIALS)
    assert table.read().count() == 0 and table.folded() == set()
    for key in "abc":
        table.replace(key, marts.partials(base.where(F.col("idempotency_key") == key)))
    assert rows_of(marts.daily_active_users_of(table.read())) == rows_of(marts.daily_active_users(base))
    assert rows_of(marts.revenue_per_user_of(table.read(), dim)) == rows_of(marts.revenue_per_user(base, dim))
    assert rows_of(marts.churn_risk_of(table.read(), dim, "2024-02-01")) == rows_of(marts.churn_risk(base, dim, "2024-02-01"))


def test_packed_bronze(spark, tmp_path):
    lake, landing = jobs.Lake(str(tmp_path / "lake")), str(tmp_path / "landing")
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def deliver(n, count=6):
        texts = [event_text(100 * n + i, f"2024-01-0{1 + i % 2}T01:00:00Z") for i in range(count)] + ["{"]
        messages(spark, texts).repartition(3).write.mode("append").parquet(landing)
        jobs.finish([jobs.ingest_bronze(streams.file_stream(spark, landing, MESSAGE), lake, "available_now")])

    def follow():
        query = streams.bronze_stream(spark, lake.table("bronze")).select("raw_value").writeStream.format("parquet").option(
            "path", out).option("checkpointLocation", cp).trigger(availableNow=True).start()
        jobs.finish([query])
        return spark.read.parquet(out).count()

    for n in range(4):
        deliver(n)
    table = jobs.compacted_bronze(spark, lake)
    whole = lambda: rows_of(spark.read.parquet(lake.table("bronze")).select("raw_value", "date", "event_type"))
    packed = lambda: rows_of(table.read().select("raw_value", "date", "event_type"))
    before = table.open_files().count()
    assert whole() == packed() and follow() == 28
    assert table.compact() == before and table.open_files().count() == 0
    files = len(table.read().inputFiles())
    # Two dates and the unreadable rows' folder: a file each.
    assert files == 3 < before and packed() == whole() and table.compact() == 0
    # More batches: the stream goes on, and so does the next compaction.
    for n in (4, 5):
        deliver(n)
    assert follow() == 42 and packed() == whole() and len(packed()) == 42
    assert table.compact() > 0 and packed() == whole()


def test_packed_files_have_the_target_size(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("raw_value"), F.lit("2024-01-01").alias("date"),
                                      F.when(F.col("id") < 100, "b").otherwise("a").alias("event_type"))
    rows.repartition(40).write.partitionBy("date", "event_type").parquet(path)
    from eventlode.streaming.compact import CompactedTable
    target = 1 << 20
    table = CompactedTable(spark, path, str(tmp_path / "p"), rows.schema, ("date", "event_type"), target)
    files = table.open_files().count()
    size = sum(r.length for r in table.open_files().where("event_type = 'a'").collect())
    assert table.compact() == files
    assert len(table.read().inputFiles()) == math.ceil(size / target) + 1
    assert rows_of(table.read()) == rows_of(rows)


def test_a_crash_before_publishing_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(50).select(F.col("id").cast("string").alias("raw_value"), F.lit("d").alias("date"))
    rows.repartition(5).write.partitionBy("date").parquet(path)
    from eventlode.streaming.compact import CompactedTable
    table = CompactedTable(spark, path, str(tmp_path / "p"), rows.schema, ("date",))
    with monkeypatch.context() as m:
        m.setattr("eventlode.streaming.compact.inline_rows", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.compact()
    assert rows_of(table.read()) == rows_of(rows) and table.compact() == 5 and rows_of(table.read()) == rows_of(rows)


def test_listing_opens_no_file(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(5).withColumn("date", F.lit("2024-01-01")).coalesce(1).write.partitionBy("date").parquet(str(path))
    (path / "date=2024-01-01" / "part-broken.parquet").write_bytes(b"not parquet at all")
    files = quality.list_files(spark, str(path))
    plan = plan_of(quality.freshness(files))
    assert "binaryFile" in plan and "parquet" not in plan.split("Location")[0] and "content" not in plan
    row = quality.freshness(files).first()
    assert (row.date, row.status) == ("2024-01-01", "PASSED") and '"file_count":2' in row.details


VERSIONS = [(1, "u", "free", "2023-01-01", "2024-01-01 10:00:00", False, 1), (2, "u", "basic", "2024-01-01 10:00:00", "2024-01-01 10:30:00", False, 2),
            (3, "u", "pro", "2024-01-01 12:00:00", None, True, 3), (4, "v", "free", "2024-01-01 09:00:00", "2024-01-01 09:00:00", False, 1),
            (5, "v", "pro", "2024-01-01 09:00:00", None, True, 2)]
EVENTS = [("u", "a", "09:59:59"), ("u", "b", "10:00"), ("u", "c", "10:00:01"), ("u", "d", "11:00"), ("u", "e", "12:00"), ("u", "f", "2024-02-01 00:00"),
          ("u", "g", "2022-01-01 00:00"), ("v", "h", "08:00"), ("v", "i", "09:00"), ("v", "j", "23:00"), ("w", "k", "01:00"), ("u", "b", "10:00")]


@pytest.mark.parametrize("width", ["hour", "day", "year"])
def test_merged_join_gives_the_same_rows(spark, width):
    frame, dim = events(spark, EVENTS), users(spark, VERSIONS)
    both = [rows_of(df.select("event_id", "idempotency_key", "plan_type", "version_number"))
            for df in (joins.at_event_time(frame, dim), joins.as_of_merged(frame, dim, width))]
    assert both[0] == both[1] and len(both[0]) == 8
    lost = frame.withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    assert joins.as_of_merged(lost, dim).count() == 0 and joins.as_of_merged(frame, dim.where("false")).count() == 0


def test_a_busy_user_with_many_versions_makes_no_pairs(spark):
    start = F.lit("2024-01-01").cast("timestamp")
    dim = spark.range(10_000).select(F.lit("u").alias("user_id"), F.col("id").cast("string").alias("plan_type"), F.col("id").cast("int").alias("version_number"),
                                     (start + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("effective_start_date"),
                                     (start + F.make_dt_interval(mins=(F.col("id") + 1).cast("int"))).alias("effective_end_date"))
    frame = spark.range(60_000).select(F.lit("u").alias("user_id"), F.col("id").alias("n"),
                                       (start + F.make_dt_interval(secs=(F.col("id") * 10).cast("decimal(18,6)"))).alias("event_timestamp"))
    began = time.time()
    found = joins.as_of_merged(frame, dim)
    wrong = found.where(F.floor(F.col("n") / 6) != F.col("plan_type").cast("long")).count()
    assert found.count() == 60_000 and wrong == 0 and time.time() - began < 120
    plan = plan_of(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "effective_start_date" not in plan.split("Join")[0]
