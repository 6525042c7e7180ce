import json

from pyspark.sql import functions as F

from eventlode.operators import quality, sessions
from eventlode.sources.tables import write_partitioned
from helpers import events


def counts(spark, rows):
    return spark.createDataFrame(rows, "date string, rows bigint")


def test_volume_statuses(spark):
    days = [(f"2024-01-{d:02d}", 100) for d in range(1, 8)] + [("2024-01-08", 121), ("2024-01-20", 5)]
    wanted = ["2024-01-01", "2024-01-07", "2024-01-08", "2024-01-15", "2024-01-20"]
    found = {r.date: r.status for r in quality.volume(counts(spark, days), wanted).collect()}
    assert found == {"2024-01-01": "WARNING", "2024-01-07": "PASSED", "2024-01-08": "FAILED",
                     "2024-01-15": "SKIPPED", "2024-01-20": "WARNING"}


def test_volume_ignores_or_counts_empty_days(spark):
    days = counts(spark, [("2024-01-01", 70), ("2024-01-08", 70)])
    assert quality.volume(days, ["2024-01-08"]).first().status == "PASSED"
    assert quality.volume(days, ["2024-01-08"], zero_fill=True).first().status == "FAILED"


def test_volume_threshold_is_inclusive(spark):
    days = counts(spark, [("2024-01-01", 100), ("2024-01-02", 120)])
    assert quality.volume(days, ["2024-01-02"]).first().status == "PASSED"


def test_null_check(spark):
    table = spark.createDataFrame([("2024-01-01", "u", "x"), ("2024-01-02", None, "x")], "date string, user_id string, v string")
    status = lambda **kw: {r.date: r.status for r in quality.nulls(table, **kw).collect()}
    assert status(columns=["user_id"]) == {"2024-01-01": "PASSED", "2024-01-02": "FAILED"}
    assert set(status(columns=["user_id", "absent"]).values()) == {"FAILED"}
    assert status(columns=["user_id"], dates=["2024-01-03"]) == {"2024-01-03": "SKIPPED"}


def test_report_of_one_date(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [(u, f"{u}-{d}", f"2024-01-{d:02d} 01:00:00") for d in range(1, 9) for u in range(10)]
    write_partitioned(sessions.tumbling_sessions(events(spark, rows)), path, ("date",))
    table = quality.read_tolerant(spark, path)
    good = quality.run_quality(table, "2024-01-08")
    row = good.first()
    assert (row.overall_status, row.total_checks, row.passed_checks, row.failed_checks) == ("PASSED", 3, 3, 0)
    stale = quality.run_quality(table, "2024-01-08", now="2099-01-01 00:00:00").first()
    assert stale.overall_status == "FAILED" and stale.failed_checks == 1
    # No data: freshness fails, the other two are skipped.
    none = {c.check_name: c.status for c in quality.run_quality(table, "2024-03-01").first().checks}
    assert none == {"Freshness Check": "FAILED", "Volume Check": "SKIPPED", "Null Check": "SKIPPED"}
    quality.write_report(good, str(tmp_path / "report"))
    text = spark.read.text(str(tmp_path / "report")).first().value
    assert json.loads(text)["overall_status"] == "PASSED" and len(json.loads(text)["checks"]) == 3


def test_unreadable_files_are_skipped(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(5).withColumn("date", F.lit("2024-01-01")).coalesce(1).write.parquet(str(path))
    (path / "part-broken.parquet").write_bytes(b"not parquet at all")
    assert quality.read_tolerant(spark, str(path)).count() == 5
