from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventlode.operators import coltests, dims, facts, joins, kpis, marts, scd2, sessions
from eventlode.plans import daily
from eventlode.schemas import DIM_USER, SILVER_SESSION
from eventlode.sources.tables import ParquetStore, read_partition, write_partitioned
from helpers import events, plan_of, users

OPEN = [(1, "u1", "free", "2023-01-01", None, True, 1), (2, "u2", "premium", "2023-01-01", None, True, 1)]


def busy(spark, user, windows):
    return events(spark, [(user, f"{user}-{i}", f"{i // 2:02d}:{i % 2 * 30:02d}") for i in range(windows)])


def test_scd2_upgrades_adds_and_is_repeatable(spark):
    dim = users(spark, OPEN)
    load = sessions.tumbling_sessions(busy(spark, "u1", 6).union(busy(spark, "u2", 6)).union(busy(spark, "u3", 9)))
    once = scd2.apply_scd2(dim, load, "2024-01-02")
    rows = {(r.user_id, r.version_number): r for r in once.collect()}
    assert set(rows) == {("u1", 1), ("u1", 2), ("u2", 1), ("u3", 1)}
    old, new = rows["u1", 1], rows["u1", 2]
    assert not old.is_current and old.effective_end_date == new.effective_start_date == datetime(2024, 1, 2)
    assert (new.plan_type, new.user_tier, new.is_current) == ("basic", "silver", True)
    # A user new in this load is not upgraded by it, however active.
    assert (rows["u3", 1].plan_type, rows["u3", 1].user_tier) == ("free", "bronze")
    keys = [r.user_key for r in rows.values()]
    assert len(set(keys)) == 4 and max(keys) == 4
    again = scd2.apply_scd2(once.drop("created_at", "updated_at").join(
        once.select("user_key", "created_at", "updated_at"), "user_key").select(*DIM_USER.names), load, "2024-01-02")
    plain = lambda d: sorted((r.user_key, r.user_id, r.plan_type, r.version_number) for r in d.collect())
    # u3 is an existing free user with nine sessions by now, so a second load moves it; u1 and u2 stay.
    assert {r.user_id for r in again.where("version_number = 2 and is_current").collect()} == {"u1", "u3"}
    assert set(plain(dim)) <= set(plain(again))


def test_threshold_is_strict(spark):
    dim = users(spark, OPEN)
    load = sessions.tumbling_sessions(busy(spark, "u1", 5))
    assert scd2.apply_scd2(dim, load, "2024-01-02").count() == 2


def test_new_user_on_two_devices_is_added_once(spark):
    frame = events(spark, [("n", "a", "00:01"), ("n", "b", "05:00")]).withColumn(
        "device_type", F.when(F.col("idempotency_key") == "a", "tablet").otherwise("mobile")
    )
    after = scd2.apply_scd2(users(spark, OPEN), sessions.tumbling_sessions(frame), "2024-01-02")
    assert after.where("user_id = 'n'").count() == 1


def test_history_is_contiguous(spark):
    changes = spark.createDataFrame(
        [("a", "free", "2024-01-01"), ("a", "basic", "2024-01-05"), ("a", "free", "2024-02-01"), ("b", "free", "2024-01-01")],
        "user_id string, plan_type string, t string",
    ).withColumn("changed_at", F.col("t").cast("timestamp"))
    rows = sorted(scd2.history_from_changes(changes).collect(), key=lambda r: (r.user_id, r.version_number))
    a = [r for r in rows if r.user_id == "a"]
    assert [r.version_number for r in a] == [1, 2, 3]
    assert all(x.effective_end_date == y.effective_start_date for x, y in zip(a, a[1:]))
    assert [r.is_current for r in rows] == [False, False, True, True]


def test_event_on_the_instant_of_a_change_has_one_version(spark):
    versions = users(spark, [(1, "u", "free", "2023-01-01", "2024-01-01 10:00:00", False, 1),
                             (2, "u", "basic", "2024-01-01 10:00:00", None, True, 2)])
    at = joins.at_event_time(events(spark, [("u", "a", "09:59:59"), ("u", "b", "10:00"), ("u", "c", "10:00:01")]), versions)
    assert [(r.idempotency_key, r.plan_type) for r in at.orderBy("idempotency_key").collect()] == [
        ("a", "free"), ("b", "basic"), ("c", "basic")]


def built(spark, frame, **kw):
    return facts.build_facts(frame, users(spark, OPEN), dims.device_dimension(spark), dims.time_dimension(spark), **kw)


def test_lookups_never_multiply_rows(spark):
    frame = events(spark, [("u1", "a", "00:01", "purchase"), ("nobody", "b", "00:02")]).withColumn(
        "device_type", F.when(F.col("idempotency_key") == "a", "mobile").otherwise("other")
    )
    rows = {r.idempotency_key: r for r in built(spark, frame).collect()}
    assert len(rows) == 2
    assert (rows["a"].device_key, rows["b"].device_key) == (1, 16)
    assert (rows["a"].user_key, rows["b"].user_key) == (1, None)
    assert rows["a"].time_key == rows["b"].time_key == 35065
    assert float(rows["a"].purchase_amount) == 10.5 and rows["b"].purchase_amount == 0
    fixed = built(spark, frame, constant_amount=True).where("idempotency_key = 'a'").first()
    assert float(fixed.purchase_amount) == 99.99 and fixed.purchase_quantity == 1


def test_calendar_covers_the_decade(spark):
    calendar = dims.time_dimension(spark)
    assert calendar.count() == 96432
    edge = calendar.agg(F.min("full_timestamp"), F.max("full_timestamp"), F.min("time_key"), F.max("time_key")).first()
    assert tuple(edge) == (datetime(2020, 1, 1), datetime(2030, 12, 31, 23), 1, 96432)
    row = calendar.where("date_actual = '2024-09-01' and hour = 5").first()
    assert (row.month_name, row.day_name, row.day_of_week, row.is_weekend, row.week_of_year) == (
        "September", "Sunday", 7, True, 35)


def test_rerun_adds_nothing_and_history_is_not_shuffled(spark, tmp_path):
    warehouse = daily.Warehouse(spark, str(tmp_path / "w"), fact_buckets=6)
    warehouse.seed()
    warehouse.store.append("dim_user", users(spark, OPEN))
    frame = events(spark, [("u1", f"k{i}", f"{i % 24:02d}:00", "purchase") for i in range(40)] + [("u1", "k0", "23:59")])
    assert daily.load_events(warehouse, frame, "2024-01-01") == 40
    assert daily.load_events(warehouse, frame, "2024-01-01") == 0
    more = frame.union(events(spark, [("u2", "new", "01:00")]).withColumn("event_id", F.lit("x")))
    # A second session over the same files has to find the partitions again.
    spark.sql(f"DROP TABLE {warehouse.facts.name}")
    again = daily.Warehouse(spark, str(tmp_path / "w"), fact_buckets=6)
    assert again.facts.read().count() == 40
    assert daily.load_events(again, more, "2024-01-02") == 1
    stored = again.facts.read()
    assert sorted(r.event_key for r in stored.collect()) == list(range(1, 42))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(facts.absent_facts(frame, stored, 6))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    side = plan[plan.rindex("FileScan") - 400:]
    assert "Bucketed: true" in side and "Exchange" not in side


def test_marts_treat_missing_and_expired_users_as_declared(spark):
    dim = users(spark, [(1, "u1", "free", "2023-01-01", "2024-01-01", False, 1), (2, "u1", "basic", "2024-01-01", None, True, 2)])
    rows = events(spark, [("u1", "a", "01:00", "purchase"), ("u1", "b", "02:00", "purchase"), ("?", "c", "03:00")])
    fact_rows = rows.withColumns(facts.measures(F.col("total_amount"), F.col("quantity"))).withColumn(
        "user_key", F.when(F.col("idempotency_key") == "a", 1).when(F.col("idempotency_key") == "b", 2).cast("bigint"))
    day = marts.daily_active_users(fact_rows).first()
    assert (day.daily_active_users, day.total_events, float(day.avg_events_per_user)) == (2, 3, 1.5)
    per_key = {r.user_key: r for r in marts.revenue_per_user(fact_rows, dim).collect()}
    assert set(per_key) == {1, 2} and per_key[1].user_id is None and per_key[2].plan_type == "basic"
    merged = marts.revenue_per_user(fact_rows, dim, by_user=True).collect()
    assert [(r.user_key, float(r.total_revenue)) for r in merged] == [(2, 21.0)]
    risk = {r.user_key: r.churn_risk_level for r in marts.churn_risk(fact_rows, dim, "2024-01-31", by_user=True).collect()}
    assert risk == {2: "high", None: "high"}


@pytest.mark.parametrize("as_of, level", [
    ("2024-01-07", "none"), ("2024-01-08", "low"), ("2024-01-14", "low"), ("2024-01-15", "medium"),
    ("2024-01-30", "medium"), ("2024-01-31", "high")])
def test_churn_levels_at_their_edges(spark, as_of, level):
    fact_rows = events(spark, [("u1", "a", "23:00")]).withColumn("user_key", F.lit(1).cast("bigint"))
    assert marts.activity_per_user(fact_rows, users(spark, OPEN), as_of).first().churn_risk_level == level


def test_summary_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "total_revenue decimal(12,2), churn_risk_level string")
    assert tuple(kpis.summary(empty.select("total_revenue"), empty)
                 .select(F.col("total_revenue").cast("int"), "high_risk_users").first()) == (0, 0)


def test_store_swaps_and_reads_what_was_there(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "s"))
    with pytest.raises(KeyError):
        store.read("t")
    assert store.read("t", DIM_USER).count() == 0
    store.overwrite("t", spark.range(3))
    before = store.read("t")
    # The new rows may be computed from the old table.
    store.overwrite("t", before.where("id > 0").union(spark.range(10, 12)))
    assert sorted(r.id for r in store.read("t").collect()) == [1, 2, 10, 11]
    assert before.count() == 3
    store.append("t", spark.range(1))
    assert store.read("t").count() == 5


def test_partition_read_is_pruned_and_only_absence_is_empty(spark, tmp_path):
    path = str(tmp_path / "silver")
    assert read_partition(spark, path, "2024-01-01", SILVER_SESSION).count() == 0
    frame = events(spark, [(1, "a", "01:00"), (1, "b", "2024-01-02 01:00:00")])
    write_partitioned(sessions.tumbling_sessions(frame), path, ("date",))
    day = read_partition(spark, path, "2024-01-02", SILVER_SESSION)
    assert day.count() == 1 and day.first().date == "2024-01-02" and len(day.inputFiles()) <= 2
    assert "PartitionFilters: [isnotnull(date" in plan_of(day)
    # Any other failure to read is raised, not taken for a day without data.
    with pytest.raises(Exception, match="nofs"):
        read_partition(spark, "nofs://somewhere/silver", "2024-01-01", SILVER_SESSION).count()


def test_column_tests_find_what_is_wrong(spark):
    table = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z")], "k int, v string")
    parent = spark.createDataFrame([(2,)], "k int")
    tests = [
        coltests.ColumnTest("t", "k", "unique"), coltests.ColumnTest("t", "k", "not_null"),
        coltests.ColumnTest("t", "v", "accepted_values", ("a", "b")),
        coltests.ColumnTest("t", "k", "relationships", target=("p", "k")),
    ]
    rows = {r.test: (r.failures, r.status) for r in coltests.run_column_tests(spark, {"t": table, "p": parent}, tests).collect()}
    assert rows == {"unique": (1, "fail"), "not_null": (1, "fail"), "accepted_values": (1, "fail"), "relationships": (2, "fail")}
    assert len(coltests.COLUMN_TESTS) == 30


def test_daily_run_and_rerun(spark, tmp_path):
    warehouse = daily.Warehouse(spark, str(tmp_path / "w"), fact_buckets=4)
    warehouse.seed()
    warehouse.store.append("dim_user", users(spark, OPEN))
    silver = str(tmp_path / "silver")
    frame = busy(spark, "u1", 7).union(events(spark, [("u9", "p", "03:00", "purchase")]).withColumn("event_id", F.lit("p1")))
    write_partitioned(sessions.tumbling_sessions(frame), silver, ("date",))
    assert daily.run_daily(warehouse, silver, "2024-01-05") == 0
    assert daily.run_daily(warehouse, silver) == 0
    assert daily.run_daily(warehouse, silver, "2024-01-01") == 8
    dim = warehouse.dim_user
    assert daily.run_daily(warehouse, silver, "2024-01-01") == 0
    assert sorted(r.user_key for r in warehouse.dim_user.collect()) == sorted(r.user_key for r in dim.collect())
    assert dim.where("is_current").count() == dim.select("user_id").distinct().count() == 3
    assert float(warehouse.mart("revenue_per_user").first().total_revenue) == 99.99
    assert {r.status for r in warehouse.store.read("job_runs").collect()} == {"success"}
    assert warehouse.store.read("data_quality_checks").count() >= 6
    assert warehouse.store.read("column_tests").where("status = 'fail'").count() == 0


def test_failed_run_is_logged_and_raised(spark, tmp_path):
    from eventlode.operators.runlog import logged_run

    store = ParquetStore(spark, str(tmp_path / "s"))
    with pytest.raises(ZeroDivisionError):
        logged_run(store, "broken", "batch", lambda: 1 // 0)
    row = store.read("job_runs").first()
    assert row.status == "failed" and "division" in row.error_message


def test_purchase_status_and_wrong_totals(spark):
    rows = spark.createDataFrame(
        [("1", "5.00", 2, "0.00", "10.00"), ("2", "5.00", 2, "1.00", "10.00"), ("3", "5.00", 2, "0.00", None)],
        "event_id string, p string, quantity int, d string, t string",
    ).select("event_id", "quantity", F.col("p").cast("decimal(12,2)").alias("unit_price"),
             F.col("d").cast("decimal(12,2)").alias("discount_amount"), F.col("t").cast("decimal(12,2)").alias("total_amount"))
    assert sorted(r.event_id for r in facts.wrong_totals(rows).collect()) == ["2", "3"]
