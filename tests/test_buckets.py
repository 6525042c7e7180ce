"""Changes that leave what they don't touch: dimension buckets, stored keys, key ranges."""

import pytest
from pyspark.sql import functions as F

from eventlode.operators import facts, scd2, sessions
from eventlode.operators.keys import highest_key
from eventlode.operators.observe import materialize_observed
from eventlode.plans import daily
from eventlode.schemas import DIM_USER
from eventlode.sources.buckets import BucketedDimension
from eventlode.sources.keyfilter import KeyFilters, block_count
from eventlode.sources.ledger import KeyLedger
from helpers import events, users
from test_warehouse import OPEN, busy


def plain(dim):
    return sorted((r.user_key, r.user_id, r.plan_type, r.version_number, r.is_current) for r in dim.collect())


def test_a_load_rewrites_only_the_buckets_it_changes(spark, tmp_path):
    opening = users(spark, [(n, f"u{n}", "premium" if n % 2 else "free", "2023-01-01", None, True, 1) for n in range(1, 301)])
    dim = BucketedDimension(spark, str(tmp_path / "d"), DIM_USER, "user_id", buckets=64)
    ledger = KeyLedger(spark, str(tmp_path / "k"))
    dim.replace(opening)
    before = dim.current()
    assert plain(dim.read()) == plain(opening) and len(before) == 64
    # u1 is active but on another plan, u2 moves, z is new.
    load = sessions.tumbling_sessions(busy(spark, "u1", 8).union(busy(spark, "u2", 8)).union(busy(spark, "z", 2)))
    want = plain(scd2.apply_scd2(opening, load, "2024-01-02"))
    changed = scd2.merge_scd2(dim, ledger, load, "2024-01-02")
    place = {r.user_id: r.b for r in spark.createDataFrame([("u2",), ("z",)], "user_id string").select("user_id", dim.bucket().alias("b")).collect()}
    assert changed == sorted(set(place.values()))
    after = dim.current()
    assert {b for b in after if after[b] != before[b]} == set(changed)
    assert plain(dim.read()) == want
    files = {f for b in set(after) - set(changed) for f in dim.read([b]).inputFiles()}
    assert files and not any("/v00000002" in f for f in files)
    assert ledger.highest() == 302
    # The same load again finds u2 moved and z known, and writes nothing.
    assert scd2.merge_scd2(dim, ledger, load, "2024-01-02") == [] and dim.current() == after


def test_a_change_that_was_not_published_is_not_seen(spark, tmp_path, monkeypatch):
    dim = BucketedDimension(spark, str(tmp_path / "d"), DIM_USER, "user_id", buckets=4)
    assert not dim.exists() and dim.read().count() == 0
    dim.replace(users(spark, OPEN))
    held = dim.read()
    with monkeypatch.context() as m:
        m.setattr("eventlode.sources.buckets.inline_rows", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            dim.replace(users(spark, OPEN[:1]))
    assert plain(dim.read()) == plain(users(spark, OPEN))
    dim.replace(users(spark, OPEN[:1]))
    assert dim.read().count() == 1 and held.count() == 2
    b = next(iter(set(range(4)) - {r[0] for r in users(spark, OPEN).select(dim.bucket()).collect()}))
    with pytest.raises(ValueError, match="not replaced"):
        dim.replace(users(spark, OPEN), [b])


def test_lost_loads_leave_gaps_and_never_share_keys(spark, tmp_path):
    ledger = KeyLedger(spark, str(tmp_path / "k"))
    assert ledger.highest() is None
    ledger.begin(10)
    assert [ledger.reserve(5, "a"), ledger.reserve(3, "lost"), ledger.reserve(2, "b")] == [10, 15, 18]
    assert KeyLedger(spark, str(tmp_path / "k")).highest() == 20


def warehouse_of(spark, path):
    warehouse = daily.Warehouse(spark, path, fact_buckets=4, user_buckets=8)
    warehouse.seed()
    warehouse.store.append("dim_user", users(spark, OPEN))
    return warehouse


def facts_of(warehouse, frame):
    return facts.build_facts(frame, warehouse.dim_user, warehouse.store.read("dim_device"), warehouse.store.read("dim_time"))


def test_new_keys_read_no_stored_facts(spark, tmp_path, monkeypatch):
    warehouse = warehouse_of(spark, str(tmp_path / "w"))
    load = lambda names, day: facts.load_new_facts(
        warehouse.facts, facts_of(warehouse, events(spark, [("u1", n, "01:00") for n in names])), day)
    with monkeypatch.context() as m:
        first = load([f"a{n}" for n in range(50)], "2024-01-01")
        m.setattr(type(warehouse.facts), "read", lambda self: pytest.fail("stored facts were read"))
        second = load([f"b{n}" for n in range(50)] + ["b0"], "2024-01-02")
    assert (first.added, first.joined, second.added, second.joined) == (50, (), 50, ())
    third = load(["a7", "c1", "c2"], "2024-01-03")
    assert (third.added, third.joined) == (2, ("2024-01-01",))
    rows = warehouse.facts.read()
    assert rows.count() == rows.select("idempotency_key").distinct().count() == 102
    assert sorted(r.event_key for r in rows.collect()) == list(range(1, 103)) and highest_key(rows, "event_key") == 102


def test_a_load_lost_before_its_rows_and_one_without_a_filter(spark, tmp_path, monkeypatch):
    warehouse = warehouse_of(spark, str(tmp_path / "w"))
    rows = facts_of(warehouse, events(spark, [("u1", f"a{n}", "01:00") for n in range(5)]))
    with monkeypatch.context() as m:
        m.setattr(type(warehouse.facts), "append", lambda self, df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            facts.load_facts(warehouse.facts, rows, "2024-01-01")
    # Its filter names keys that never came: they are looked for, not found, and added.
    assert facts.load_facts(warehouse.facts, rows, "2024-01-01") == 5
    assert sorted(r.event_key for r in warehouse.facts.read().collect()) == [6, 7, 8, 9, 10]
    # A table from before there were filters.
    warehouse.facts.filters = KeyFilters(spark, str(tmp_path / "other"), "idempotency_key")
    again = facts.load_new_facts(warehouse.facts, rows, "2024-01-02")
    assert (again.added, again.joined) == (0, ("2024-01-01",))


def test_filter_has_no_misses_and_few_false_hits(spark, tmp_path):
    filters = KeyFilters(spark, str(tmp_path / "f"), "k")
    keys = spark.range(40_000).select(F.concat(F.lit("key-"), "id").alias("k"))
    assert filters.loads() == set() and filters.possible(keys).count() == 0
    filters.add(keys.where("substr(k, 5) < 30000"), 30_000, "one")
    filters.add(keys.where("substr(k, 5) >= 30000").limit(100), 100, "two")
    hits = filters.possible(keys)
    assert hits.where("load = 'one'").select("k").distinct().count() == 30_000
    assert hits.where("load = 'two'").count() == 100 and filters.loads() == {"one", "two"}
    assert block_count(0) == 1 and block_count(682) == 1 and block_count(683) == 2 and block_count(10**9) == 1 << 21


def test_counts_are_observed_during_the_write(spark):
    rows, seen = materialize_observed(spark.range(7), "seen", F.count("*").alias("rows"), F.max("id").alias("top"))
    assert seen == {"rows": 7, "top": 6} and rows.count() == 7
    assert materialize_observed(spark.range(0), "seen", F.count("*").alias("rows"))[1] == {"rows": 0}
