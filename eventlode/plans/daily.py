"""The daily batch: one date of sessions into the warehouse, then marts, tests and quality."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date as Date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlode.operators import coltests, dims, facts, marts, quality
from eventlode.operators.runlog import logged_run
from eventlode.operators.scd2 import UpgradeRule, apply_scd2, merge_scd2
from eventlode.operators.sessions import explode_sessions
from eventlode.schemas import BRONZE, CHURN_LOOKBACK_DAYS, DIM_USER, FACT_EVENTS, MART_PARTIALS, SILVER_SESSION
from eventlode.sources.buckets import BucketedDimension, PartTable
from eventlode.sources.ledger import KeyLedger
from eventlode.sources.tables import BucketedTable, JdbcStore, ParquetStore, read_partition


@dataclass
class Warehouse:
    """The star schema of one deployment.

    Dimensions, marts and logs live in ``store``, versioned Parquet unless given; facts are always
    the bucketed table. Without a database the user dimension moves into buckets with its first load.
    """

    spark: SparkSession
    root: str
    fact_buckets: int = 1024
    store: ParquetStore | JdbcStore | None = None
    user_buckets: int = 256

    def __post_init__(self) -> None:
        self.store = self.store or ParquetStore(self.spark, f"{self.root}/tables")
        self.users = BucketedDimension(self.spark, f"{self.root}/dim_user", DIM_USER, "user_id", self.user_buckets)
        self.partials = PartTable(self.spark, f"{self.root}/mart_partials", MART_PARTIALS)
        self.user_keys = KeyLedger(self.spark, f"{self.root}/dim_user_keys")
        self.facts = BucketedTable(self.spark, f"{self.root}/fact_events", FACT_EVENTS, "idempotency_key",
                                   "load_date", self.fact_buckets)

    def seed(self) -> None:
        """Fill the fixed dimensions; rows already there are left alone."""
        for name, rows, key in (
            ("dim_time", dims.time_dimension(self.spark), ["full_timestamp"]),
            ("dim_device", dims.device_dimension(self.spark), ["device_type", "os_family", "browser_family"]),
            ("dim_event_type", dims.event_type_dimension(self.spark), ["event_type"]),
        ):
            if self.store.exists(name):
                rows = dims.absent_from(self.store.read(name), rows, key)
            self.store.append(name, rows.coalesce(1))

    @property
    def dim_user(self) -> DataFrame:
        return self.users.read() if self.users.exists() else self.store.read("dim_user", DIM_USER)

    def mart(self, name: str) -> DataFrame:
        return self.store.read(f"mart_{name}")


def update_users(warehouse: Warehouse, sessions: DataFrame, as_of: str, rule: UpgradeRule = UpgradeRule()) -> None:
    """Apply one load to the user dimension; without a database only the buckets it changes are rewritten."""
    if isinstance(warehouse.store, JdbcStore):
        warehouse.store.overwrite("dim_user", apply_scd2(warehouse.dim_user, sessions, as_of, rule))
        return
    if not warehouse.users.exists():
        warehouse.users.replace(warehouse.dim_user)
    merge_scd2(warehouse.users, warehouse.user_keys, sessions, as_of, rule)


def load_events(warehouse: Warehouse, events: DataFrame, load_date: str, constant_amount: bool = False) -> int:
    """Look up keys for events (or exploded sessions) and append what is new."""
    rows = facts.build_facts(events, warehouse.dim_user, warehouse.store.read("dim_device"),
                             warehouse.store.read("dim_time"), constant_amount)
    return facts.load_facts(warehouse.facts, rows, load_date)


def refresh_partials(warehouse: Warehouse, load_date: str, grown: bool = True) -> list[str]:
    """Bring the partial aggregates up to date and return the loads whose facts were read.

    Those are the given load, if it has ``grown``, and any that has none yet. A load that was folded into others must not
    grow any more; if it has, its facts can't be told apart from theirs and the error says so.
    """
    table = warehouse.partials
    folded, known, stored = table.folded(), set(table.current()), warehouse.facts.loads()
    if grown and load_date in folded:
        raise ValueError(f"load {load_date} has new facts but its partial aggregates were folded")
    wanted = sorted((stored - known) | ({load_date} & stored if grown else set()))
    for load in wanted:
        rows = warehouse.facts.read().where(F.col(warehouse.facts.partition) == load)
        table.replace(load, marts.partials(rows))
    return wanted


def update_marts(warehouse: Warehouse, load_date: str, as_of: str, grown: bool = True,
                 churn_lookback_days: int = CHURN_LOOKBACK_DAYS) -> list[str]:
    """The marts after a load, from the partial aggregates of all loads; only the new load's facts are read."""
    loads = refresh_partials(warehouse, load_date, grown)
    parts, users = warehouse.partials.read(), warehouse.dim_user
    warehouse.store.overwrite("mart_daily_active_users", marts.daily_active_users_of(parts))
    warehouse.store.overwrite("mart_revenue_per_user", marts.revenue_per_user_of(parts, users))
    warehouse.store.overwrite("mart_churn_risk", marts.churn_risk_of(parts, users, as_of, churn_lookback_days))
    return loads


def build_marts(warehouse: Warehouse, as_of: str, churn_lookback_days: int = CHURN_LOOKBACK_DAYS) -> None:
    """Rebuild the three marts in full from the fact table."""
    fact_rows, users = warehouse.facts.read(), warehouse.dim_user
    warehouse.store.overwrite("mart_daily_active_users", marts.daily_active_users(fact_rows))
    warehouse.store.overwrite("mart_revenue_per_user", marts.revenue_per_user(fact_rows, users))
    warehouse.store.overwrite(
        "mart_churn_risk", marts.churn_risk(fact_rows, users, as_of, lookback_days=churn_lookback_days)
    )


def test_tables(warehouse: Warehouse) -> DataFrame:
    store = warehouse.store
    return coltests.run_column_tests(warehouse.spark, {
        "fact_events": warehouse.facts.read(), "dim_user": warehouse.dim_user,
        "dim_time": store.read("dim_time"), "dim_device": store.read("dim_device"),
        "daily_active_users": warehouse.mart("daily_active_users"),
        "revenue_per_user": warehouse.mart("revenue_per_user"), "churn_risk": warehouse.mart("churn_risk"),
    })


test_tables.__test__ = False


def run_daily(warehouse: Warehouse, silver_path: str, date: str | None = None,
              rule: UpgradeRule = UpgradeRule(), bronze_path: str | None = None) -> int:
    """Load one date, yesterday unless given, and return the number of facts added.

    A date without sessions loads nothing. Running a date again changes neither the dimension nor
    the facts. With ``bronze_path`` the facts are the date's valid bronze events, with their own
    times and amounts; without it they come from the sessions' lists, at the session's start and a
    constant purchase amount.
    """
    date = date or (Date.today() - timedelta(days=1)).isoformat()
    spark = warehouse.spark
    sessions = read_partition(spark, silver_path, date, SILVER_SESSION)
    if sessions.isEmpty():
        return 0

    def load() -> int:
        update_users(warehouse, sessions, date, rule)
        if bronze_path is None:
            return load_events(warehouse, explode_sessions(sessions), date, constant_amount=True)
        bronze = read_partition(spark, bronze_path, date, BRONZE)
        return load_events(warehouse, facts.events_of_bronze(bronze), date)

    added = logged_run(warehouse.store, "daily_load", "batch", load)
    update_marts(warehouse, date, date, grown=added > 0)
    warehouse.store.append("column_tests", test_tables(warehouse))
    checks = quality.date_checks(quality.read_tolerant(spark, silver_path), date, path=silver_path)
    warehouse.store.append("data_quality_checks", quality.log_rows(checks, "silver"))
    return added
