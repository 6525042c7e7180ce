"""Type-2 history of the user dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from eventlode.operators.keys import assign_keys, highest_key
from eventlode.operators.observe import materialize_observed
from eventlode.operators.sessions import users_in
from eventlode.schemas import DIM_USER, NEW_USER, UPGRADE_FROM_PLAN, UPGRADE_MIN_SESSIONS, UPGRADE_TO
from eventlode.session import materialize
from eventlode.sources.buckets import BucketedDimension
from eventlode.sources.ledger import KeyLedger


@dataclass(frozen=True)
class UpgradeRule:
    """Users on ``from_plan`` with more than ``more_than`` sessions in the load move to ``to_plan``."""

    from_plan: str = UPGRADE_FROM_PLAN
    more_than: int = UPGRADE_MIN_SESSIONS
    to_plan: str = UPGRADE_TO["plan_type"]
    to_tier: str = UPGRADE_TO["user_tier"]


def new_users(dim: DataFrame, users: DataFrame) -> DataFrame:
    """Users of the load without a current row."""
    return users.join(dim.where("is_current").select("user_id"), "user_id", "left_anti")


def first_versions(added: DataFrame, as_of: str) -> DataFrame:
    """Version 1 of every new user, without a key yet."""
    instant = F.lit(as_of).cast("timestamp")
    nothing = F.lit(None).cast("string")
    return added.select(
        "user_id",
        nothing.alias("email"),
        nothing.alias("username"),
        F.lit(NEW_USER["plan_type"]).alias("plan_type"),
        F.lit(NEW_USER["subscription_status"]).alias("subscription_status"),
        F.lit(NEW_USER["user_tier"]).alias("user_tier"),
        "country", "region", "city",
        nothing.alias("timezone"),
        F.to_date(instant).alias("signup_date"),
        F.lit(NEW_USER["signup_source"]).alias("signup_source"),
        instant.alias("effective_start_date"),
        F.lit(None).cast("timestamp").alias("effective_end_date"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version_number"),
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    )


def mark_upgrades(dim: DataFrame, users: DataFrame, rule: UpgradeRule) -> DataFrame:
    """The dimension with ``_upgrade``: true on the current row of every user the rule moves."""
    active = users.where(F.col("sessions") > rule.more_than).select(F.col("user_id").alias("_active"))
    due = F.col("is_current") & (F.col("plan_type") == rule.from_plan) & F.col("_active").isNotNull()
    return (
        dim.join(active, F.col("user_id") == F.col("_active"), "left")
        .withColumn("_upgrade", F.coalesce(due, F.lit(False))).drop("_active")
    )


def expire(marked: DataFrame, as_of: str) -> DataFrame:
    """Close the marked rows at ``as_of``; every other row stays as it is."""
    due = F.col("_upgrade")
    return (
        marked.withColumn("is_current", F.when(due, False).otherwise(F.col("is_current")))
        .withColumn(
            "effective_end_date",
            F.when(due, F.lit(as_of).cast("timestamp")).otherwise(F.col("effective_end_date")),
        )
        .withColumn("updated_at", F.when(due, F.current_timestamp()).otherwise(F.col("updated_at")))
        .drop("_upgrade")
    )


def next_versions(marked: DataFrame, as_of: str, rule: UpgradeRule) -> DataFrame:
    """The version that follows each marked row, without a key yet."""
    changes = {
        "plan_type": F.lit(rule.to_plan),
        "user_tier": F.lit(rule.to_tier),
        "effective_start_date": F.lit(as_of).cast("timestamp"),
        "effective_end_date": F.lit(None).cast("timestamp"),
        "is_current": F.lit(True),
        "version_number": F.col("version_number") + 1,
        "created_at": F.current_timestamp(),
        "updated_at": F.current_timestamp(),
    }
    return marked.where("_upgrade").withColumns(changes).drop("_upgrade", "user_key")


def apply_scd2(dim: DataFrame, sessions: DataFrame, as_of: str, rule: UpgradeRule = UpgradeRule()) -> DataFrame:
    """The dimension after one load.

    Everything is decided from the opening rows: who is new, who moves, what closes. The result is
    one plan to write in one step, so no reader sees a user between two versions, and a second run
    over its own output changes nothing.
    """
    users = materialize(users_in(sessions), "load-users")
    marked = mark_upgrades(dim, users, rule)
    added = materialize(
        first_versions(new_users(dim, users), as_of).unionByName(next_versions(marked, as_of, rule)), "new-versions"
    )
    keyed = assign_keys(added, "user_id", "user_key", highest_key(dim, "user_key"))
    return expire(marked, as_of).unionByName(keyed).select(*DIM_USER.names)


def merge_scd2(dim: BucketedDimension, ledger: KeyLedger, sessions: DataFrame, as_of: str,
               rule: UpgradeRule = UpgradeRule()) -> list[int]:
    """Apply one load to a bucketed dimension and return the buckets that were rewritten.

    Only buckets that hold a user of the load are read, and only those in which a user is new or moves are written.
    The result is that of ``apply_scd2``: a user's versions share a bucket, so each bucket is decided by itself. Keys come
    from the ledger, not from a scan. A load that changes nothing writes nothing.
    """
    users = materialize(users_in(sessions), "load-users")
    touched = [r[0] for r in users.select(dim.bucket()).distinct().collect()]
    opening = dim.read(touched)
    marked = mark_upgrades(opening, users, rule)
    added, seen = materialize_observed(
        first_versions(new_users(opening, users), as_of).unionByName(next_versions(marked, as_of, rule)), "new-versions",
        F.count("*").alias("rows"))
    if not seen["rows"]:
        return []
    changed = [r[0] for r in added.select(dim.bucket()).distinct().collect()]
    if ledger.highest() is None:
        ledger.begin(highest_key(dim.read(), "user_key"))
    keyed = assign_keys(added, "user_id", "user_key", ledger.reserve(seen["rows"], as_of))
    kept = expire(marked, as_of).where(dim.bucket().isin(changed))
    dim.replace(kept.unionByName(keyed.select(*kept.columns)), changed)
    return sorted(changed)


def history_from_changes(changes: DataFrame) -> DataFrame:
    """Versions from a change log (user_id, plan_type, changed_at): each lasts until the next begins."""
    by_user = Window.partitionBy("user_id").orderBy("changed_at")
    end = F.lead("changed_at").over(by_user)
    return changes.select(
        "user_id",
        "plan_type",
        F.col("changed_at").alias("effective_start_date"),
        end.alias("effective_end_date"),
        end.isNull().alias("is_current"),
        F.row_number().over(by_user).alias("version_number"),
    )
