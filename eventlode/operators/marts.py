"""Daily active users, revenue per user and churn risk."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventlode.schemas import CHURN_HIGH_DAYS, CHURN_LOOKBACK_DAYS, CHURN_MEDIUM_DAYS


def daily_active_users(facts: DataFrame) -> DataFrame:
    """Per date: distinct users, events, and events per user.

    Counting per (date, user) first lets every stage combine before its shuffle, so neither a busy
    day nor a busy user lands in one task. Events without a user count as events only.
    """
    per_user = (
        facts.where(F.col("event_timestamp").isNotNull())
        .groupBy(F.to_date("event_timestamp").alias("activity_date"), "user_key")
        .agg(F.count("*").alias("events"))
    )
    users, events = F.count("user_key"), F.sum("events")
    return per_user.groupBy("activity_date").agg(
        users.alias("daily_active_users"),
        events.alias("total_events"),
        F.round(events.cast("decimal(18,0)") / F.nullif(users, F.lit(0)), 2).alias("avg_events_per_user"),
    )


def _with_user(per_key: DataFrame, dim_user: DataFrame, attributes: list[str]) -> DataFrame:
    """Attributes of the key's row if that is the current one, else NULLs.

    Joining after the aggregation gives the same rows as joining before it, since a key names one
    dimension row, and the join then sees one row per key.
    """
    current = dim_user.where("is_current").select("user_key", *attributes)
    return per_key.join(current, "user_key", "left")


def _by_user_id(facts: DataFrame, dim_user: DataFrame) -> DataFrame:
    """Replace each key by the key of the same user's current row."""
    owner = dim_user.select("user_key", F.col("user_id").alias("_owner"))
    current = dim_user.where("is_current").select(F.col("user_id").alias("_owner"), F.col("user_key").alias("_key"))
    moved = owner.join(current, "_owner", "left").select("user_key", "_key")
    return facts.join(moved, "user_key", "left").withColumn(
        "user_key", F.coalesce("_key", "user_key")
    ).drop("_key")


def revenue_per_user(facts: DataFrame, dim_user: DataFrame, by_user: bool = False) -> DataFrame:
    """Purchases per user key; ``by_user`` gathers all versions of a user under the current one."""
    sales = facts.where((F.col("event_type") == "purchase") & (F.col("purchase_amount") > 0)).select(
        "user_key", "purchase_amount", "purchase_quantity", "event_timestamp"
    )
    per_key = sales.groupBy("user_key").agg(
        F.count("*").alias("total_purchases"),
        F.sum("purchase_amount").alias("total_revenue"),
        F.sum("purchase_quantity").alias("total_items"),
        F.min("event_timestamp").alias("first_purchase_at"),
        F.max("event_timestamp").alias("last_purchase_at"),
    )
    if by_user:
        per_key = _by_user_id(per_key, dim_user).groupBy("user_key").agg(
            F.sum("total_purchases").alias("total_purchases"),
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("total_items").alias("total_items"),
            F.min("first_purchase_at").alias("first_purchase_at"),
            F.max("last_purchase_at").alias("last_purchase_at"),
        )
    return _revenue_rows(per_key, dim_user)


def _revenue_rows(per_key: DataFrame, dim_user: DataFrame) -> DataFrame:
    n = F.nullif(F.col("total_purchases"), F.lit(0))
    return _with_user(per_key, dim_user, ["user_id", "email", "plan_type", "subscription_status"]).select(
        "user_key", "user_id", "email", "plan_type", "subscription_status",
        "total_purchases", "total_revenue", "total_items",
        F.round(F.col("total_revenue") / n, 2).alias("avg_order_value"),
        F.round(F.col("total_items").cast("decimal(18,0)") / n, 2).alias("avg_items_per_order"),
        "first_purchase_at", "last_purchase_at",
        F.datediff("last_purchase_at", "first_purchase_at").alias("customer_lifespan_days"),
    )


def activity_per_user(facts: DataFrame, dim_user: DataFrame, as_of: str, by_user: bool = False,
                      lookback_days: int = CHURN_LOOKBACK_DAYS) -> DataFrame:
    """Last activity, events, active days and churn level of every user key."""
    per_day = facts.groupBy("user_key", F.to_date("event_timestamp").alias("day")).agg(
        F.count("*").alias("events"), F.max("event_timestamp").alias("last_at")
    )
    if by_user:
        per_day = _by_user_id(per_day, dim_user).groupBy("user_key", "day").agg(
            F.sum("events").alias("events"), F.max("last_at").alias("last_at")
        )
    return _activity_rows(per_day, dim_user, as_of, lookback_days)


def _activity_rows(per_day: DataFrame, dim_user: DataFrame, as_of: str, lookback_days: int) -> DataFrame:
    """From a row per user key and day: events and last_at."""
    per_key = per_day.groupBy("user_key").agg(
        F.max("last_at").alias("last_activity_at"),
        F.sum("events").alias("total_events"),
        F.count("day").alias("active_days"),
    )
    idle = F.datediff(F.lit(as_of).cast("date"), F.col("last_activity_at"))
    level = (
        F.when(idle >= CHURN_HIGH_DAYS, "high").when(idle >= CHURN_MEDIUM_DAYS, "medium")
        .when(idle >= lookback_days, "low").otherwise("none")
    )
    attributes = ["user_id", "email", "plan_type", "subscription_status", "signup_date"]
    return _with_user(per_key, dim_user, attributes).select(
        "user_key", *attributes, "last_activity_at", "total_events", "active_days",
        idle.alias("days_since_last_activity"),
        F.coalesce(idle >= lookback_days, F.lit(False)).alias("is_at_churn_risk"),
        level.alias("churn_risk_level"),
    )


def churn_risk(facts: DataFrame, dim_user: DataFrame, as_of: str, by_user: bool = False,
               lookback_days: int = CHURN_LOOKBACK_DAYS) -> DataFrame:
    """Users without activity for at least ``lookback_days``."""
    return activity_per_user(facts, dim_user, as_of, by_user, lookback_days).where("is_at_churn_risk")


# --- marts from partial aggregates ------------------------------------------------------------


def partials(facts: DataFrame) -> DataFrame:
    """One row per user key and day with everything the marts add up. Rows of several loads may be added together."""
    sale = (F.col("event_type") == "purchase") & (F.col("purchase_amount") > 0)
    of_sale = lambda column: F.when(sale, F.col(column))
    return facts.groupBy("user_key", F.to_date("event_timestamp").alias("day")).agg(
        F.count("*").alias("events"), F.max("event_timestamp").alias("last_at"),
        F.count_if(sale).alias("purchases"), F.sum(of_sale("purchase_amount")).cast("decimal(38,2)").alias("revenue"),
        F.sum(of_sale("purchase_quantity")).alias("items"),
        F.min(of_sale("event_timestamp")).alias("first_sale_at"), F.max(of_sale("event_timestamp")).alias("last_sale_at"),
    )


def merge_partials(parts: DataFrame) -> DataFrame:
    """The partial aggregates of several loads as those of one."""
    return parts.groupBy("user_key", "day").agg(
        F.sum("events").alias("events"), F.max("last_at").alias("last_at"), F.sum("purchases").alias("purchases"),
        F.sum("revenue").cast("decimal(38,2)").alias("revenue"), F.sum("items").alias("items"),
        F.min("first_sale_at").alias("first_sale_at"), F.max("last_sale_at").alias("last_sale_at"),
    )


def daily_active_users_of(parts: DataFrame) -> DataFrame:
    per_user = parts.where("day is not null").groupBy("day", "user_key").agg(F.sum("events").alias("events"))
    users, events = F.count("user_key"), F.sum("events")
    return per_user.groupBy(F.col("day").alias("activity_date")).agg(
        users.alias("daily_active_users"), events.alias("total_events"),
        F.round(events.cast("decimal(18,0)") / F.nullif(users, F.lit(0)), 2).alias("avg_events_per_user"),
    )


def revenue_per_user_of(parts: DataFrame, dim_user: DataFrame) -> DataFrame:
    per_key = parts.where("purchases > 0").groupBy("user_key").agg(
        F.sum("purchases").alias("total_purchases"), F.sum("revenue").alias("total_revenue"),
        F.sum("items").alias("total_items"), F.min("first_sale_at").alias("first_purchase_at"),
        F.max("last_sale_at").alias("last_purchase_at"),
    )
    return _revenue_rows(per_key, dim_user)


def churn_risk_of(parts: DataFrame, dim_user: DataFrame, as_of: str,
                  lookback_days: int = CHURN_LOOKBACK_DAYS) -> DataFrame:
    per_day = merge_partials(parts).select("user_key", "day", "events", "last_at")
    return _activity_rows(per_day, dim_user, as_of, lookback_days).where("is_at_churn_risk")
