"""KPI reads over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def dau_trend(dau: DataFrame, days: int = 30, latest: bool = False) -> DataFrame:
    """``days`` dates in ascending order: the oldest, or with ``latest`` the newest."""
    picked = dau.orderBy(F.desc("activity_date") if latest else F.asc("activity_date")).limit(days)
    return picked.select(
        F.col("activity_date").cast("string").alias("date"),
        "daily_active_users", "total_events", "avg_events_per_user",
    ).orderBy("date")


def top_revenue(revenue: DataFrame, users: int = 50) -> DataFrame:
    return (
        revenue.select("user_key", "total_revenue", "total_purchases", "avg_order_value")
        .orderBy(F.desc("total_revenue"), "user_key").limit(users)
    )


def top_churn(churn: DataFrame, users: int = 50) -> DataFrame:
    return (
        churn.where(F.col("churn_risk_level") == "high")
        .select("user_key", "days_since_last_activity", "churn_risk_level")
        .orderBy(F.desc("days_since_last_activity"), "user_key").limit(users)
    )


def summary(revenue: DataFrame, churn: DataFrame) -> DataFrame:
    """One row: total revenue and the number of high-risk users; zero where there is nothing."""
    both = revenue.select(
        F.col("total_revenue").cast("decimal(38,2)").alias("amount"), F.lit(0).alias("risk")
    ).unionByName(
        churn.where(F.col("churn_risk_level") == "high")
        .select(F.lit(None).cast("decimal(38,2)").alias("amount"), F.lit(1).alias("risk"))
    )
    return both.agg(
        F.coalesce(F.sum("amount"), F.lit(0)).alias("total_revenue"),
        F.coalesce(F.sum("risk"), F.lit(0)).alias("high_risk_users"),
    )


def with_live_revenue(stored: DataFrame, live: DataFrame) -> DataFrame:
    """The summary with the live purchases added to the stored revenue. Both have one row."""
    both = stored.select(F.col("total_revenue").cast("decimal(38,2)").alias("amount"), "high_risk_users").unionByName(
        live.select(F.col("live_revenue").cast("decimal(38,2)").alias("amount"), F.lit(0).alias("high_risk_users"))
    )
    return both.agg(F.sum("amount").alias("total_revenue"), F.sum("high_risk_users").alias("high_risk_users"))


def with_live_users(trend: DataFrame, live: DataFrame) -> DataFrame:
    """The trend with the live users added to its newest date. The trend has as many rows as days asked for."""
    newest = Window.orderBy(F.desc("date"))
    added = live.select(F.lit(1).alias("_age"), "live_users")
    return (
        trend.withColumn("_age", F.row_number().over(newest)).join(added, "_age", "left")
        .withColumn("daily_active_users", F.col("daily_active_users") + F.coalesce("live_users", F.lit(0)))
        .drop("_age", "live_users")
    )
