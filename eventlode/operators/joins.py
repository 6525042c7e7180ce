"""Joins between facts and a versioned dimension, and the star views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def at_event_time(facts: DataFrame, versions: DataFrame, how: str = "inner") -> DataFrame:
    """Attach to each fact the user's version in force when it happened.

    Intervals are half-open, so an event on the instant of a change belongs to the later version
    only. The join is an equi join by user with the range as a residue; users have few versions, and
    a user with very many events is split over tasks by adaptive execution.
    """
    v = versions.select(
        F.col("user_id").alias("_user"), "plan_type", "version_number",
        F.col("effective_start_date").alias("_from"), F.col("effective_end_date").alias("_until"),
    )
    in_force = (F.col("event_timestamp") >= F.col("_from")) & (
        F.col("_until").isNull() | (F.col("event_timestamp") < F.col("_until"))
    )
    return facts.join(v, (F.col("user_id") == F.col("_user")) & in_force, how).drop("_user", "_from", "_until")


def as_of_merged(facts: DataFrame, versions: DataFrame, slice_width: str = "hour") -> DataFrame:
    """The same rows as ``at_event_time`` without comparing facts with versions.

    Facts and version starts become one stream that is ordered by time inside pieces of one user and one ``slice_width``;
    in a piece the last version seen is carried forward. A piece begins with the version that its user had at the end of
    the pieces before, which is found over a row per piece and not per fact. Work grows with facts plus versions: a user
    with very many of both is cut into pieces and never pairs them. Of versions that begin at one instant the highest
    number counts, so versions must not overlap otherwise. Facts without a user or time have no version and are left out.
    """
    version = F.struct("effective_start_date", "version_number", "effective_end_date", "plan_type")
    marks = versions.where(F.col("user_id").isNotNull() & F.col("effective_start_date").isNotNull()).select(
        F.col("user_id").alias("_user"), F.col("effective_start_date").alias("_at"), version.alias("_version"))
    piece = F.date_trunc(slice_width, "_at")
    starts = marks.groupBy("_user", piece.alias("_piece")).agg(F.max("_version").alias("_last"))
    named = facts.where(F.col("user_id").isNotNull() & F.col("event_timestamp").isNotNull()).withColumns(
        {"_user": F.col("user_id"), "_at": F.col("event_timestamp")}).withColumn("_piece", piece)
    pieces = named.select("_user", "_piece").distinct().join(starts, ["_user", "_piece"], "full")
    earlier = Window.partitionBy("_user").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    opened = pieces.select("_user", "_piece", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    rows = named.select("_user", "_piece", "_at", F.struct(*facts.columns).alias("_fact"),
                        F.lit(None).cast(marks.schema["_version"].dataType).alias("_version"))
    both = rows.unionByName(marks.withColumn("_piece", piece).withColumn(
        "_fact", F.lit(None).cast(rows.schema["_fact"].dataType)))
    so_far = Window.partitionBy("_user", "_piece").orderBy("_at", F.col("_fact").isNotNull(), "_version").rowsBetween(
        Window.unboundedPreceding, 0)
    carried = both.withColumn("_seen", F.last("_version", ignorenulls=True).over(so_far)).where("_fact is not null")
    found = carried.join(opened, ["_user", "_piece"]).withColumn("_v", F.coalesce("_seen", "_carried"))
    in_force = F.col("_v").isNotNull() & (F.col("_v.effective_end_date").isNull() | (F.col("_at") < F.col("_v.effective_end_date")))
    return found.where(in_force).select("_fact.*", "_v.plan_type", "_v.version_number")


def revenue_by_plan(facts: DataFrame, versions: DataFrame, merged: bool = False) -> DataFrame:
    """Purchase revenue by the plan the user was on at the time; ``merged`` where users have very many versions."""
    sales = facts.where(F.col("event_type") == "purchase").select("user_id", "event_timestamp", "total_amount")
    dated = as_of_merged(sales, versions) if merged else at_event_time(sales, versions)
    return dated.groupBy("plan_type").agg(
        F.sum("total_amount").alias("revenue"), F.count("*").alias("purchases")
    )


def current_users(dim_user: DataFrame) -> DataFrame:
    return dim_user.where("is_current")


def denormalized(facts: DataFrame, dim_user: DataFrame, dim_time: DataFrame, dim_device: DataFrame) -> DataFrame:
    """Facts with the attributes of their user, hour and device; missing dimensions leave NULLs."""
    users = dim_user.select("user_key", "user_id", "email", "plan_type", "subscription_status",
                            F.col("country").alias("user_country"))
    hours = dim_time.select("time_key", "date_actual", "year", "month", "month_name", "day_name", "hour",
                            "is_weekend")
    devices = dim_device.select("device_key", "device_type", "os_family", "browser_family", "is_mobile")
    measures = facts.select("event_key", "event_id", "event_type", "event_timestamp", "user_key", "time_key",
                            "device_key", "purchase_amount", "purchase_quantity", "is_conversion", "is_error")
    return (
        measures.join(users, "user_key", "left").join(hours, "time_key", "left").join(devices, "device_key", "left")
        .drop("user_key", "time_key", "device_key")
    )
