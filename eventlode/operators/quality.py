"""Freshness, volume and null checks, their report, and the quality log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventlode.functions.inline import inline_rows
from eventlode.schemas import CRITICAL_COLUMNS, FRESHNESS_HOURS, QUALITY_LOG, VOLUME_LOOKBACK_DAYS, VOLUME_THRESHOLD_PCT

# Every check yields these columns, so that reports are plain unions.
CHECK_COLUMNS = ["date", "check_name", "status", "check_value", "threshold_value", "details"]


def read_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet table, skipping files that cannot be read instead of failing the check."""
    return spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").parquet(path)


def _dates(spark: SparkSession, dates: list[str]) -> DataFrame:
    return inline_rows(spark, [(d,) for d in dates], "date string")


def _check(name: str, status: Column, value: Column, threshold: float, details: Column) -> list[Column]:
    return [
        F.col("date"), F.lit(name).alias("check_name"), status.alias("status"),
        value.cast("double").alias("check_value"), F.lit(float(threshold)).alias("threshold_value"),
        details.alias("details"),
    ]


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """path, modified, length and the partition columns of a Parquet table's files, from the listing alone.

    Only committed files count where a stream writes the table. No file is opened.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    named = files.withColumnRenamed("modificationTime", "modified").drop("content")
    return named.withColumn("date", F.col("date").cast("string")) if "date" in named.columns else named


def scanned_files(table: DataFrame) -> DataFrame:
    """The same two columns for a frame whose folder is not known; reads a row per event."""
    return (
        table.select(F.col("date").cast("string").alias("date"), F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_modification_time").alias("modified"))
        .groupBy("date", "path").agg(F.max("modified").alias("modified"))
    )


def freshness(files: DataFrame, now: str | None = None, dates: list[str] | None = None,
              max_hours: float = FRESHNESS_HOURS) -> DataFrame:
    """Age of the newest of ``files`` (date, modified) on each date. Dates that were asked for but have no file fail."""
    files = files.groupBy("date").agg(F.count("*").alias("file_count"), F.max("modified").alias("latest"))
    if dates is not None:
        files = _dates(files.sparkSession, dates).join(files, "date", "left")
    clock = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    hours = (F.unix_micros(clock) - F.unix_micros("latest")) / 3.6e9
    status = F.when(hours <= max_hours, "PASSED").otherwise("FAILED")
    details = F.to_json(F.struct(F.coalesce("file_count", F.lit(0)).alias("file_count"), F.col("latest")))
    return files.select(*_check("Freshness Check", status, hours, max_hours, details))


def daily_counts(table: DataFrame, date: str = "date") -> DataFrame:
    return table.groupBy(F.col(date).cast("string").alias("date")).agg(F.count("*").alias("rows"))


def volume(counts: DataFrame, dates: list[str] | None = None, threshold_pct: float = VOLUME_THRESHOLD_PCT,
           lookback_days: int = VOLUME_LOOKBACK_DAYS, zero_fill: bool = False) -> DataFrame:
    """Rows per date against the mean of the preceding days that have data.

    Works on one row per date. ``zero_fill`` divides by all preceding days instead, empty ones too.
    A date without rows is skipped, one without history is a warning.
    """
    day = F.datediff(F.col("date").cast("date"), F.lit("1970-01-01").cast("date"))
    # Dates are few, but partitioning by month blocks would cut the look-back: one ordered pass.
    past = Window.orderBy("_day").rangeBetween(-lookback_days, -1)
    base = counts.withColumn("_day", day)
    divisor = F.lit(lookback_days) if zero_fill else F.count("rows").over(past)
    history = base.withColumn("days_before", F.count("rows").over(past)).withColumn(
        "mean_before", F.sum("rows").over(past) / F.nullif(divisor.cast("bigint"), F.lit(0).cast("bigint"))
    )
    if dates is not None:
        history = _dates(counts.sparkSession, dates).join(history, "date", "left")
    deviation = F.abs(F.col("rows") - F.col("mean_before")) / F.col("mean_before") * 100
    status = (
        F.when(F.col("rows").isNull(), "SKIPPED").when(F.col("days_before") == 0, "WARNING")
        .when(deviation <= threshold_pct, "PASSED").otherwise("FAILED")
    )
    details = F.to_json(F.struct(
        F.col("rows").alias("current_count"), F.round("mean_before", 2).alias("avg_count"),
        F.round(deviation, 2).alias("deviation_pct"), F.col("days_before").alias("historical_days"),
    ))
    return history.select(*_check("Volume Check", status, deviation, threshold_pct, details))


def null_profile(table: DataFrame, columns: list[str] = CRITICAL_COLUMNS, date: str = "date") -> DataFrame:
    """NULLs of every column per date, in one pass; a column the table lacks counts as NULL throughout."""
    present = set(table.columns)
    counts = [
        (F.count_if(F.col(name).isNull()) if name in present else F.lit(None).cast("bigint")).alias(name)
        for name in columns
    ]
    wide = table.groupBy(F.col(date).cast("string").alias("date")).agg(F.count("*").alias("total_count"), *counts)
    return wide.unpivot(["date", "total_count"], columns, "column_name", "null_count").withColumn(
        "null_pct", F.round(F.col("null_count") / F.col("total_count") * 100, 4)
    ).withColumn(
        "status", F.when(F.col("null_count") == 0, "PASSED").otherwise("FAILED")
    )


def nulls(table: DataFrame, columns: list[str] = CRITICAL_COLUMNS, dates: list[str] | None = None) -> DataFrame:
    """One check per date: no critical column may hold a NULL, and all must exist."""
    profile = null_profile(table, columns)
    per_date = profile.groupBy("date").agg(
        F.count_if(F.col("status") == "FAILED").alias("bad"),
        F.sort_array(F.collect_list(F.when(F.col("status") == "FAILED", F.col("column_name")))).alias("failed_columns"),
    )
    if dates is not None:
        per_date = _dates(table.sparkSession, dates).join(per_date, "date", "left")
    status = (
        F.when(F.col("bad").isNull(), "SKIPPED").when(F.col("bad") == 0, "PASSED").otherwise("FAILED")
    )
    return per_date.select(*_check("Null Check", status, F.col("bad"), 0, F.to_json(F.struct("failed_columns"))))


def report(*checks: DataFrame) -> DataFrame:
    """Roll checks up per date. Only FAILED fails a report; warnings and skipped checks do not."""
    everything = checks[0]
    for other in checks[1:]:
        everything = everything.unionByName(other)
    failed = F.count_if(F.col("status") == "FAILED")
    return everything.groupBy("date").agg(
        F.when(failed > 0, "FAILED").otherwise("PASSED").alias("overall_status"),
        F.count("*").alias("total_checks"),
        F.count_if(F.col("status") == "PASSED").alias("passed_checks"),
        failed.alias("failed_checks"),
        F.sort_array(F.collect_list(F.struct("check_name", "status", "check_value", "threshold_value", "details")))
        .alias("checks"),
    )


def date_checks(table: DataFrame, date: str, now: str | None = None, threshold_pct: float = VOLUME_THRESHOLD_PCT,
                lookback_days: int = VOLUME_LOOKBACK_DAYS, critical: list[str] = CRITICAL_COLUMNS,
                path: str | None = None) -> DataFrame:
    """The three checks of one date; only that date's folder and the look-back folders are read.

    With the table's ``path`` the age of its files comes from the listing instead of a scan.
    """
    files = scanned_files(table) if path is None else list_files(table.sparkSession, path)
    day = table.where(F.col("date") == date)
    recent = table.where(
        F.col("date").between(F.date_sub(F.lit(date).cast("date"), lookback_days).cast("string"), F.lit(date))
    )
    return (
        freshness(files.where(F.col("date") == date), now, [date])
        .unionByName(volume(daily_counts(recent), [date], threshold_pct, lookback_days))
        .unionByName(nulls(day, critical, [date]))
    )


def run_quality(table: DataFrame, date: str, **limits: object) -> DataFrame:
    """The report of one date; arguments are those of ``date_checks``."""
    return report(date_checks(table, date, **limits))


def write_report(rolled: DataFrame, path: str) -> None:
    """The report as JSON. It has one row per checked date."""
    rolled.coalesce(1).write.mode("append").json(path)


def log_rows(checks: DataFrame, table_name: str) -> DataFrame:
    """Check rows in the layout of the quality log."""
    kind = F.lower(F.element_at(F.split("check_name", " "), 1))
    verdict = (
        F.when(F.col("status") == "PASSED", "pass").when(F.col("status") == "FAILED", "fail").otherwise("warning")
    )
    return checks.select(
        F.md5(F.concat_ws("|", F.lit(table_name), "check_name", "date")).alias("check_id"),
        "check_name", F.lit(table_name).alias("table_name"), kind.alias("check_type"), verdict.alias("status"),
        F.col("check_value").cast("decimal(38,10)").alias("check_value"),
        F.col("threshold_value").cast("decimal(38,10)").alias("threshold_value"),
        "details", F.current_timestamp().alias("checked_at"),
    ).select(*QUALITY_LOG.names)
