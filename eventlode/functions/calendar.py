"""Calendar attributes of a timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The time dimension numbers hours from here, starting with 1.
CALENDAR_START = "2020-01-01 00:00:00"
CALENDAR_END = "2030-12-31 23:00:00"


def calendar_columns(hours: DataFrame, column: str = "full_timestamp") -> DataFrame:
    """The time-dimension row of every hour in ``column``. Names are not blank-padded."""
    ts = F.col(column)
    iso_day = F.weekday(ts) + 1
    hours_since_start = (F.unix_seconds(ts) - F.unix_seconds(F.lit(CALENDAR_START).cast("timestamp"))) / 3600
    return hours.select(
        (hours_since_start + 1).cast("int").alias("time_key"),
        ts.alias("full_timestamp"),
        F.to_date(ts).alias("date_actual"),
        F.year(ts).alias("year"),
        F.quarter(ts).alias("quarter"),
        F.month(ts).alias("month"),
        F.date_format(ts, "MMMM").alias("month_name"),
        F.weekofyear(ts).alias("week_of_year"),
        F.dayofmonth(ts).alias("day_of_month"),
        iso_day.alias("day_of_week"),
        F.date_format(ts, "EEEE").alias("day_name"),
        F.hour(ts).alias("hour"),
        F.lit(0).alias("minute"),
        iso_day.isin(6, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )
