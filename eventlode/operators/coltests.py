"""Declarative column tests: unique, not_null, accepted_values, relationships."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlode.schemas import EVENT_TYPES


@dataclass(frozen=True)
class ColumnTest:
    table: str
    column: str
    kind: str
    values: tuple = field(default=())
    target: tuple[str, str] | None = None


def _tests(table: str, column: str, *kinds: str, values: tuple = ()) -> list[ColumnTest]:
    return [ColumnTest(table, column, kind, values if kind == "accepted_values" else ()) for kind in kinds]


# The tests of the star schema and the marts
COLUMN_TESTS = [
    *_tests("fact_events", "event_key", "unique", "not_null"),
    *_tests("fact_events", "event_id", "not_null"),
    *_tests("fact_events", "idempotency_key", "unique", "not_null"),
    *_tests("fact_events", "event_type", "not_null", "accepted_values", values=tuple(EVENT_TYPES)),
    *_tests("fact_events", "event_timestamp", "not_null"),
    *_tests("dim_user", "user_key", "unique", "not_null"),
    *_tests("dim_user", "user_id", "not_null"),
    *_tests("dim_user", "is_current", "not_null", "accepted_values", values=(True, False)),
    *_tests("dim_time", "time_key", "unique", "not_null"),
    *_tests("dim_device", "device_key", "unique", "not_null"),
    *_tests("daily_active_users", "activity_date", "unique", "not_null"),
    *_tests("daily_active_users", "daily_active_users", "not_null"),
    *_tests("revenue_per_user", "user_key", "unique", "not_null"),
    *_tests("revenue_per_user", "total_revenue", "not_null"),
    *_tests("churn_risk", "user_key", "unique", "not_null"),
    *_tests("churn_risk", "days_since_last_activity", "not_null"),
    *_tests("churn_risk", "churn_risk_level", "not_null", "accepted_values", values=("low", "medium", "high")),
    *_tests("churn_risk", "is_at_churn_risk", "not_null", "accepted_values", values=(True,)),
]

# Foreign keys of the fact table
FOREIGN_KEYS = [
    ColumnTest("fact_events", "user_key", "relationships", target=("dim_user", "user_key")),
    ColumnTest("fact_events", "time_key", "relationships", target=("dim_time", "time_key")),
    ColumnTest("fact_events", "device_key", "relationships", target=("dim_device", "device_key")),
]


def duplicates(table: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once. NULLs are exempt."""
    return (
        table.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def unaccepted(table: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is not listed. NULLs are exempt."""
    return table.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def orphans(table: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys without a parent row and how many rows carry each. NULLs are exempt.

    Rows are counted per key before the join, so a key that fills a third of the table is one row
    in it.
    """
    counted = table.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("occurrences"))
    keys = parent.select(F.col(parent_column).alias("_parent"))
    return counted.join(keys, F.col(column) == F.col("_parent"), "left_anti")


def _row_tests(table: DataFrame, tests: list[ColumnTest]) -> DataFrame:
    """All not_null and accepted_values tests of a table in a single pass."""
    counts, labels = [], []
    for i, test in enumerate(tests):
        value = F.col(test.column)
        bad = value.isNull() if test.kind == "not_null" else value.isNotNull() & ~value.isin(*test.values)
        counts.append(F.count_if(bad).alias(f"t{i}"))
        labels.append(F.struct(
            F.lit(test.table).alias("table_name"), F.lit(test.column).alias("column_name"),
            F.lit(test.kind).alias("test"), F.col(f"t{i}").alias("failures"),
        ))
    return table.agg(*counts).select(F.inline(F.array(*labels)))


def run_column_tests(spark: SparkSession, tables: dict[str, DataFrame],
                     tests: list[ColumnTest] | None = None) -> DataFrame:
    """Failures of every test (table_name, column_name, test, failures, status)."""
    tests = COLUMN_TESTS + FOREIGN_KEYS if tests is None else tests
    parts = []
    for name in dict.fromkeys(test.table for test in tests):
        table = tables[name]
        mine = [test for test in tests if test.table == name]
        simple = [test for test in mine if test.kind in ("not_null", "accepted_values")]
        if simple:
            parts.append(_row_tests(table, simple))
        for test in mine:
            if test.kind == "unique":
                bad, failures = duplicates(table, test.column), F.count("*")
            elif test.kind == "relationships":
                bad = orphans(table, test.column, tables[test.target[0]], test.target[1])
                failures = F.coalesce(F.sum("occurrences"), F.lit(0))
            else:
                continue
            parts.append(bad.agg(failures.alias("failures")).select(
                F.lit(name).alias("table_name"), F.lit(test.column).alias("column_name"),
                F.lit(test.kind).alias("test"), "failures",
            ))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
