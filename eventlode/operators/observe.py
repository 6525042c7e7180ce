"""Numbers measured while rows are written, without a job of their own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation

from eventlode.session import work_dir


@dataclass
class Observed:
    """Rows with metrics attached. ``values`` is there once an action has read all of them; it never starts a job."""

    rows: DataFrame
    observation: Observation

    def values(self) -> dict:
        return self.observation.get


def observed(rows: DataFrame, *metrics: Column) -> Observed:
    """Attach aggregates, each with an alias, to ``rows``."""
    observation = Observation()
    return Observed(rows.observe(observation, *metrics), observation)


def materialize_observed(rows: DataFrame, label: str, *metrics: Column) -> tuple[DataFrame, dict]:
    """Write rows to the shared folder, read them back, and return what was measured on the way."""
    path = work_dir(rows.sparkSession, label)
    found = observed(rows, *metrics)
    found.rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), found.values()
