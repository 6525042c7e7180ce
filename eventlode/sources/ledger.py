"""Surrogate key ranges that outlive a lost load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlode.functions.inline import inline_rows
from eventlode.sources.batches import Folders


class KeyLedger:
    """Ranges of surrogate keys that loads have reserved, a row per load.

    A range is recorded before the rows that use it are written. A load that is lost in between leaves a gap, and no later
    load gets its keys. Reading the ledger costs a row per load, not a scan of the keyed table. One writer is assumed.
    """

    _ROWS = T.StructType().add("load", "string").add("low", "long").add("high", "long")

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _rows(self) -> DataFrame | None:
        return self.spark.read.schema(self._ROWS).parquet(self.path) if Folders(self.spark, self.path).names() else None

    def highest(self) -> int | None:
        """The last key reserved; none if the ledger was never begun."""
        rows = self._rows()
        return None if rows is None else rows.agg(F.max("high")).first()[0]

    def begin(self, after: int) -> None:
        """Start the ledger of a table that already has keys up to ``after``."""
        self._append("opening", 1, after)

    def reserve(self, count: int, load: str) -> int:
        """Reserve ``count`` keys and return the one before the first."""
        after = self.highest() or 0
        self._append(load, after + 1, after + count)
        return after

    def _append(self, load: str, low: int, high: int) -> None:
        inline_rows(self.spark, [(load, low, high)], self._ROWS).coalesce(1).write.mode("append").parquet(self.path)
