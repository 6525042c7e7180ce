"""Rows that come too late for their window, kept with a reason instead of dropped.

A stateful operator drops rows behind the watermark without a trace. Here every batch is split before it reaches one:
rows behind the watermark go to the late rows, all others to the punctual ones, which the stateful queries read. The
watermark is the engine's rule, the latest event time of all batches before less the delay, and is kept as a row per batch.

The punctual rows of a batch appear at once, by renaming their folder, and a query that reads whole batches in their order
can't have a later watermark than the split had. Where a file system doesn't rename folders in one step, a reader may see
part of a batch first; a row that it drops then still shows in the record that ``DropListener`` keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from eventlode.functions.inline import inline_rows
from eventlode.operators.observe import observed
from eventlode.schemas import WATERMARK_DELAY
from eventlode.sources.batches import BatchFolders, Folders
from eventlode.streaming.run import with_trigger

LATE_REASON = "late_event"
MARK = T.StructType().add("latest", T.TimestampType()).add("punctual", "long").add("late", "long")


def is_late(latest: Column, delay: str, window: str | None = None) -> Column:
    """Whether a row is behind the watermark that ``latest`` gives; before the first batch nothing is.

    Deduplication and gap sessions refuse rows whose event time the watermark has reached. With ``window`` a row is late
    when the last window that it falls in has closed, which is when a plain windowed count refuses it.
    """
    mark = latest - F.expr(f"interval {delay}")
    until = F.col("event_timestamp") if window is None else F.window("event_timestamp", window)["end"]
    return F.coalesce(until <= mark, F.lit(False))


def split_late(events: DataFrame, path: str, checkpoint: str, trigger: str, delay: str = WATERMARK_DELAY,
               window: str | None = None, files: int | None = None) -> StreamingQuery:
    """Write each batch of ``events`` under ``path``: ``punctual/batch=*``, ``late/batch=*``, and the marks.

    Every row is in one of the two, with the watermark that judged it. A batch that is run again
    finds the same mark and replaces its rows. Rows without an event time are punctual: no watermark judges them.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks, folders = BatchFolders(spark, f"{path}/marks", MARK), Folders(spark, path)
        before = marks.read(before=batch_id).first()
        latest = F.lit(before.latest if before else None).cast("timestamp")
        # Decided once, in one pass over the batch; the folders of both kinds are then only renamed.
        staged = f"_staged/batch={batch_id}"
        rows = batch.withColumns({
            "_late": is_late(latest, delay, window), "watermark": latest - F.expr(f"interval {delay}"),
            "dlq_timestamp": F.current_timestamp(),
        })
        found = observed(rows, F.max("event_timestamp").alias("latest"), F.count_if(~F.col("_late")).alias("punctual"),
                         F.count_if("_late").alias("late"))
        if files:
            found.rows = found.rows.repartition(files)
        found.rows.write.mode("overwrite").partitionBy("_late").parquet(f"{path}/{staged}")
        counts = found.values()
        for flag, kind in (("false", "punctual"), ("true", "late")):
            if folders.holds(f"{kind}/batch={batch_id}"):
                folders.delete(f"{kind}/batch={batch_id}")
            if folders.holds(f"{staged}/_late={flag}"):
                folders.rename(f"{staged}/_late={flag}", f"{kind}/batch={batch_id}")
        folders.delete(staged)
        times = [t for t in (before.latest if before else None, counts["latest"]) if t is not None]
        marks.write(inline_rows(spark, [(max(times, default=None), counts["punctual"], counts["late"])], MARK), batch_id)

    writer = (
        events.writeStream.outputMode("append").queryName("split_late").option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return with_trigger(writer, trigger).start()


def _stamped(layout: T.StructType) -> T.StructType:
    return T.StructType(list(layout.fields)).add("watermark", "timestamp").add("dlq_timestamp", "timestamp")


def punctual(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The punctual rows as a stream that takes whole batches in their order."""
    return spark.readStream.schema(layout).parquet(f"{path}/punctual/batch=*")


def _batches(spark: SparkSession, path: str, kind: str, layout: T.StructType) -> DataFrame:
    reader = spark.read.schema(_stamped(layout))
    if not Folders(spark, f"{path}/{kind}").names():
        return spark.createDataFrame([], _stamped(layout))
    return reader.parquet(f"{path}/{kind}/batch=*")


def late_rows(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The rows that came too late, as dead letters: with a reason, the watermark they missed, and when they were found."""
    return _batches(spark, path, "late", layout).withColumn("dlq_reason", F.lit(LATE_REASON))


def punctual_rows(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    return _batches(spark, path, "punctual", layout)


DROPS = T.StructType().add("query", "string").add("batch", "long").add("operator", "integer").add("dropped", "long")


class DropListener(StreamingQueryListener):
    """Records for every batch how many rows each stateful operator dropped behind the watermark.

    Batches without a dropped row leave no record, so the list is as long as the trouble. ``rows`` gives the records as
    a table, ``dropped`` their sum for one query.
    """

    def __init__(self):
        self.records: list[tuple[str, int, int, int]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for place, operator in enumerate(progress.stateOperators):
            if operator.numRowsDroppedByWatermark:
                self.records.append((progress.name, progress.batchId, place, operator.numRowsDroppedByWatermark))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def dropped(self, query: str) -> int:
        return sum(n for name, _, _, n in self.records if name == query)

    def rows(self, spark: SparkSession) -> DataFrame:
        return inline_rows(spark, list(self.records), DROPS)
