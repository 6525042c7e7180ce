"""Compaction of what a stream appended, without disturbing the readers of the stream.

Every micro-batch leaves small files in each partition that it touches. Compaction packs the small files of a partition
into files near a target size, beside the stream's table, and publishes in one step which files they stand for. A batch
reader takes the packed files and those of the table's own that none stands for. The table itself is not changed: streams
that read it, and the log of its sink, go on as if nothing had happened. Replaced files may be removed by the operator of
the store once no stream needs them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlode.functions.inline import inline_rows
from eventlode.operators.quality import list_files
from eventlode.sources.batches import Folders

TARGET_BYTES = 256 << 20


class CompactedTable:
    """A partitioned Parquet table at ``path`` with packed files under ``packed``."""

    _PACKS = T.StructType().add("path", "string").add("version", "long")
    _REPLACED = T.StructType().add("file", "string")

    def __init__(self, spark: SparkSession, path: str, packed: str, layout: T.StructType, partition_by: tuple[str, ...],
                 target_bytes: int = TARGET_BYTES):
        self.spark, self.path, self.packed, self.layout = spark, path.rstrip("/"), packed.rstrip("/"), layout
        self.partition_by, self.target_bytes = partition_by, target_bytes

    def _packs(self) -> list[tuple[str, int]]:
        if not Folders(self.spark, f"{self.packed}/_packs").names():
            return []
        return [(r.path, r.version) for r in self.spark.read.schema(self._PACKS).parquet(f"{self.packed}/_packs").collect()]

    def open_files(self) -> DataFrame:
        """The table's own files that no pack stands for: path, length and the partition columns."""
        files = list_files(self.spark, self.path)
        packs = self._packs()
        if not packs:
            return files
        replaced = self.spark.read.schema(self._REPLACED).parquet(*[f"{path}/replaced" for path, _ in packs])
        return files.join(replaced, files["path"] == replaced["file"], "left_anti")

    def compact(self) -> int:
        """Pack the small files of every partition that has two or more; returns how many files were replaced.

        Files of at least half the target size stay. A partition gets as many packed files as its small ones fill, and
        rows are dealt to them by a hash, so a partition with most of the table is not one task.
        """
        small = self.open_files().where(F.col("length") < self.target_bytes // 2).select("path", "length", *self.partition_by)
        per_part = small.groupBy(*self.partition_by).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        crowded = per_part.where("files > 1").withColumn(
            "_files", F.ceil(F.col("bytes") / self.target_bytes).cast("int")).drop("files", "bytes")
        chosen = small.alias("small").join(
            crowded.alias("crowded"), [F.col(f"small.{c}").eqNullSafe(F.col(f"crowded.{c}")) for c in self.partition_by])
        names = [r.path for r in chosen.select("small.path").collect()]
        if not names:
            return 0
        version = max((v for _, v in self._packs()), default=0) + 1
        folder = f"{self.packed}/v{version:08d}-{uuid.uuid4().hex[:8]}"
        rows = self._read(names)
        # As text on both sides: what a folder name reads as depends on the other folders.
        named = crowded.select(*[F.col(c).cast("string").alias(f"_{c}") for c in self.partition_by], "_files")
        same = [F.col(c).cast("string").eqNullSafe(F.col(f"_{c}")) for c in self.partition_by]
        dealt = rows.join(named, same, "left").withColumn(
            "_pack", F.pmod(F.xxhash64(*[c for c in rows.columns if not isinstance(rows.schema[c].dataType, T.MapType)]),
                            F.coalesce("_files", F.lit(1))))
        # The pack is a folder level, so that tasks that take several packs still write a file for each.
        dealt = dealt.repartition(*self.partition_by, "_pack").select(*rows.columns, "_pack")
        dealt.write.partitionBy(*self.partition_by, "_pack").parquet(f"{folder}/rows")
        self.spark.createDataFrame([(n,) for n in names], self._REPLACED).coalesce(1).write.parquet(f"{folder}/replaced")
        inline_rows(self.spark, [(folder, version)], self._PACKS).coalesce(1).write.mode("append").parquet(f"{self.packed}/_packs")
        return len(names)

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(self.layout).option("basePath", self.path).parquet(*names).select(*self.layout.names)

    def read(self) -> DataFrame:
        """Every row of the table once, from packed files where there are any."""
        names = [r.path for r in self.open_files().select("path").collect()]
        parts = [self._read(names)] if names else []
        parts += [self.spark.read.schema(self.layout).parquet(f"{path}/rows").select(*self.layout.names)
                  for path, _ in self._packs()]
        if not parts:
            return self.spark.createDataFrame([], self.layout)
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        return every
