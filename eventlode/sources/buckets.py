"""A table in buckets by key, of which a change rewrites only the buckets it touches."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventlode.functions.inline import inline_rows
from eventlode.sources.batches import Folders
from eventlode.sources.tables import write_partitioned


class BucketedDimension:
    """Rows in a fixed number of buckets by the hash of a key, replaced bucket by bucket.

    A change writes new files for the buckets it names and then appends one manifest row for each, in one file. Buckets
    that no row names keep their files. Readers take the newest row of each bucket, so they see all of a change or nothing
    of it; old files stay for readers that started before. The manifest has at most a row per bucket and change, and the
    part of it that reaches the driver a row per bucket. One writer is assumed.
    """

    _MANIFEST = T.StructType().add("bucket", "integer").add("path", "string").add("version", "long")

    def __init__(self, spark: SparkSession, root: str, layout: T.StructType, key: str, buckets: int = 256):
        self.spark, self.root, self.layout, self.key, self.buckets = spark, root.rstrip("/"), layout, key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def current(self) -> dict[int, tuple[str, int]]:
        """Path and version of every bucket; an empty path is a bucket without rows."""
        if not Folders(self.spark, f"{self.root}/_manifest").names():
            return {}
        newest = self.spark.read.schema(self._MANIFEST).parquet(f"{self.root}/_manifest").groupBy("bucket").agg(
            F.max(F.struct("version", "path")).alias("entry"))
        return {r.bucket: (r.entry.path, r.entry.version) for r in newest.collect()}

    def exists(self) -> bool:
        return bool(self.current())

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets; no other file is opened."""
        wanted = None if buckets is None else set(buckets)
        paths = [path for b, (path, _) in self.current().items() if path and (wanted is None or b in wanted)]
        if not paths:
            return self.spark.createDataFrame([], self.layout)
        return self.spark.read.schema(self.layout).parquet(*paths)

    def replace(self, rows: DataFrame, buckets: list[int] | None = None) -> None:
        """Put ``rows`` in place of all rows of the named buckets, or of the whole table."""
        changed = list(range(self.buckets)) if buckets is None else sorted(set(buckets))
        if not changed:
            return
        version = max((v for _, v in self.current().values()), default=0) + 1
        folder = f"{self.root}/v{version:08d}-{uuid.uuid4().hex[:8]}"
        write_partitioned(rows.select(*self.layout.names).withColumn("_bucket", self.bucket()), folder, ("_bucket",))
        written = set(Folders(self.spark, folder).names())
        entries = [(b, f"{folder}/_bucket={b}" if f"_bucket={b}" in written else "", version) for b in changed]
        stray = {name for name in written if name.startswith("_bucket=")} - {f"_bucket={b}" for b in changed}
        if stray:
            raise ValueError(f"rows for buckets that are not replaced: {sorted(stray)}")
        inline_rows(self.spark, entries, self._MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/_manifest")


class PartTable:
    """A table in named parts, such as loads, of which one is replaced at a time.

    As above, a part's new rows are written beside the old ones and then published by a manifest row. ``fold`` puts
    one new part with the merged rows in place of many, by rows of one manifest file.
    """

    _MANIFEST = T.StructType().add("part", "string").add("path", "string").add("version", "long")

    def __init__(self, spark: SparkSession, root: str, layout: T.StructType):
        self.spark, self.root, self.layout = spark, root.rstrip("/"), layout

    def current(self) -> dict[str, tuple[str, int]]:
        """Path and version of every part; an empty path is a part that was folded into another."""
        if not Folders(self.spark, f"{self.root}/_manifest").names():
            return {}
        newest = self.spark.read.schema(self._MANIFEST).parquet(f"{self.root}/_manifest").groupBy("part").agg(
            F.max(F.struct("version", "path")).alias("entry"))
        return {r.part: (r.entry.path, r.entry.version) for r in newest.collect()}

    def read(self, parts: list[str] | None = None) -> DataFrame:
        paths = [path for part, (path, _) in sorted(self.current().items()) if path and (parts is None or part in parts)]
        if not paths:
            return self.spark.createDataFrame([], self.layout)
        return self.spark.read.schema(self.layout).parquet(*paths)

    def _write(self, rows: DataFrame) -> tuple[str, int]:
        version = max((v for _, v in self.current().values()), default=0) + 1
        path = f"{self.root}/v{version:08d}-{uuid.uuid4().hex[:8]}"
        rows.select(*self.layout.names).write.parquet(path)
        return path, version

    def _publish(self, entries: list[tuple[str, str, int]]) -> None:
        inline_rows(self.spark, entries, self._MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/_manifest")

    def replace(self, part: str, rows: DataFrame) -> None:
        path, version = self._write(rows)
        self._publish([(part, path, version)])

    def folded(self) -> set[str]:
        return {part for part, (path, _) in self.current().items() if not path}

    def fold(self, parts: list[str], merge) -> str:
        """Merge ``parts`` into one new part and return its name; ``merge`` takes their rows together."""
        name = f"{min(parts)}..{max(parts)}"
        path, version = self._write(merge(self.read(parts)))
        self._publish([(name, path, version), *((part, "", version) for part in parts)])
        return name
