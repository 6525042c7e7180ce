"""Where the warehouse tables live: versioned Parquet folders, or a database over JDBC."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlode.functions.inline import inline_rows
from eventlode.session import materialize
from eventlode.sources.batches import Folders
from eventlode.sources.keyfilter import KeyFilters
from eventlode.sources.ledger import KeyLedger


def path_missing(error: AnalysisException) -> bool:
    """True only for "there is no such path"; every other failure must surface."""
    return error.getCondition() == "PATH_NOT_FOUND"


def write_partitioned(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "append") -> None:
    """Write Parquet with files of an even size.

    The rebalance hint gathers each partition value into few files and splits a value that holds far
    more rows than the others, which a plain repartition by that column would send to one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


class ParquetStore:
    """Named tables under one root folder.

    Replacing a table writes a new folder and then appends one row to the manifest, so readers see
    the old rows or the new ones and a failed write changes nothing. Nothing is deleted; folders no
    manifest row points to may be removed by the operator of the store.
    """

    _MANIFEST = T.StructType().add("name", "string").add("path", "string").add("version", "long")

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(self._MANIFEST).parquet(f"{self.root}/_manifest_rows")
        except AnalysisException as error:
            if not path_missing(error):
                raise
            return self.spark.createDataFrame([], self._MANIFEST)

    def _current(self, name: str) -> tuple[str | None, int]:
        row = (
            self._manifest().where(F.col("name") == name)
            .agg(F.max_by("path", "version").alias("path"), F.max("version").alias("version")).first()
        )
        return row["path"], row["version"] or 0

    def exists(self, name: str) -> bool:
        return self._current(name)[0] is not None

    def read(self, name: str, layout: T.StructType | None = None) -> DataFrame:
        """The table's current rows; an absent table reads as empty when its layout is given."""
        path, _ = self._current(name)
        if path is None:
            if layout is None:
                raise KeyError(f"no table {name} under {self.root}")
            return self.spark.createDataFrame([], layout)
        reader = self.spark.read if layout is None else self.spark.read.schema(layout)
        return reader.parquet(path)

    def overwrite(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        self._replace(name, df, partition_by, self._current(name)[1] + 1)

    def append(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        path, version = self._current(name)
        if path is None:
            self._replace(name, df, partition_by, version + 1)
        else:
            write_partitioned(df, path, partition_by)

    def _replace(self, name: str, df: DataFrame, partition_by: tuple[str, ...], version: int) -> None:
        path = f"{self.root}/{name}/v{version:08d}-{uuid.uuid4().hex[:8]}"
        write_partitioned(df, path, partition_by)
        self._publish(name, path, version)

    def _publish(self, name: str, path: str, version: int) -> None:
        entry = inline_rows(self.spark, [(name, path, version)], self._MANIFEST)
        entry.write.mode("append").parquet(f"{self.root}/_manifest_rows")


class BucketedTable:
    """An append-only table bucketed by its unique key, with filters and key ranges of its loads beside it.

    A load looks up its keys among all stored ones. Bucketing lets that join read the stored key
    column in place: only the day's rows are shuffled, never the history.
    """

    def __init__(self, spark: SparkSession, path: str, layout: T.StructType, key: str, partition: str,
                 buckets: int = 1024):
        self.spark, self.path, self.key, self.partition, self.buckets = spark, path, key, partition, buckets
        self.layout = T.StructType(list(layout.fields)).add(partition, "string")
        self.name = "bucketed_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex
        self.filters = KeyFilters(spark, f"{path}_filters", key)
        self.ledger = KeyLedger(spark, f"{path}_keys")
        self._register()

    def _register(self) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.layout.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
            f"PARTITIONED BY (`{self.partition}`) CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        try:
            self.spark.read.schema(self.layout).parquet(self.path)
        except AnalysisException as error:
            if not path_missing(error):
                raise
            return
        # The catalog may be newer than the files: pick up the partitions already there.
        self.spark.sql(f"MSCK REPAIR TABLE {self.name}")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def loads(self) -> set[str]:
        """The partitions that are stored, from the listing."""
        names = (name.partition("=") for name in Folders(self.spark, self.path).names())
        return {value for label, _, value in names if label == self.partition}

    def append(self, df: DataFrame) -> None:
        """Append rows; one file per bucket because the rows arrive split the way buckets are."""
        ordered = df.select(*self.layout.names).repartition(self.buckets, self.key)
        ordered.write.mode("append").insertInto(self.name)


class JdbcStore:
    """The same operations over a database. Reads are split when a numeric column is named."""

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str],
                 split: dict[str, tuple[str, int, int, int]] | None = None):
        self.spark, self.url, self.properties = spark, url, properties
        self.split = split or {}

    def read(self, name: str, layout: T.StructType | None = None) -> DataFrame:
        if name in self.split:
            column, lower, upper, parts = self.split[name]
            return self.spark.read.jdbc(self.url, name, column=column, lowerBound=lower, upperBound=upper,
                                        numPartitions=parts, properties=self.properties)
        return self.spark.read.jdbc(self.url, name, properties=self.properties)

    def exists(self, name: str) -> bool:
        """A database's tables are created by its own definitions, so they are there."""
        return True

    def overwrite(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        # The new rows often come from the table itself: compute them before it is emptied.
        df = materialize(df, f"replace-{name}")
        df.write.option("truncate", "true").jdbc(self.url, name, mode="overwrite", properties=self.properties)

    def append(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        df.write.jdbc(self.url, name, mode="append", properties=self.properties)


def read_partition(spark: SparkSession, path: str, date: str, layout: T.StructType) -> DataFrame:
    """One date of a date-partitioned table, pruned to that folder; no such table reads as empty."""
    try:
        table = spark.read.schema(layout).parquet(path)
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], layout)
    return table.where(F.col("date") == date)
