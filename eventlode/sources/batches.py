"""Small tables that a stream replaces with every batch: a folder per batch, of which only the newest few stay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


class Folders:
    """The children of one folder, through the file system the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path.rstrip("/")
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def names(self) -> list[str]:
        return [x.getPath().getName() for x in self._fs.listStatus(self._root)] if self._fs.exists(self._root) else []

    def holds(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def rename(self, name: str, to: str) -> None:
        """Move a child; its parent folder is made where it is missing."""
        self._fs.mkdirs(self._at(to).getParent())
        if not self._fs.rename(self._at(name), self._at(to)):
            raise OSError(f"could not rename {name} to {to} under {self.path}")


class BatchFolders:
    """The state a stream leaves after each batch, as ``batch=<number>`` folders.

    A batch that is repeated replaces its own folder and is computed from the one before it, so its result is the same.
    A folder counts once it is complete. The last ``keep`` stay, for readers that have just picked one and for batches
    that are repeated after a crash; older ones are deleted, so neither a reader nor a batch meets more folders after a
    year than after a minute.
    """

    DONE = "_SUCCESS"

    def __init__(self, spark: SparkSession, path: str, layout: T.StructType, keep: int = 4):
        if keep < 2:
            raise ValueError("at least the newest two batches must stay")
        self.spark, self.layout, self.keep = spark, layout, keep
        self.folders = Folders(spark, path)

    def _numbers(self) -> list[int]:
        names = (name.partition("=") for name in self.folders.names())
        return sorted(int(number) for label, _, number in names if label == "batch" and number.isdigit())

    def newest(self, before: int | None = None) -> int | None:
        """The newest complete batch, or the newest of a smaller number than ``before``."""
        for number in reversed(self._numbers()):
            if (before is None or number < before) and self.folders.holds(f"batch={number}/{self.DONE}"):
                return number
        return None

    def read(self, before: int | None = None) -> DataFrame:
        """The rows of the newest batch; none if there is no batch. One folder is read."""
        number = self.newest(before)
        if number is None:
            return self.spark.createDataFrame([], self.layout)
        return self.spark.read.schema(self.layout).parquet(f"{self.folders.path}/batch={number}")

    def write(self, rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folders.path}/batch={number}")
        for old in self._numbers():
            if old <= number - self.keep:
                self.folders.delete(f"batch={old}")
