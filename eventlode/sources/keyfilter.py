"""Bloom filters of stored keys, a set for every load, so that a load of new keys reads no stored key.

A filter is cut into blocks of 4 KB. The hash of a key names its block, further hashes name bits in it. Blocks are built by
one aggregate over rows dealt by block, and checked by a join on the block, so neither ever sits in one task as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventlode.sources.batches import Folders

BLOCK_BITS = 32_768
# Bits and probes for each key: about two in a thousand million keys that are not stored look as if they were.
KEY_BITS, PROBES = 48, 16


def block_count(keys: int, key_bits: int = KEY_BITS) -> int:
    """Blocks of a filter, a power of two, so that filters of many loads come in few sizes."""
    return 1 << max(0, (max(1, keys) * key_bits - 1) // BLOCK_BITS).bit_length()


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _place(key: str, probe: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(probe)), F.lit(BLOCK_BITS))


def _holds(bits: str, place: str) -> Column:
    return F.expr(f"shiftright(cast(conv(hex(substring({bits}, cast({place} div 8 as int) + 1, 1)), 16, 10) as int), "
                  f"cast({place} % 8 as int)) & 1 = 1")


class KeyFilters:
    """The filters of one table's loads."""

    _ROWS = T.StructType().add("blocks", "long").add("block", "long").add("bits", "binary").add("load", "string")

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path, key

    def _rows(self) -> DataFrame:
        if not Folders(self.spark, self.path).names():
            return self.spark.createDataFrame([], self._ROWS)
        return self.spark.read.schema(self._ROWS).parquet(self.path)

    def loads(self) -> set[str]:
        """The loads that have a filter."""
        return {r.load for r in self._rows().select("load").distinct().collect()}

    def add(self, keys: DataFrame, count: int, load: str) -> None:
        """Record the keys of a load. To be called before its rows are stored: a filter may name keys that never came,
        but must not miss one that did."""
        blocks = block_count(count)
        probes = F.explode(F.array(*[_place(self.key, n) for n in range(PROBES)]))
        marked = keys.select(_block(self.key, blocks).alias("block"), probes.alias("place")).repartition("block")
        rows = marked.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))
        rows.select(F.lit(blocks).cast("long").alias("blocks"), "block", "bits", F.lit(load).alias("load")).write.mode(
            "append").partitionBy("load").parquet(self.path)

    def possible(self, keys: DataFrame) -> DataFrame:
        """(key, load) for every key that the load may have stored. Those left out it has certainly not."""
        rows = self._rows()
        sizes = sorted(r.blocks for r in rows.select("blocks").distinct().collect())
        if not sizes:
            return keys.select(self.key).where(F.lit(False)).withColumn("load", F.lit(""))
        places = {f"_p{n}": _place(self.key, n) for n in range(PROBES)}
        asked = keys.select(self.key).distinct().withColumns(places).withColumn(
            "_at", F.explode(F.array(*[F.struct(F.lit(s).cast("long").alias("blocks"), _block(self.key, s).alias("block")) for s in sizes])))
        found = asked.select("*", "_at.blocks", "_at.block").join(rows, ["blocks", "block"])
        for place in places:
            found = found.where(_holds("bits", place))
        return found.select(self.key, "load")
