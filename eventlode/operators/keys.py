"""Surrogate keys without a sequence and without a single sorting task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def assign_keys(rows: DataFrame, natural_key: str, key: str, start_after: int = 0,
                digits: int = 4) -> DataFrame:
    """Number rows ``start_after + 1, + 2, …`` densely, in the order of the hash of a unique key.

    The first hash digits name a bucket, so buckets are even whatever the keys look like. Bucket
    sizes (at most 16 ** digits rows) give each bucket its offset; inside a bucket rows are counted
    in hash order. The numbers depend on the rows alone: recomputing a lost task, or changing the
    cluster, gives the same ones. Rows are read twice, so ``rows`` must be repeatable.
    """
    hashed = rows.withColumn("_hash", F.md5(F.col(natural_key).cast("string").cast("binary"))).withColumn(
        "_bucket", F.substring("_hash", 1, digits)
    )
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_bucket").alias("_offset_bucket"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", natural_key))
    numbered = hashed.withColumn("_position", position).join(
        F.broadcast(offsets), F.col("_bucket") == F.col("_offset_bucket"), "inner"
    )
    return numbered.withColumn(
        key, (F.lit(start_after) + F.col("_offset") + F.col("_position")).cast("bigint")
    ).drop("_hash", "_bucket", "_offset_bucket", "_offset", "_position")


def highest_key(table: DataFrame, key: str) -> int:
    """The largest key in use, or zero: one value, computed by the executors."""
    return table.agg(F.max(key)).first()[0] or 0
