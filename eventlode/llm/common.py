"""Helpers shared by the training-data operators.

Words are runs of anything but space and the control characters 0x09-0x0D. ``bytes.split()`` cuts at exactly these six
bytes and ``bytes.lower()`` changes only A-Z, so texts are handled as UTF-8 bytes inside tasks.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Entries a per-task word cache may hold before it is emptied (about 100 MB).
CACHE_WORDS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so that no other column of the input can clash with its own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def byte_texts(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


class WordHashes(dict):
    """64-bit hash of a word, remembered. ``of`` empties the memory when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash for each run of ``size`` consecutive words, from the words' hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
        out ^= out >> np.uint64(32)
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Boolean mask of the ``n`` positions inside one of the spans [start, start + length)."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + length, n), -1)
    return np.cumsum(marks[:-1]) > 0


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from the concatenated values and the rows' lengths."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def batches(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


# Rows handed to Python at once. Texts may be long, and a task holds a batch several times over.
BATCH_ROWS = 1_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def give_back() -> None:
    """Hand freed memory back to the system. Workers are used again by later stages, and would hold it meanwhile."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` that skips empty batches and keeps batches small, in this session from now on."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_CONF)) <= BATCH_ROWS:
        conf.set(_BATCH_CONF, str(BATCH_ROWS))

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(x for x in items if x.num_rows)
        give_back()

    return df.mapInArrow(run, schema)


# log2 of the flags in an id filter. With more ids more rows pass that a join then drops; results stay the same.
FILTER_BITS = 23


def id_slot(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))


def id_filter(ids: DataFrame):
    """A broadcast boolean array of fixed size: true at the ``id_slot`` of every id of ``ids`` (id), and of some others.

    It spares most texts a shuffle to a join on their ids. Bitmaps of 4 KB are built by an aggregate, so at most
    2^FILTER_BITS bits reach the driver, however many ids there are.
    """
    bit = id_slot("id")
    parts = (ids.select((bit / F.lit(32768)).cast("int").alias("part"), (bit % F.lit(32768)).cast("int").alias("bit"))
             .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = np.zeros(1 << FILTER_BITS, np.bool_)
    for row in parts:
        flags = np.unpackbits(np.frombuffer(row.bits, np.uint8), bitorder="little")
        out[row.part * 32768 : row.part * 32768 + len(flags)] |= flags.astype(np.bool_)
    return ids.sparkSession.sparkContext.broadcast(out)


def flagged(batch: pa.RecordBatch, flags) -> np.ndarray:
    return flags.value[batch.column("slot").to_numpy(zero_copy_only=False)]


def only_flagged(df: DataFrame, flags) -> DataFrame:
    """The rows (with a ``slot``) that pass an id filter, without the slot."""
    kept = df.drop("slot")
    names = kept.columns

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            yield batch.filter(pa.array(flagged(batch, flags))).select(names)

    return map_arrow(df, run, kept.schema)
