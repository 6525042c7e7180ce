"""Removal of repeated word sequences, by suffix trees over prefix partitions.

A window is ``size`` consecutive words. A window that also starts earlier in the corpus is removed with all its words.

1. Exact copies of whole texts are found by a digest; only the first text of each takes part in the rest.
2. In each window the least hash of its ``PREFIX``-word grams marks an anchor. Equal windows have equal anchors in equal
   places, so windows whose anchor occurs once in the corpus are unique, and their words are never moved.
3. The suffixes that start in the other windows are partitioned by prefixes of variable length: by their anchor's words
   if it has few occurrences, by the whole window otherwise. A task drops all but the first of equal windows of its own
   before that, so a sequence that very many documents share reaches a partition once per batch read.
4. In each partition suffixes are sorted, with the lengths of the prefixes that neighbours share: the suffix tree in
   flat form. Its internal nodes at the depth of a window are the repeats; all but their first leaf are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlode.session import materialize

from .common import (WordHashes, batches, byte_texts, covered, flagged, id_filter, id_slot, ids_and_texts, map_arrow, mix, only_flagged,
                     signed, table, window_hashes)

PREFIX = 8
# Occurrences of an anchor above which its suffixes are split by longer prefixes.
FEW = 5_000
# Candidate windows compared within a task at once.
BLOCK_WINDOWS = 150_000


def window_anchors(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the position of its anchor, and the grams' hashes. The leftmost of equal hashes is the anchor."""
    grams = window_hashes(words, PREFIX)
    if len(words) < size:
        return np.zeros(0, np.int64), grams
    at = np.argmin(sliding_window_view(grams, size - PREFIX + 1), axis=1)
    return at + np.arange(len(at)), grams


def _anchor_rows(docs: DataFrame, size: int, flags=None) -> DataFrame:
    """(anchor, doc_id, n): the anchors of each text and how often they occur in it. Flagged texts are passed over."""

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in items:
            if flags is not None:
                batch = batch.filter(pa.array(~flagged(batch, flags)))
            found, counts, lengths = [], [], []
            for raw in byte_texts(batch.column("text")):
                places, grams = window_anchors(hashes.of(raw.split()), size)
                own, n = np.unique(grams[np.unique(places)], return_counts=True)
                found.append(own)
                counts.append(n)
                lengths.append(len(own))
            if found:
                ids = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), lengths)
                yield batches({"anchor": pa.array(signed(np.concatenate(found))), "doc_id": pa.array(ids, pa.int64()),
                               "n": pa.array(np.concatenate(counts), pa.int32())})

    return map_arrow(docs, run, "anchor long, doc_id long, n int")


def _runs(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, count) of each run of consecutive numbers in a sorted array."""
    if len(starts):
        cuts = np.flatnonzero(np.diff(starts) != 1) + 1
        for part in np.split(starts, cuts):
            yield int(part[0]), len(part)


# Rows of the candidate table: suffixes to compare have words, windows already known as repeats have none.
_SUFFIX = "key long, doc_id long, start int, n int, words binary"


def _suffix_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return batches({n: pa.array(x, k) for n, x, k in zip(("key", "doc_id", "start", "n", "words"), columns, kinds, strict=True)})


def _candidates(docs: DataFrame, size: int) -> DataFrame:
    """Suffixes of the windows with repeated anchors, from (doc_id, text, anchors, many)."""

    def first_of_equal(block: list) -> list[np.ndarray]:
        """For each text of the block, which of its candidate windows are the block's first of their sequence."""
        one, two, ids, starts = (np.concatenate([x[k] for x in block]) for k in (2, 3, 5, 4))
        order = np.lexsort((starts, ids, two, one))
        one, two = one[order], two[order]
        new = np.ones(len(order), np.bool_)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        # The same place twice, from repeated rows of one document, is not a repeat.
        lead = order[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        same = (ids[order] == ids[lead]) & (starts[order] == starts[lead])
        first = np.zeros(len(order), np.bool_)
        first[order] = new | same
        return np.split(first, np.cumsum([len(x[4]) for x in block])[:-1])

    def rows_of(block: list) -> list[tuple]:
        rows = []
        for (doc_id, words, one, _, starts, _, places, keys, many), first in zip(block, first_of_equal(block), strict=True):
            rows += [(None, doc_id, s, n, None) for s, n in _runs(starts[~first])]
            light = first & ~many
            for k in np.flatnonzero(first & many):
                s = int(starts[k])
                rows.append((int(signed(one[k : k + 1])[0]), doc_id, s, 1, b" ".join(words[s : s + size])))
            # Windows that follow each other and have the same anchor share a row.
            at = np.flatnonzero(light)
            cuts = np.flatnonzero((np.diff(starts[at]) != 1) | (np.diff(places[at]) != 0)) + 1
            for part in np.split(at, cuts) if len(at) else []:
                s, n = int(starts[part[0]]), len(part)
                rows.append((int(keys[part[0]]), doc_id, s, n, b" ".join(words[s : s + n + size - 1])))
        return rows

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, block, held = WordHashes(), [], 0
        for batch in items:
            hot, many = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchors", "many"))
            for k, (doc_id, raw) in enumerate(zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), strict=True)):
                words = raw.split()
                ids = hashes.of(words)
                places, grams = window_anchors(ids, size)
                own = signed(grams[places])
                starts = np.flatnonzero(np.isin(own, hot[k]))
                if len(starts):
                    one = window_hashes(ids, size)[starts]
                    two = window_hashes(mix(ids ^ np.uint64(0x5851F42D4C957F2D)), size)[starts]
                    block.append((doc_id, words, one, two, starts, np.full(len(starts), doc_id), places[starts], own[starts], np.isin(own[starts], many[k])))
                    held += len(starts)
                if held > BLOCK_WINDOWS:
                    yield _suffix_batch(rows_of(block))
                    block, held = [], 0
        if block:
            yield _suffix_batch(rows_of(block))

    return map_arrow(docs, run, _SUFFIX)


def repeated_leaves(suffixes: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of the suffixes below deep internal nodes that aren't their node's first leaf.

    ``suffixes`` holds word ids, one row per suffix, cut at the depth of a window. Sorting them and comparing neighbours
    gives the tree in flat form: a run of neighbours that share the whole depth is an internal node at that depth.
    """
    order = np.lexsort((starts, docs, *suffixes.T[::-1]))
    shared = np.zeros(len(order), np.int64)
    same = np.ones(len(order) - 1, np.bool_)
    for column in suffixes.T:
        same &= column[order[1:]] == column[order[:-1]]
        shared[1:] += same
    new = shared < suffixes.shape[1]
    lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    again = ~new & ((docs[order] != docs[lead]) | (starts[order] != starts[lead]))
    return order[again]


def _repeats(suffixes: DataFrame, size: int) -> DataFrame:
    """(doc_id, start, n): windows that also start earlier, from suffix rows sorted by key within partitions."""

    def found(rows: list[tuple]) -> Iterator[tuple]:
        seen: dict[bytes, int] = {}
        parts, docs, starts = [], [], []
        for _, doc_id, start, n, words in rows:
            ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words.split(b" ")), np.int32, n + size - 1)
            parts.append(sliding_window_view(ids, size))
            docs.append(np.full(n, doc_id))
            starts.append(np.arange(start, start + n))
        docs, starts = np.concatenate(docs), np.concatenate(starts)
        again = np.sort(repeated_leaves(np.concatenate(parts), docs, starts))
        # A row's windows stay together in this order.
        cuts = np.flatnonzero((np.diff(again) != 1) | (np.diff(docs[again]) != 0) | (np.diff(starts[again]) != 1)) + 1
        for part in np.split(again, cuts) if len(again) else []:
            yield int(docs[part[0]]), int(starts[part[0]]), len(part)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found(rows), strict=True)) or [(), (), ()]
        return batches({n: pa.array(x, k) for n, x, k in zip(("doc_id", "start", "n"), columns, (pa.int64(), pa.int32(), pa.int32()), strict=True)})

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        windows = 0
        for batch in items:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "start", "n", "words")), strict=True):
                # Whole groups only: the rows of a key stay together.
                if windows > BLOCK_WINDOWS and row[0] != held[-1][0]:
                    yield out(held)
                    held, windows = [], 0
                held.append(row)
                windows += row[3]
        if held:
            yield out(held)

    return map_arrow(suffixes.repartition("key").sortWithinPartitions("key"), run, "doc_id long, start int, n int")


def _kept(docs: DataFrame, size: int, texts: bool, flags=None) -> DataFrame:
    """Result rows from (doc_id, text, spans, copy), or from unflagged (doc_id, text, slot), of which nothing goes."""

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            if flags is not None:
                batch = batch.filter(pa.array(~flagged(batch, flags)))
            spans = [None] * batch.num_rows if flags is not None else batch.column("spans").to_pylist()
            copies = [None] * batch.num_rows if flags is not None else batch.column("copy").to_pylist()
            total, removed, digests, kept_texts = [], [], [], []
            for raw, marks, copy in zip(byte_texts(batch.column("text")), spans, copies, strict=True):
                words = raw.split()
                gone = np.zeros(len(words), np.bool_)
                if copy and len(words) >= size:
                    gone[:] = True
                for m in marks or ():
                    gone[m["start"] : m["start"] + m["n"] + size - 1] = True
                kept = b" ".join([w for w, g in zip(words, gone, strict=True) if not g] if gone.any() else words)
                total.append(len(words))
                removed.append(int(np.count_nonzero(gone)))
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept if texts else None)
            yield batches({"doc_id": batch.column("doc_id"), "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                           "kept_sha256": pa.array(digests, pa.string()), "kept": pa.array(kept_texts, pa.binary()).cast(pa.string())})

    return map_arrow(docs, run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def remove_repeats(docs: DataFrame, size: int = 20, texts: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and ``kept``, the words that stay joined by spaces.

    Earlier means a smaller id, or the same id and a smaller start; windows are judged on the input. Null and empty texts
    have no words; shorter texts than a window stay whole. Rows with the same id count as one document. Rows with a null
    id have no place in the order: they stay whole and remove nothing. ``kept`` is null unless ``texts``. An empty table
    gives an empty result.
    """
    if size <= PREFIX:
        raise ValueError(f"windows need more than {PREFIX} words")
    given = ids_and_texts(docs, id_col, text_col)
    named = given.where("doc_id is not null")
    digests = named.where("text is not null").select("doc_id", F.sha2("text", 256).alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = materialize(digests.join(firsts.select("digest", "first"), "digest").where("doc_id > first").select("doc_id").distinct(), "repeats-copies")

    slotted = named.withColumn("slot", id_slot("doc_id"))
    copy_flags = id_filter(copies.select(F.col("doc_id").alias("id")))
    doubtful = only_flagged(slotted, copy_flags).join(copies, "doc_id", "left_anti")
    anchors = materialize(_anchor_rows(slotted, size, copy_flags).unionByName(_anchor_rows(doubtful, size)), "repeats-anchors")
    counts = anchors.groupBy("anchor").agg(F.sum("n").alias("all")).where("all > 1")
    hot = anchors.select("anchor", "doc_id").join(counts, "anchor").groupBy("doc_id").agg(
        F.collect_list("anchor").alias("anchors"), F.array_compact(F.collect_list(F.when(F.col("all") > FEW, F.col("anchor")))).alias("many"))
    hot = materialize(hot, "repeats-hot")

    hot_flags = id_filter(hot.select(F.col("doc_id").alias("id")))
    shared = only_flagged(slotted, hot_flags).join(hot, "doc_id")
    rows = materialize(_candidates(shared, size), "repeats-suffixes")
    known = rows.where("words is null").select("doc_id", "start", "n")
    found = known.unionByName(_repeats(rows.where("words is not null"), size))
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    marks = materialize(spans.join(copies.withColumn("copy", F.lit(True)), "doc_id", "full"), "repeats-marks")

    mark_flags = id_filter(marks.select(F.col("doc_id").alias("id")))
    touched = only_flagged(slotted, mark_flags).join(marks, "doc_id", "left")
    whole = given.where("doc_id is null").withColumns({"spans": F.lit(None).cast("array<struct<start:int,n:int>>"), "copy": F.lit(False)})
    return _kept(slotted, size, texts, mark_flags).unionByName(_kept(touched.unionByName(whole), size, texts))


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), texts=False).drop("kept")
