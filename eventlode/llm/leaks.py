"""Benchmark decontamination by latent semantic retrieval.

1. Texts are cut into passages of words. Over the benchmark's vocabulary their TF-IDF vectors form a matrix that is never
   stored: one pass over all texts sums document frequencies and the matrix's product with its transpose and a random
   test matrix. The leading eigenvectors follow from this sketch (a Nystrom form of the randomised SVD).
2. Passages and benchmark items are projected on these directions. Passages close to an item by cosine are candidates.
   So are those that repeat a run of an item's words, however frequent. For items that could leak by
   common words alone, which weigh little in the space, every passage with enough of their words is a candidate.
3. A candidate is confirmed if the longest common subsequence of words covers enough of the item, or somewhat less and
   its answer, the item's last sentence, is there too. Paraphrases keep the order of most words and pass.

The vectors are linear in the words, so a passage is the sum of its halves, and each half is projected once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, byte_texts, ids_and_texts, map_arrow, table, window_hashes

# Words in half a passage; passages overlap by half.
HALF = 16
# Directions kept, and test vectors beyond them.
RANK, EXTRA = 192, 16
# Cosine from which a passage is a candidate for an item.
LEAST_COSINE = 0.5
# Words in a larger share of the passages are common. Items that could leak by them alone are searched by counts, not cosine.
MOST_COMMON = 0.05
# Consecutive words of an item that make a passage a candidate; shorter items as a whole.
RUN = 5
# Items whose words are counted at once.
COUNTED_ITEMS = 64
# Shares of an item's words in common order: enough alone, and enough together with the answer's share.
LEAST_COMMON, LEAST_WITH_ANSWER, LEAST_ANSWER = 0.6, 0.45, 0.8
# Benchmark items compared at once. More are processed in blocks of this size.
BLOCK_ITEMS = 5_000


def _words(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, with one bit per element of ``a``."""
    masks: dict = {}
    for k, x in enumerate(a):
        masks[x] = masks.get(x, 0) | (1 << k)
    every = (1 << len(a)) - 1
    row = every
    for x in b:
        hit = row & masks.get(x, 0)
        row = ((row + hit) | (row - hit)) & every
    return len(a) - row.bit_count()


def answer_of(text: bytes) -> list[bytes]:
    """The words of the last sentence."""
    parts = [p for p in re.split(rb"(?<=[.!?])\s+", text.strip()) if p]
    return _words(parts[-1]) if parts else []


@dataclass
class Space:
    """The semantic space of a block of items. Its size depends on the block alone."""

    ids: dict[bytes, int]  # vocabulary
    weights: np.ndarray
    directions: np.ndarray  # words x rank
    items: list[tuple[int, list[bytes], list[bytes]]]  # id, words, answer
    vectors: np.ndarray  # items x rank, unit length
    common: np.ndarray  # items that could leak by common words alone


def _all_ids(words: list[bytes], ids: dict[bytes, int]) -> np.ndarray:
    """Ids of the words, -1 outside the vocabulary."""
    return np.fromiter(map(ids.get, words, repeat(-1)), np.int64, len(words))


def _token_ids(words: list[bytes], ids: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words in the vocabulary, and their places."""
    found = _all_ids(words, ids)
    places = np.flatnonzero(found >= 0)
    return found[places], places


class Runs:
    """Runs of consecutive words of the items, by hash. Collisions only give candidates that are then refused."""

    def __init__(self, space: Space):
        by_size: dict[int, list[tuple[int, int]]] = {}
        for k, (_, words, _) in enumerate(space.items):
            size = min(RUN, len(words))
            hashes = window_hashes(_all_ids(words, space.ids).astype(np.uint64), size)
            by_size.setdefault(size, []).extend((int(h), k) for h in np.unique(hashes))
        self.by_size = []
        for size, pairs in by_size.items():
            pairs.sort()
            self.by_size.append((size, np.array([h for h, _ in pairs], np.uint64), np.array([k for _, k in pairs], np.int64)))

    def find(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, item) of every run of an item in the word ids ``found``."""
        places, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        known = np.concatenate([[0], np.cumsum(found >= 0)])
        for size, hashes, owners in self.by_size:
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            own = window_hashes(found.astype(np.uint64), size)[at]
            first = np.searchsorted(hashes, own)
            hit = np.flatnonzero(hashes[np.minimum(first, len(hashes) - 1)] == own)
            first, at = first[hit], at[hit]
            many = np.searchsorted(hashes, own[hit], "right") - first
            within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            places.append(np.repeat(at, many))
            items.append(owners[np.repeat(first, many) + within])
        return np.concatenate(places), np.concatenate(items)


def counted(space: Space, flat: np.ndarray, row: np.ndarray, halves: int) -> Iterator[tuple[np.ndarray, int]]:
    """(passages, item) that may hold enough words of a common item, from the words ``flat`` of the halves ``row``."""
    first = np.flatnonzero(np.diff(row, prepend=-1))
    for lo in range(0, len(space.common), COUNTED_ITEMS):
        own = space.common[lo : lo + COUNTED_ITEMS]
        member = np.zeros((len(space.ids), len(own)), np.float32)
        for c, k in enumerate(own):
            member[[space.ids[w] for w in space.items[k][1]], c] = 1
        sums = np.zeros((halves + 1, len(own)), np.int64)
        sums[row[first] + 1] = run_sums(member, flat, first)
        np.cumsum(sums, axis=0, out=sums)
        for c, k in enumerate(own):
            # The halves that the passage and an item's length on both sides touch.
            reach = -(-len(space.items[k][1]) // HALF)
            at = np.arange(halves)
            words = sums[np.minimum(at + 2 + reach, halves), c] - sums[np.maximum(at - reach, 0), c]
            yield np.flatnonzero(words >= LEAST_WITH_ANSWER * len(space.items[k][1])), int(k)


# Runs longer than this are summed in pieces; rows summed at once, few enough to stay in a core's cache.
PIECE, ROWS_AT_ONCE = 32, 1_024


def run_sums(vectors: np.ndarray, index: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of ``vectors[index]`` over each run of ``index``; runs begin at ``first``.

    The k-th members of many runs are added at once, longest runs first, so that no run needs padding.
    """
    pieces, sizes = first, np.diff(np.append(first, len(index)))
    if sizes.max() > PIECE:
        pieces = np.union1d(first, np.arange(0, len(index), PIECE))
        sizes = np.diff(np.append(pieces, len(index)))
    order = np.argsort(-sizes, kind="stable")
    out = np.empty((len(pieces), vectors.shape[1]), vectors.dtype)
    for lo in range(0, len(order), ROWS_AT_ONCE):
        own = order[lo : lo + ROWS_AT_ONCE]
        at, shorter = pieces[own], -sizes[own]
        sums = vectors[index[at]]
        for k in range(1, -shorter[0]):
            held = np.searchsorted(shorter, -k)
            sums[:held] += vectors[index[at[:held] + k]]
        out[own] = sums
    return out if len(pieces) == len(first) else np.add.reduceat(out, np.searchsorted(pieces, first), axis=0)


def _sketch(docs: DataFrame, ids: dict[bytes, int], test: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums over passages that don't overlap: (T'T test, passage frequencies, passages), T telling which words occur.

    The sums have the size of the vocabulary times the test vectors. They are added up in partitions and then once more.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ids, test.astype(np.float32)))
    size, columns = test.shape

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, omega = shared.value
        total, seen, passages = np.zeros((size, columns)), np.zeros(size, np.int64), 0
        for batch in items:
            rows, words, at = [], [], 0
            for raw in byte_texts(batch.column("text")):
                tokens = _words(raw)
                own, places = _token_ids(tokens, known)
                rows.append(at + places // (2 * HALF))
                words.append(own)
                at += -(-len(tokens) // (2 * HALF))
            passages += at
            # One entry per passage and word: whether it occurs.
            pairs = np.unique(np.concatenate(rows) * size + np.concatenate(words)) if rows else np.zeros(0, np.int64)
            if not len(pairs):
                continue
            row, word = pairs // size, pairs % size
            seen += np.bincount(word, minlength=size)
            first = np.flatnonzero(np.diff(row, prepend=-1))
            sums = run_sums(omega, word, first)
            back = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(row))))
            order = np.argsort(word, kind="stable")
            starts = np.flatnonzero(np.diff(word[order], prepend=-1))
            total[word[order][starts]] += run_sums(sums, back[order], starts)
        yield batches({"part": pa.array([total.astype(np.float32).tobytes()], pa.binary()), "seen": pa.array([seen.tobytes()], pa.binary()), "n": pa.array([passages], pa.int64())})

    def add(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, passages = np.zeros(size * columns), np.zeros(size, np.int64), 0
        for batch in items:
            for part, counts, n in zip(*(batch.column(c).to_pylist() for c in ("part", "seen", "n")), strict=True):
                total += np.frombuffer(part, np.float32)
                seen += np.frombuffer(counts, np.int64)
                passages += n
        yield batches({"part": pa.array([total.astype(np.float32).tobytes()], pa.binary()), "seen": pa.array([seen.tobytes()], pa.binary()), "n": pa.array([passages], pa.int64())})

    schema = "part binary, seen binary, n long"
    parts = map_arrow(docs.select("text"), run, schema)
    # A tree of sums: a handful of tables reach the driver, however many tasks there are.
    total, seen, passages = np.zeros(size * columns), np.zeros(size, np.int64), 0
    for row in map_arrow(parts.repartition(4), add, schema).collect():
        total += np.frombuffer(row.part, np.float32)
        seen += np.frombuffer(row.seen, np.int64)
        passages += row.n
    return total.reshape(size, columns), seen, passages


def fit(docs: DataFrame, items: list[tuple[int, bytes]], rank: int = RANK, extra: int = EXTRA, seed: int = 0) -> Space:
    """The space of the items, from all texts of ``docs``."""
    split = [(i, _words(t), answer_of(t)) for i, t in items]
    split = [x for x in split if x[1]]
    ids: dict[bytes, int] = {}
    for _, words, _ in split:
        for w in words:
            ids.setdefault(w, len(ids))
    size = max(1, len(ids))
    test = np.random.default_rng(seed).standard_normal((size, min(rank + extra, size)))
    sums, seen, passages = _sketch(docs, ids, test)
    # The items count as passages too, so that their words never vanish from the space.
    sums, seen = sums.copy(), seen.copy()
    for _, words, _ in split:
        own = np.unique([ids[w] for w in words])
        sums[own] += test[own].sum(axis=0)
        seen[own] += 1
    idf = np.log((passages + len(split) + 1) / (seen + 1))
    # Squared, so that the rare words decide. Every word keeps a weight, which D below needs.
    weights = np.maximum(idf**2, 1e-3)
    often = seen > MOST_COMMON * (passages + len(split))
    common = [k for k, (_, words, _) in enumerate(split) if np.count_nonzero(often[[ids[w] for w in words]]) >= LEAST_WITH_ANSWER * len(words)]
    # With D = diag(weights) and M = D T'T D: M applied to the test matrix inverse(D) test is D times the sums.
    applied = weights[:, None] * sums
    core = test.T @ sums
    core = (core + core.T) / 2
    shift = 1e-6 * max(1e-12, np.trace(core) / len(core))
    lower = np.linalg.cholesky(core + (shift + max(0.0, -np.linalg.eigvalsh(core)[0])) * np.eye(len(core)) * (1 + 1e-3))
    directions = np.linalg.svd(np.linalg.solve(lower, applied.T).T, full_matrices=False)[0][:, :rank]
    vectors = np.array([(weights[[ids[w] for w in words], None] * directions[[ids[w] for w in words]]).sum(axis=0) for _, words, _ in split])
    vectors = vectors.reshape(len(split), directions.shape[1])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return Space(ids, weights, directions, split, vectors.astype(np.float32), np.array(common, np.int64))


_FOUND = "doc_id long, item_id long, start_word long, cosine double, common double, answer double, leaked boolean"


def search(docs: DataFrame, space: Space, least_cosine: float = LEAST_COSINE) -> DataFrame:
    """For each text and item it has candidate passages of, a passage that leaks, or else that with the longest common
    subsequence; of several that leak, the longest's."""
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def best(words: list[bytes], hits: list[tuple[int, int, float]], s: Space, held: list[set[bytes]]) -> Iterator[tuple]:
        by_item: dict[int, tuple] = {}
        for half, k, cosine in hits:
            _, item, answer = s.items[k]
            # The passage and, on both sides, as many words as the item has.
            start = max(0, half * HALF - len(item))
            part = [w for w in words[start : half * HALF + 2 * HALF + len(item)] if w in held[k]]
            # No more words can be in common than there are words of the item.
            if len(part) < LEAST_WITH_ANSWER * len(item):
                continue
            common = common_length(item, part) / len(item)
            share = common_length(answer, part) / max(1, len(answer)) if common >= LEAST_WITH_ANSWER else 0.0
            leaked = common >= LEAST_COMMON or (common >= LEAST_WITH_ANSWER and share >= LEAST_ANSWER)
            if k not in by_item or (leaked, common) > by_item[k][:2]:
                by_item[k] = (leaked, common, start, cosine, share)
        for k, (leaked, common, start, cosine, share) in by_item.items():
            yield s.items[k][0], start, cosine, common, share, leaked

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        weighted = (s.weights[:, None] * s.directions).astype(np.float32)
        sequences = Runs(s)
        gap = np.full(RUN, -1)
        held = [set(item) for _, item, _ in s.items]
        for batch in items:
            texts = [_words(x) for x in byte_texts(batch.column("text"))]
            halves, tokens, rows, at = [], [], [], 0
            every, begins, length = [], [], 0
            for words in texts:
                found = _all_ids(words, s.ids)
                places = np.flatnonzero(found >= 0)
                tokens.append(found[places])
                rows.append(at + places // HALF)
                halves.append(at)
                every += [found, gap]
                begins.append(length)
                length += len(found) + RUN
                at += -(-len(words) // HALF) + 1
            flat = np.concatenate(tokens)
            out = []
            if len(flat):
                row = np.concatenate(rows)
                first = np.flatnonzero(np.diff(row, prepend=-1))
                sums = np.zeros((at + 1, weighted.shape[1]), np.float32)
                sums[row[first]] = run_sums(weighted, flat, first)
                passages = sums[:-1] + sums[1:]
                passages /= np.maximum(np.linalg.norm(passages, axis=1, keepdims=True), 1e-12)
                starts = np.array(halves)
                pairs = []
                for lo in range(0, len(passages), 4096):
                    near = np.argwhere(passages[lo : lo + 4096] @ s.vectors.T >= least_cosine)
                    pairs.append(near + [lo, 0])
                # Passages that begin with the half in which a run begins.
                places, k = sequences.find(np.concatenate(every))
                doc = np.searchsorted(begins, places, "right") - 1
                pairs.append(np.stack([starts[doc] + (places - np.array(begins)[doc]) // HALF, k], axis=1))
                pairs += [np.stack([p, np.full(len(p), k)], axis=1) for p, k in counted(s, flat, row, len(passages))]
                hits: dict[int, list] = {}
                for p, k in np.unique(np.concatenate(pairs), axis=0):
                    doc = int(np.searchsorted(starts, p, "right")) - 1
                    hits.setdefault(doc, []).append((int(p - starts[doc]), int(k), float(passages[p] @ s.vectors[k])))
                ids = batch.column("doc_id").to_pylist()
                out = [(ids[doc], *x) for doc, own in hits.items() for x in best(texts[doc], own, s, held)]
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_())
            names = ("doc_id", "item_id", "start_word", "cosine", "common", "answer", "leaked")
            yield batches({n: pa.array(x, k) for n, x, k in zip(names, columns, kinds, strict=True)})

    return map_arrow(docs, run, _FOUND)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of bounded size, one block on the driver at a time."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("i"), F.encode(F.col(text_col), "utf-8").alias("t")).where("t is not null")
    block = []
    for row in rows.orderBy("i", "t").toLocalIterator():
        block.append((row.i, bytes(row.t)))
        if len(block) == BLOCK_ITEMS:
            yield block
            block = []
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """One row per document and item that it leaks: doc_id, item_id, start_word, cosine, common, answer, leaked (true).

    Null and empty texts or items give no rows. Repeated documents give a row each, null ids keep their rows. An empty
    benchmark or an empty table gives an empty result.
    """
    base = ids_and_texts(docs, id_col, text_col)
    found = None
    for block in _blocks(benchmark, item_col, item_text_col):
        if any(t.split() for _, t in block):
            part = search(base, fit(base, block)).where("leaked")
            found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], _FOUND) if found is None else found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a leak, all columns as they were. Rows with a null id stay."""
    leaks = find_leaks(docs, benchmark, id_col, text_col)
    ids = leaks.select(F.col("doc_id").alias(id_col)).where(F.col(id_col).isNotNull()).distinct()
    return docs.join(ids, id_col, "left_anti")


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
