"""Language-model scores from Brown class n-grams.

Words belong to classes; a text's probability is that of its class transitions times that of each word given its class.
Every word that occurs often enough is assigned to a class by exchange: it is offered every class and takes the one that
makes its neighbours' classes and itself most likely, half of the words in each round, until rounds stop helping. All
other words share one class, in which they differ by their counts; the end of a text has its own.

Word counts cover the whole training corpus. The most frequent ones, a bounded table, are looked up inside tasks; the
counts of all others reach their texts by a join. Texts are turned into word ids once; pairs of neighbouring words are counted
from these into a table with a row per word, over which the rounds run without a shuffle of words. Pairs travel many to a row,
dealt into buckets by their words. The driver sees word classes and class pairs only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlode.session import materialize

from .common import batches, ids_and_texts, list_array, map_arrow, table

# Parameters of the model: words whose counts every task holds, the occurrences from which on these get a class by exchange,
# and the share by which two rounds must raise the classes' mutual information for more rounds to follow.
HEAD_WORDS = 200_000
LEAST_COUNT = 5
LEAST_GAIN = 0.02
# The end of a text, as a word; no word contains a space.
END = b" "
# Words a task gathers, and neighbouring words, before it hands their counts on; rows in a batch of these.
TASK_WORDS, TASK_PAIRS, COUNT_ROWS = 3_000_000, 2_000_000, 100_000
# Neighbours of a word travel and are added up in one of so many buckets; those of a word with more occurrences than this in
# several, by neighbour.
BUCKETS, BUCKET_WORDS = 4_096, 4_000_000


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after the other, and the row of each. Null texts have none.

    Both kernels work on bytes: words are cut at the six bytes at which ``bytes.split`` cuts, and A-Z are lowered. The second
    takes the wrong bytes of a sliced column, so it gets the words, which are a new one.
    """
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    words, lengths = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False)
    filled = pc.greater(pc.binary_length(words), 0)
    return pc.ascii_lower(words.filter(filled)), np.repeat(np.arange(len(lists)), lengths)[filled.to_numpy(zero_copy_only=False)]


def packed(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column from the concatenated values and the rows' lengths. Spark copies it without looking at every value."""
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.array(offsets, pa.int32()).buffers()[1], pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated values of a ``packed`` column, and the rows' lengths."""
    column = column.cast(pa.large_binary())
    _, offsets, values = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(values, np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return raw.view(kind), np.diff(ends) // np.dtype(kind).itemsize


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, the ends of texts included. Words are counted within tasks before they are shuffled."""

    def out(parts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        counts = pc.value_counts(pa.chunked_array(parts, pa.large_string()))
        for k in range(0, len(counts), COUNT_ROWS):
            some = counts[k : k + COUNT_ROWS]
            yield batches({"word": some.field("values").cast(pa.binary()), "n": some.field("counts")})

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, ends = [], 0, 0
        for batch in items:
            words, _ = _split(batch.column("text"))
            parts.append(words)
            held += len(words)
            ends += batch.num_rows
            if held > TASK_WORDS:
                yield from out(parts)
                parts, held = [], 0
        yield from out(parts)
        if ends:
            yield batches({"word": pa.array([END], pa.binary()), "n": pa.array([ends], pa.int64())})

    return map_arrow(docs, run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """What every task needs to score texts. All of it is bounded by the parameters, not by the corpus."""

    ids: dict[bytes, int]  # frequent words, by rank
    counts: np.ndarray  # their counts
    classes: np.ndarray  # their classes
    transitions: np.ndarray  # log10 P(class | previous class)
    sizes: np.ndarray  # training tokens of each class
    kinds: np.ndarray  # distinct training words of each class
    train_tokens: int
    train_words: int
    rest: int  # the class of all other words
    end: int  # the class of the end of a text


def class_number(words: int) -> int:
    """How many classes a vocabulary gets: half the root of its size, at least two."""
    return max(2, math.isqrt(words) // 2)


def encode(docs: DataFrame, ids: dict[bytes, int]) -> DataFrame:
    """``docs`` with, instead of ``text``, ``words``: the ids of its words, ``len(ids)`` for any other, packed as 32-bit numbers;
    the distinct others are in ``tail``, how often in ``times``. Null and empty texts have no words."""
    shared = docs.sparkSession.sparkContext.broadcast(pa.array(sorted(ids, key=ids.get), pa.large_binary()))
    kept = docs.drop("text")
    names, other = kept.columns, len(ids)

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in items:
            words, row = _split(batch.column("text"))
            words = words.cast(pa.large_binary())
            own = pc.index_in(words, value_set=known).fill_null(other).to_numpy(zero_copy_only=False)
            beyond = own == other
            coded = words.filter(pa.array(beyond)).dictionary_encode()
            code, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
            tail, times = np.unique(row[beyond] * max(1, len(distinct)) + code, return_counts=True)
            tail_row, tail = np.divmod(tail, max(1, len(distinct)))
            in_row = np.bincount(tail_row, minlength=batch.num_rows)
            yield batches({
                **{c: batch.column(c) for c in names},
                "words": packed(own, np.bincount(row, minlength=batch.num_rows)),
                "tail": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(in_row)]), pa.int32()), distinct.take(pa.array(tail)).cast(pa.binary())),
                "times": list_array(times.astype(np.int32), in_row, pa.int32()),
            })

    own = "words binary, tail array<binary>, times array<int>"
    return map_arrow(docs, run, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema), own]))


def _with_ends(column: pa.Array, other: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts with an end before the first and after each (ids from ``other`` on are one, the end is the next),
    and the texts' numbers of words."""
    words, lengths = unpacked(column, np.int32)
    out = np.full(len(words) + len(lengths) + 1, other + 1, np.int64)
    out[np.arange(len(words)) + np.repeat(np.arange(1, len(lengths) + 1), lengths)] = np.minimum(words, other)
    return out, lengths


def pair_counts(docs: DataFrame, ids: dict[bytes, int]) -> DataFrame:
    """(a, b, n): how often word ``b`` follows word ``a``, over all texts; all words beyond ``ids`` are one, the end another."""
    size = len(ids) + 2
    bits = size.bit_length()

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            seen, lengths = unpacked(batch.column("after"), np.int64)
            yield batches({"a": pa.array(np.repeat(batch.column("word").to_numpy(), lengths), pa.int32()),
                           "b": pa.array(seen & ((1 << bits) - 1), pa.int32()), "n": pa.array(seen >> bits, pa.int64())})

    near = encoded_neighbours(encode(docs.select("text"), ids), np.zeros(size, np.int64))
    return map_arrow(near.select("word", "after"), run, "a int, b int, n long")


def encoded_neighbours(encoded: DataFrame, often: np.ndarray) -> DataFrame:
    """The ``neighbours`` of texts as word ids (``words``). ``often`` has every id's occurrences, the last but one those of all
    ids from there on and the last the ends'.

    Every text stands between two ends. Pairs are counted within tasks before they are shuffled.
    """
    size = len(often)
    parts = 1 + often // BUCKET_WORDS

    def out(pairs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found, n = np.unique(np.concatenate(pairs), return_counts=True)
        return _dealt(found // size, found % size, n, parts)

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, held = [], 0
        for batch in items:
            words, _ = _with_ends(batch.column("words"), size - 2)
            pairs.append(words[:-1] * size + words[1:])
            held += len(words)
            if held > TASK_PAIRS:
                yield from out(pairs)
                pairs, held = [], 0
        if pairs:
            yield from out(pairs)

    near = _gathered(map_arrow(encoded.select("words"), run, DEALT), size)
    several = np.flatnonzero(parts > 1).tolist()
    if not several:
        return near
    # The parts of a word have different neighbours: they only need to be put together.
    whole = near.where(F.col("word").isin(several)).groupBy("word").agg(
        *[F.expr(f"aggregate(collect_list({side}), X'', (x, y) -> concat(x, y))").alias(side) for side in ("before", "after")])
    return near.where(~F.col("word").isin(several)).unionByName(materialize(whole, "brown-frequent"))


def neighbours(pairs: DataFrame, size: int) -> DataFrame:
    """(word, before, after) of pairs (a, b, n): every neighbour of a word as one number, its count and its id, on the side where
    it stands, packed as 64-bit numbers.

    A word has at most ``size`` neighbours on each side, HEAD_WORDS and two, however large the corpus is.
    """
    parts = np.ones(size, np.int64)

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            yield from _dealt(*[batch.column(c).to_numpy().astype(np.int64) for c in "abn"], parts)

    return _gathered(map_arrow(pairs.select("a", "b", "n"), run, DEALT), size)


DEALT = "bucket int, owners binary, others binary, n binary"


def _dealt(a: np.ndarray, b: np.ndarray, n: np.ndarray, parts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs in a row per bucket, each twice: as a neighbour before ``b`` and as one after ``a``."""
    words, others = np.concatenate([b, a]), np.concatenate([a, b])
    bucket = ((words + others % parts[words] * 2_654_435_761) % BUCKETS).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    owners = (words * 2 + np.repeat([0, 1], len(a)))[order].astype(np.int32)
    others, n = others[order].astype(np.int32), np.tile(n, 2)[order]
    lengths = np.bincount(bucket, minlength=BUCKETS)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for k in range(0, BUCKETS, 512):
        held = np.flatnonzero(lengths[k : k + 512]) + k
        own = slice(starts[k], starts[k + 512])
        if len(held):
            yield batches({"bucket": pa.array(held, pa.int32()), **{
                name: packed(x[own], lengths[held]) for name, x in (("owners", owners), ("others", others), ("n", n))}})


def _gathered(dealt: DataFrame, size: int) -> DataFrame:
    """(word, before, after) from rows of buckets, equal pairs added up. A task holds the pairs of a few buckets at a time."""
    bits = size.bit_length()

    def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys)
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[starts], np.add.reduceat(n[order], starts)

    def out(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        owner, other = np.divmod(keys, size)
        words, at = np.unique(owner >> 1, return_inverse=True)
        seen, side = (n << bits) + other, owner & 1
        return batches({"word": pa.array(words, pa.int32()), **{
            name: packed(seen[side == k], np.bincount(at[side == k], minlength=len(words))) for k, name in enumerate(("before", "after"))}})

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = []
        for batch in items:
            owners, lengths = unpacked(batch.column("owners"), np.int32)
            keys, n = owners.astype(np.int64) * size + unpacked(batch.column("others"), np.int32)[0], unpacked(batch.column("n"), np.int64)[0]
            # The last bucket may go on in the next batch.
            buckets = batch.column("bucket").to_numpy()
            closed = int(np.searchsorted(buckets, buckets[-1]))
            at = int(lengths[:closed].sum())
            if closed:
                yield out(*summed([*kept, (keys[:at], n[:at])]))
                kept = []
            kept = [summed([*kept, (keys[at:], n[at:])])]
        if kept:
            yield out(*kept[0])

    # Rows of a bucket lie in one partition, one after the other.
    ordered = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return materialize(map_arrow(ordered, run, "word int, before binary, after binary"), "brown-neighbours")


def _side(lists: pa.Array, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all neighbours in a column of ``neighbours``: the row, the class and the count."""
    bits = len(classes).bit_length()
    seen, lengths = unpacked(lists, np.int64)
    row = np.repeat(np.arange(len(lists)), lengths)
    return row, classes[seen & ((1 << bits) - 1)], seen >> bits


def _contexts(batch: pa.RecordBatch, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """How often each word of the batch has a neighbour of each class, before it and after it."""
    out = []
    for name in ("before", "after"):
        row, cls, n = _side(batch.column(name), classes)
        out.append(np.bincount(row * n_classes + cls, weights=n, minlength=batch.num_rows * n_classes).reshape(-1, n_classes))
    return np.array(out)


def class_pairs(near: DataFrame, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """How often each class follows each. Tasks hand on their sums, which a shuffle adds."""
    shared = near.sparkSession.sparkContext.broadcast(classes)

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_classes * n_classes, np.int64)
        for batch in items:
            row, cls, n = _side(batch.column("before"), shared.value)
            own = shared.value[batch.column("word").to_numpy()].astype(np.int64) * n_classes
            total += np.bincount(own[row] + cls, weights=n, minlength=len(total)).astype(np.int64)
        own, cls = np.nonzero(total.reshape(n_classes, n_classes))
        yield batches({"cls": pa.array(cls, pa.int32()), "own": pa.array(own, pa.int32()),
                       "n": pa.array(total[own * n_classes + cls], pa.int64())})

    found = map_arrow(near.select("word", "before"), run, "cls int, own int, n long").groupBy("cls", "own").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((n_classes, n_classes), np.int64)
    out[found.column("cls").to_numpy(), found.column("own").to_numpy()] = found.column("n").to_numpy()
    shared.unpersist()
    return out


def mutual_information(pairs: np.ndarray) -> float:
    """What the class of a word tells of the next one's, in nats a token: what exchange can raise of the log-likelihood."""
    p = pairs / max(1, pairs.sum())
    apart = p.sum(axis=1, keepdims=True) * p.sum(axis=0, keepdims=True)
    seen = p > 0
    return float((p[seen] * np.log(p[seen] / apart[seen])).sum())


def exchanged(near: DataFrame, pairs: np.ndarray, classes: np.ndarray, turn: int, choices: int) -> np.ndarray:
    """The classes after every second word (of ``turn``) could choose. Words choose in tasks, a dense row of contexts each."""
    shared = near.sparkSession.sparkContext.broadcast((pairs, classes))
    clustered = len(classes) - 2

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, classes = shared.value
        for batch in items:
            words = batch.column("word").to_numpy()
            own = exchange(_contexts(batch, classes, len(pairs)), pairs, classes[words], np.arange(len(words)), choices)
            yield batches({"word": batch.column("word"), "cls": pa.array(own, pa.int32())})

    own = near.where((F.col("word") < clustered) & (F.expr("word div 2 % 2") == turn % 2))
    found = map_arrow(own, run, "word int, cls int").toArrow()
    out = classes.copy()
    out[found.column("word").to_numpy()] = found.column("cls").to_numpy()
    shared.unpersist()
    return out


def cluster(pairs: DataFrame, clustered: int, n_classes: int, least_gain: float) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the words, the other word and the end, and the counts of class pairs under them, from word pairs (a, b, n)."""
    return settled(neighbours(pairs, clustered + 2), clustered, n_classes, least_gain)


def settled(near: DataFrame, clustered: int, n_classes: int, least_gain: float) -> tuple[np.ndarray, np.ndarray]:
    """What ``cluster`` returns, from the words' ``neighbours``.

    Words start dealt over the classes by rank. The rounds end when two of them raised the mutual information by less than
    ``least_gain`` of itself; the best classes of all rounds are returned.
    """
    classes = np.concatenate([np.arange(clustered) % n_classes, [n_classes, n_classes + 1]])
    best, gained = None, []
    while True:
        found = class_pairs(near, classes, n_classes + 2)
        gained.append(mutual_information(found))
        if best is None or gained[-1] > best[0]:
            best = gained[-1], classes, found
        if not clustered or (len(gained) > 2 and max(gained[-2:]) <= max(gained[:-2]) * (1 + least_gain)):
            return best[1], best[2]
        classes = exchanged(near, found, classes, len(gained), n_classes)


def exchange(contexts: np.ndarray, pairs: np.ndarray, classes: np.ndarray, offered: np.ndarray, choices: int) -> np.ndarray:
    """New classes: each offered word takes the class that makes its contexts and itself most likely.

    The logarithm of the likelihood of word w in class k is the sum of log P(k | class before) and log P(class after | k)
    over its occurrences, and of log P(w | k), where all that depends on k is the class's size.
    """
    before, after = contexts
    into = np.log((pairs + 0.5) / (pairs.sum(axis=1, keepdims=True) + 0.5 * len(pairs)))
    sizes = np.log(pairs.sum(axis=0) + 1.0)
    gain = before @ into[:, :choices] + after @ into[:choices].T - before.sum(axis=1, keepdims=True) * sizes[:choices]
    out = classes.copy()
    out[offered] = np.argmax(gain[offered], axis=1)
    return out


def vocabulary(docs: DataFrame, head_words: int = HEAD_WORDS) -> tuple[DataFrame, dict[bytes, int], np.ndarray]:
    """The table of all word counts of ``docs`` (text), the ranks of the most frequent words, and their counts."""
    counts = materialize(word_counts(docs), "brown-counts")
    words = counts.where(F.col("word") != F.lit(END))
    # Only words as frequent as the last one ranked are sorted: the number of different counts is small.
    kinds = words.groupBy("n").count().toArrow()
    levels, kinds = kinds.column("n").to_numpy(), kinds.column("count").to_numpy()
    falling = np.argsort(-levels)
    reached = np.flatnonzero(np.cumsum(kinds[falling]) >= head_words)
    least = int(levels[falling[reached[0]]]) if len(reached) else 1
    head = words.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(head_words).toArrow()
    return counts, {w: k for k, w in enumerate(head.column("word").to_pylist())}, head.column("n").to_numpy()


def train(docs: DataFrame, head_words: int = HEAD_WORDS, **parameters) -> tuple[Model, DataFrame]:
    """The model of the texts in ``docs`` (text), and the table of all word counts."""
    counts, ids, n = vocabulary(docs, head_words)
    return fit(encode(docs.select("text"), ids), counts, ids, n, **parameters), counts


def fit(encoded: DataFrame, counts: DataFrame, ids: dict[bytes, int], n: np.ndarray, clustered_words: int | None = None,
        n_classes: int | None = None, least_count: int = LEAST_COUNT, least_gain: float = LEAST_GAIN) -> Model:
    """The model of texts as word ids, all words' ``counts`` and the head's ranks and counts.

    Unless told otherwise, all head words with ``least_count`` occurrences get a class, of a number that grows with them.
    """
    none = F.lit(0)
    total = counts.agg(F.coalesce(F.sum("n"), none).alias("n"), F.count("*").alias("v"),
                       F.coalesce(F.sum(F.when(F.col("word") == F.lit(END), F.col("n"))), none).alias("ends")).first()
    enough = int(np.count_nonzero(n >= least_count))
    clustered = enough if clustered_words is None else min(clustered_words, len(ids))
    n_classes = n_classes or class_number(clustered)
    rest, end = n_classes, n_classes + 1
    often = np.concatenate([n[:clustered], [total.n - total.ends - int(n[:clustered].sum()), total.ends]]).astype(np.int64)
    small, pairs = settled(encoded_neighbours(encoded, often), clustered, n_classes, least_gain)
    # Ids after the head's: any other word, and the end of a text.
    classes = np.full(len(ids) + 2, rest, np.int16)
    classes[:clustered] = small[:clustered]
    classes[-1] = end
    sizes = pairs.sum(axis=0).astype(np.float64)
    kinds = np.bincount(classes[:clustered], minlength=n_classes + 2).astype(np.float64)
    # The rest's class has all other words and, as one more, any word never seen.
    kinds[rest] = max(0, total.v - clustered - (sizes[end] > 0)) + 1
    kinds[end] = 1
    transitions = np.log10((pairs + 0.5) / (pairs.sum(axis=1, keepdims=True) + 0.5 * len(pairs)))
    own = np.concatenate([n, [0, int(sizes[end])]]).astype(np.float64)
    return Model(ids, own, classes, transitions, sizes, kinds, int(total.n), int(total.v), rest, end)


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, held_out): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts have one token, their end. Rows are told apart by a number of their own, so repeated rows and
    null ids are scored each.
    """
    keyed = docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", "text")
    return score_encoded(materialize(encode(keyed, model.ids), "brown-encoded"), model, counts)


def score_encoded(encoded: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """The scores of texts as word ids (row, doc_id, held_out, words, tail, times)."""
    shared = encoded.sparkSession.sparkContext.broadcast(replace(model, ids={}))
    other = len(model.ids)

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        logs = np.log10(m.counts + 1)
        emit = logs - np.log10(m.sizes + m.kinds)[m.classes]
        for batch in items:
            words, lengths = _with_ends(batch.column("words"), other)
            kinds, inside = m.classes[words], words[1:]
            starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)]).astype(np.int64)
            # The rest's own logarithm is that of an unseen word's count plus one, 0: the join adds what is missing.
            yield batches({
                "row": batch.column("row"), "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "n_tokens": pa.array(lengths + 1, pa.int64()), "known": pa.array(np.add.reduceat((m.counts[inside] > 0).astype(np.int64), starts)),
                "base": pa.array(np.add.reduceat(logs[inside], starts)),
                "scored": pa.array(np.add.reduceat(m.transitions[kinds[:-1], kinds[1:]] + emit[inside], starts)),
            })

    schema = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, scored double"
    scored = map_arrow(encoded.select("row", "doc_id", "held_out", "words"), run, schema)
    rare = encoded.select("row", F.explode(F.arrays_zip("tail", "times")).alias("x")).select("row", F.col("x.tail").alias("word"), F.col("x.times").alias("times"))
    found = rare.join(counts, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("more_known"))
    joined = scored.join(found, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    least = math.log10(model.train_tokens + model.train_words + 1)
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"), (F.col("base") + more - F.col("n_tokens") * least).alias("base_score"),
        (F.col("scored") + more).alias("score"))


def with_folds(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """``docs`` with ``held_out``: whether crc32 of the id as text leaves ``held``. A null id counts as empty text."""
    key = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.withColumn("held_out", F.pmod(key, F.lit(folds)) == held)


def score_held_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head_words: int = HEAD_WORDS,
                   **parameters) -> DataFrame:
    """Train on the rows that aren't held out and score all rows. An empty table gives an empty result.

    Without a training word, or without a training row, all counts are zero: transitions are uniform, and every word is one
    that was never seen.
    """
    docs = with_folds(ids_and_texts(docs, id_col, text_col))
    counts, ids, n = vocabulary(docs.where("not held_out").select("text"), head_words)
    keyed = docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", "text")
    encoded = materialize(encode(keyed, ids), "brown-encoded")
    return score_encoded(encoded, fit(encoded.where("not held_out"), counts, ids, n, **parameters), counts)


def op10_brown_scores(spark, sf_dir: str) -> DataFrame:
    return score_held_out(table(spark, sf_dir, "documents"))
