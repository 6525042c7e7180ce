"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its word shingles. All shingles have one global order, rare before frequent. If two sets are
similar enough, then for every l the first ``n - need + l`` shingles of each share at least l, where ``need`` is the
least overlap a set of n shingles can have with a partner. A document whose prefix would meet many others takes a longer
prefix and asks for more shared shingles; a pair must share the smaller of its two requirements.

1. Texts with the same word sequence become one *representative* before anything else.
2. Shingle frequencies come from a sketch of fixed size summed over all documents. It only orders shingles, so its
   errors cost time, not links.
3. Postings of the prefixes are joined in rounds. First each posting list is linked to one leader, which joins large
   groups of near copies with a row per member; then only rows outside the leader's component meet the rest of their
   list. No list is paired with itself.
4. Pairs are cut by what their prefixes prove, then verified on the whole shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlode.session import materialize

from .common import (WordHashes, batches, byte_texts, id_filter, id_slot, ids_and_texts, list_array, map_arrow, signed, table,
                     window_hashes)
from .components import components

# log2 of the sketch's counters. More of them tell frequencies apart in larger corpora (4 bytes each in every task).
SKETCH_BITS = 20
SLICE = 1 << 14
# Steps in a doubling of the frequency. Small ones tell a counter that holds a frequent shingle from the many that only
# hold as many rare ones as any other.
STEPS = 16
# A prefix may be lengthened by so many shingles at most; requirements run from 1 to this.
MOST_MATCHES = 4
# Words of a set's parity bitmap, 64 bits each.
PARITY_WORDS = 8
_PARITY = [f"w{k}" for k in range(PARITY_WORDS)]
# Cost of checking one candidate against the cost of reading one posting.
CHECK_COST = 4.0


def shingles(raw: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text; a shorter text is one shingle, one without words none."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(hashes.of(words), min(size, len(words))))


def text_key(raw: bytes) -> bytes:
    """Equal for equal sequences of lower-cased words."""
    return hashlib.blake2b(b" ".join(raw.lower().split()), digest_size=16).digest()


def _survey(docs: DataFrame, size: int, bits: int) -> DataFrame:
    """One row per document (key, n_shingles) and, from each task, the slices of its frequency sketch."""

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, hashes, shift = np.zeros(1 << bits, np.uint32), WordHashes(), np.uint64(64 - bits)
        for batch in items:
            sizes, keys = [], []
            for raw in byte_texts(batch.column("text")):
                found = shingles(raw, size, hashes)
                np.add.at(counts, found >> shift, np.uint32(1))
                sizes.append(len(found))
                keys.append(text_key(raw))
            n = batch.num_rows
            yield batches({
                "doc_id": batch.column("doc_id"), "key": pa.array(keys, pa.binary()),
                "n_shingles": pa.array(sizes, pa.int64()), "slice": pa.nulls(n, pa.int32()),
                "counts": pa.nulls(n, pa.binary()),
            })
        parts = [(k, x) for k, x in enumerate(counts.reshape(-1, min(SLICE, len(counts)))) if x.any()]
        n = len(parts)
        yield batches({
            "doc_id": pa.nulls(n, pa.int64()), "key": pa.nulls(n, pa.binary()), "n_shingles": pa.nulls(n, pa.int64()),
            "slice": pa.array([k for k, _ in parts], pa.int32()),
            "counts": pa.array([x.tobytes() for _, x in parts], pa.binary()),
        })

    return map_arrow(docs, run, "doc_id long, key binary, n_shingles long, slice int, counts binary")


def _sketch(survey: DataFrame, bits: int) -> np.ndarray:
    """The summed sketch: each counter's logarithm. Its size is fixed, so it may go to the driver and to every task."""

    def add(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in items:
            for k, raw in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(raw, np.uint32).astype(np.uint64)
                sums[k] = sums[k] + part if k in sums else part
        logs = {k: (np.log2(np.maximum(v, 1)) * STEPS).astype(np.uint16) for k, v in sums.items()}
        yield batches({"slice": pa.array(list(logs), pa.int32()),
                       "logs": pa.array([v.tobytes() for v in logs.values()], pa.binary())})

    width = min(SLICE, 1 << bits)
    slices = survey.where("slice is not null").select("slice", "counts").repartition((1 << bits) // width, "slice")
    out = np.zeros(1 << bits, np.uint16)
    for row in map_arrow(slices, add, "slice int, logs binary").collect():
        out[row.slice * width : (row.slice + 1) * width] = np.frombuffer(row.logs, np.uint16)
    return out


def _ordered_tokens(found: np.ndarray, logs: np.ndarray, bits: int) -> np.ndarray:
    """Shingles as non-negative numbers in the global order: 9 bits of frequency, then 54 bits of hash.

    The hash keeps its low bits, as the high ones choose the counter.
    """
    rank = np.minimum(logs[found >> np.uint64(64 - bits)], 511).astype(np.uint64)
    tokens = (rank << np.uint64(54)) | (found & np.uint64((1 << 54) - 1))
    tokens.sort()
    return tokens


def least_overlap(n: int, percent: int) -> int:
    """The smallest overlap a set of ``n`` can have with any set similar to ``percent`` per cent."""
    return -(-n * percent // 100)


def prefix_choice(tokens: np.ndarray, percent: int) -> tuple[int, int]:
    """(matches asked for, prefix length) with the least estimated cost.

    The estimate for l matches is the postings read plus the candidates checked; no more documents can share l prefix
    shingles than the postings divided by l.
    """
    n = len(tokens)
    first = n - least_overlap(n, percent) + 1
    most = min(MOST_MATCHES, n - first + 1)
    loads = np.cumsum(np.exp2((tokens[: first + most - 1] >> np.uint64(54)).astype(np.float64) / STEPS))
    costs = [loads[first + m - 2] * (1 + CHECK_COST / m) for m in range(1, most + 1)]
    best = int(np.argmin(costs)) + 1
    return best, first + best - 1


def parity(found: np.ndarray) -> np.ndarray:
    """Each bit tells whether an odd number of shingles fall on it.

    A shingle that both sets hold cancels out, so two bitmaps differ in no more bits than the sets differ in shingles.
    """
    odd = np.bincount((found & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _prefixes(docs: DataFrame, logs, size: int, percent: int, bits: int) -> DataFrame:
    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in items:
            keep, sizes, asked, prefixes, bits_of = [], [], [], [], []
            for raw in byte_texts(batch.column("text")):
                found = shingles(raw, size, hashes)
                keep.append(len(found) > 0)
                if not len(found):
                    continue
                tokens = _ordered_tokens(found, logs.value, bits)
                matches, length = prefix_choice(tokens, percent)
                sizes.append(len(tokens))
                asked.append(matches)
                prefixes.append(tokens[:length])
                bits_of.append(parity(found))
            if sizes:
                yield batches({
                    "doc_id": batch.column("doc_id").filter(pa.array(keep)), "n": pa.array(sizes, pa.int64()),
                    "asked": pa.array(asked, pa.int32()),
                    "prefix": list_array(signed(np.concatenate(prefixes)), np.array([len(x) for x in prefixes]), pa.int64()),
                    **{w: pa.array(column) for w, column in zip(_PARITY, np.array(bits_of).T.copy(), strict=True)},
                })

    return map_arrow(docs, run, "doc_id long, n long, asked int, prefix array<long>, " + ", ".join(f"{w} long" for w in _PARITY))


def _possible(x: str, y: str, percent: int) -> str:
    """Whether two postings of a list leave their documents enough to share.

    Before the shingle they can share no more than either has shingles that any other document holds (``before``), and
    after it no more than either has left.
    """
    most = f"least({x}before, {y}before) + least({x}n - {x}place, {y}n - {y}place)"
    return f"({most}) * {100 + percent} >= {percent} * ({x}n + {y}n)"


def _provable(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose prefixes don't rule the pair out."""

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            x = {c: batch.column(c).to_pylist() for c in ("n_a", "n_b", "asked_a", "asked_b")}
            p, q = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("p_a", "p_b"))
            mask = []
            for k in range(batch.num_rows):
                s, t, n, m = p[k], q[k], x["n_a"][k], x["n_b"][k]
                shared = np.intersect1d(s, t, assume_unique=True)
                end = min(s[-1], t[-1])
                low = int(np.count_nonzero(shared <= end))
                most = low + min(n - int(np.searchsorted(s, end, "right")), m - int(np.searchsorted(t, end, "right")))
                # J >= p/100 is the same as overlap * (100 + p) >= p * (n + m).
                mask.append(len(shared) >= min(x["asked_a"][k], x["asked_b"][k]) and most * (100 + percent) >= percent * (n + m))
            yield batch.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    left = prefixes.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("asked").alias("asked_a"), F.col("prefix").alias("p_a"))
    right = prefixes.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("asked").alias("asked_b"), F.col("prefix").alias("p_b"))
    return map_arrow(pairs.select("a", "b").join(left, "a").join(right, "b"), run, "a long, b long")


def _sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """The shingle sets of the documents named in ``ids`` (id)."""
    flags = id_filter(ids)
    keyed = docs.withColumn("slot", id_slot("doc_id"))

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in items:
            slots = batch.column("slot").to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(flags.value[slots]))
            found = [shingles(raw, size, hashes) for raw in byte_texts(batch.column("text"))]
            if found:
                yield batches({"doc_id": batch.column("doc_id"),
                               "tokens": list_array(signed(np.concatenate(found)), np.array([len(x) for x in found]), pa.int64())})

    found = map_arrow(keyed.where("doc_id is not null"), run, "doc_id long, tokens array<long>")
    return found.join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Of the pairs (a, b) those whose whole shingle sets are similar enough."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b"))).distinct()
    sets = _sets(docs, ids, size)

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            s, t = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("s", "t"))
            mask = []
            for x, y in zip(s, t, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                mask.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("s"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("t"))
    return map_arrow(pairs.join(left, "a").join(right, "b"), run, "a long, b long").distinct()


def _labelled(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Postings with each document's component so far, without lists that lie in one component."""
    if labels is not None:
        named = postings.drop("component").join(labels, postings["doc_id"] == labels["node"], "left").drop("node")
        postings = named.withColumn("component", F.coalesce("component", "doc_id"))
    else:
        postings = postings.withColumn("component", F.col("doc_id"))
    lists = (postings.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most"))
             .where("least < most").select("token"))
    return materialize(postings.join(lists, "token", "left_semi"), "jaccard-postings")


def _star_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Each posting with the leader of its list, if sizes allow a link.

    The leader is the document with the most shared postings: in a group of near copies one that differs little from
    the others, as its own changes would be postings of its own.
    """
    leaders = postings.groupBy("token").agg(
        F.min(F.struct("alone", "doc_id", "n", "component", "place", "before")).alias("leader"))
    met = postings.join(leaders, "token").where("component <> leader.component").where(_possible("", "leader.", percent))
    return met.select(F.col("leader.doc_id").alias("a"), F.col("doc_id").alias("b")).distinct()


def _outside(postings: DataFrame) -> DataFrame:
    """The postings that are not in the component of their list's leader."""
    leaders = postings.groupBy("token").agg(F.min(F.struct("alone", "doc_id", "component")).alias("leader"))
    return postings.join(leaders, "token").where("component <> leader.component").drop("leader")


def _near(percent: int) -> str:
    """Whether two parity bitmaps allow a link: linked sets of n and m shingles differ in at most
    (n + m) (100 - percent) / (100 + percent) of them."""
    apart = " + ".join(f"bit_count(x_{w} ^ y_{w})" for w in _PARITY)
    return f"({apart}) * {100 + percent} <= {100 - percent} * (x_n + y_n)"


def _rest_pairs(postings: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """All pairs of a list in different components: the rows outside the leader's component against the list."""
    marked = postings.join(prefixes.select("doc_id", *_PARITY), "doc_id")

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("token", *[F.col(c).alias(name + c) for c in ("doc_id", "n", "component", "place", "before", *_PARITY)])

    met = side(_outside(marked), "x_").join(side(marked, "y_"), "token").where("x_component <> y_component")
    met = met.where(_possible("x_", "y_", percent)).where(_near(percent))
    return met.select(F.least("x_doc_id", "y_doc_id").alias("a"), F.greatest("x_doc_id", "y_doc_id").alias("b")).distinct()


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80, sketch_bits: int = SKETCH_BITS,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles and component_id, the smallest id reachable over links.

    Documents link if the Jaccard similarity of their sets of ``size``-word shingles is at least ``percent`` per cent.
    Null or empty texts have no shingles, link with nothing and are their own component. Texts shorter than ``size``
    words are one shingle. Repeated rows share their component; rows with the same id count as one node. A null id gets
    a null component. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = ids_and_texts(docs, id_col, text_col)
    survey = materialize(_survey(docs, size, sketch_bits), "jaccard-survey")
    members = survey.where("slice is null").select("doc_id", "key", "n_shingles")
    logs = spark.sparkContext.broadcast(_sketch(survey, sketch_bits))
    first = members.where("n_shingles > 0 and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("first"))
    keyed = materialize(members.join(first, "key", "left").select("doc_id", "n_shingles", "first"), "jaccard-members")
    chosen = keyed.where("doc_id = first").select("doc_id").distinct()
    prefixes = materialize(
        _prefixes(docs.where("doc_id is not null"), logs, size, percent, sketch_bits).join(chosen, "doc_id", "left_semi"), "jaccard-prefixes")

    postings = prefixes.select("doc_id", "n", F.posexplode("prefix").alias("place", "token"))
    shared = postings.groupBy("token").agg(F.count("*").alias("met")).where("met > 1").select("token")
    postings = postings.join(shared, "token", "left_semi")
    own = Window.partitionBy("doc_id")
    postings = postings.withColumns({"alone": -F.count("*").over(own), "before": F.row_number().over(own.orderBy("place")) - 1})
    postings = _labelled(postings, None)
    links = None
    labels = None
    for step in ("leaders", "leaders of the rest", "all that is left"):
        if step == "leaders":
            pairs = _star_pairs(postings, percent)
        elif step == "leaders of the rest":
            pairs = _star_pairs(_outside(postings), percent)
        else:
            pairs = _rest_pairs(postings, prefixes, percent)
        pairs = materialize(_provable(pairs, prefixes, percent), "jaccard-pairs")
        if pairs.isEmpty():
            continue
        found = materialize(_verified(pairs, docs, size, percent), "jaccard-links")
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        if step != "all that is left":
            postings = _labelled(postings, labels)
    if labels is None:
        return keyed.select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("component_id"))
    named = keyed.join(labels, keyed["first"] == labels["node"], "left")
    return named.select("doc_id", "n_shingles", F.coalesce("component", "first", "doc_id").alias("component_id"))


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; all columns stay. Rows with a null id stay."""
    found = jaccard_components(docs, size, percent, id_col=id_col, text_col=text_col)
    dropped = found.where("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(dropped, id_col, "left_anti")
