"""Conversation prefix trie in node tables under minimal perfect hashes.

A node is a sequence of turns that begins at least one conversation, and is named by a digest chained over its turns.

1. Conversations are streamed in the order of their turns, and each gives one row per prefix: the prefix's digest, its
   parent's, and its depth. Texts stay where they are read; only their digests and sizes are moved.
2. Nodes that very many conversations share are the *top* of the trie. Below it, every subtree hangs from a node with few
   members, so subtrees are dealt to shards of bounded size, and the top, bounded as well, is a shard of its own.
3. In a shard, a minimal perfect hash gives each distinct digest a slot; the digest kept there verifies every lookup. Counts
   are scattered into flat arrays by slot and accumulated through the array of parent slots, deepest nodes first. What a
   subtree sums up to reaches the top as a row per parent.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlode.session import materialize

from .common import batches, map_arrow, mix, table

# A node with more members than the larger of these belongs to the top, which thereby has no more than 2^20 nodes.
LEAST_TOP = 1_000
MOST_TOP_NODES = 1 << 20
# Nodes of a shard, on average; a shard takes about 100 bytes for each.
SHARD_NODES = 200_000
# Blocks of ids whose ending conversations are written into one string before a node's strings are joined.
END_BLOCK = 4_096
DIGEST = 16
ROOT = bytes(DIGEST)
TOP_SHARD = -1


class SlotTable:
    """A minimal perfect hash of distinct 16-byte digests.

    Level by level, digests that have a bit of the level's bitmap to themselves take it; those that collide go on to the
    next level. A digest's slot is the rank of its bit. The digest kept in the slot tells members from strangers.
    """

    def __init__(self, digests: np.ndarray):
        """``digests``: uint64 array of shape (n, 2)."""
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, before = np.asarray(digests, np.uint64).reshape(-1, 2), 0
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("digests repeat")
            size = max(8, 2 * len(left))
            at = self._bits(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            rank = np.cumsum(alone) - 1 + before
            self.levels.append((alone, rank))
            before += int(alone.sum())
            left = left[~alone[at]]
        self.n = before
        self.kept = np.zeros((self.n, 2), np.uint64)
        self.kept[self._ranks(digests)] = digests

    @staticmethod
    def _bits(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        spread = mix(digests[:, 0] ^ mix(digests[:, 1] + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))
        return (spread % np.uint64(size)).astype(np.int64)

    def _ranks(self, digests: np.ndarray) -> np.ndarray:
        out = np.full(len(digests), -1, np.int64)
        open_ = np.arange(len(digests))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._bits(digests[open_], level, len(alone))
            hit = alone[at]
            out[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        return out

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for one that is not in the table."""
        digests = np.asarray(digests, np.uint64).reshape(-1, 2)
        out = self._ranks(digests)
        known = out >= 0
        known[known] = (self.kept[out[known]] == digests[known]).all(1)
        return np.where(known, out, -1)


def as_pairs(column: pa.Array) -> np.ndarray:
    """A binary column of digests as a uint64 array of shape (n, 2); null counts as zeros."""
    return np.frombuffer(b"".join(x or ROOT for x in column.to_pylist()), np.uint64).reshape(-1, 2)


# From turns to prefixes


def head_turns(conv_id: int) -> int:
    """How many turns conversation ``conv_id`` takes from the first of its block of five."""
    return zlib.crc32(str(conv_id).encode()) % 9


BLOCK = 5


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, base, turn, digest and bytes, without rows of a null id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    conv = F.col("conv_id").cast("long")
    return conversations.where(conv.isNotNull()).select(
        conv.alias("conv_id"), (conv - conv % BLOCK).alias("base"), F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(F.sha2(content, 256)), 1, DIGEST).alias("digest"), F.octet_length(text).cast("long").alias("bytes"))


PREFIXES = "digest binary, parent binary, depth long, bytes long, conv_id long, ends boolean, shard long, parent_conv_id long"


def _rebuilt(rows: Iterator[tuple], head) -> Iterator[tuple[int, Iterator[tuple]]]:
    """(conv_id, (digest, bytes) of its turns as rebuilt) from (base, conv_id, digest, bytes), the base first in its block.

    Turns are handed on as they come; of a base's only the first few are remembered.
    """
    row = next(rows, None)
    start: list[tuple] = []
    block = None
    while row is not None:
        base, conv = row[0], row[1]
        if base != block:
            block, start = base, []
        h = head(conv)

        def turns(conv=conv, base=base, h=h):
            nonlocal row
            yield from () if conv == base else start[:h]
            place = 0
            while row is not None and row[1] == conv and row[0] == base:
                turn, row = row[2:], next(rows, None)
                if conv == base and place < 16:
                    start.append(turn)
                if conv == base or place >= h:
                    yield turn
                place += 1

        yield conv, turns()


def _prefixes(turns: DataFrame, top: Top | None, n_shards: int, head) -> DataFrame:
    """A row per conversation and prefix; with ``top`` also the prefix's shard and, below the top, its parent's member.

    A conversation passes through a task as a sorted stream, so its length doesn't matter to memory. Rows of ``turns``
    in one block of ids meet in one task.
    """
    spark = turns.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.repartition(parts, "base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "digest", "bytes")
    known = spark.sparkContext.broadcast(top) if top is not None else None

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in items:
                yield from zip(*(batch.column(c).to_pylist() for c in ("base", "conv_id", "digest", "bytes")), strict=True)

        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            names = ("digest", "parent", "depth", "bytes", "conv_id", "ends", "shard", "parent_conv_id")
            kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
            columns = {n: pa.array(x, k) for n, x, k in zip(names, zip(*out, strict=True), kinds, strict=True)}
            out.clear()
            return batches(columns)

        members = known.value.members if known is not None else {}
        for conv, path in _rebuilt(rows(), head):
            at, depth, shard, last = ROOT, 0, TOP_SHARD, None
            now = [ROOT, None, 0, 0, conv, True, TOP_SHARD, None]
            for turn, size in path:
                now[5] = False
                out.append(tuple(now))
                parent, depth = at, depth + 1
                at = hashlib.blake2b(at + turn, digest_size=DIGEST).digest()
                above = members.get(parent) if shard == TOP_SHARD else None
                if shard == TOP_SHARD and at not in members:
                    shard = int.from_bytes(at[:8], "little") % n_shards
                now = [at, parent, depth, size, conv, True, shard, above]
                if len(out) >= 8_192:
                    yield flush()
            out.append(tuple(now))
        if out:
            yield flush()

    return map_arrow(dealt, run, PREFIXES)


class Top:
    """The root and the nodes with the most members: digest to smallest member."""

    def __init__(self, members: dict[bytes, int]):
        self.members = members


# Node tables


def accumulate(digests: np.ndarray, parents: np.ndarray, depth: np.ndarray, n_convs: np.ndarray, size: np.ndarray,
               conv: np.ndarray, more: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> dict[str, np.ndarray]:
    """Arrays by slot: parent's slot, smallest member of the parent, children, leaves and saved of the subtree.

    ``more`` are children, leaves and saved that hang below a node outside of the table, in the order of ``digests``.
    """
    names = SlotTable(digests)
    slot, up = names.slots(digests), names.slots(parents)
    n = len(digests)
    parent = np.full(n, -1, np.int64)
    parent[slot] = np.where(depth > 0, up, -1)

    def scattered(values: np.ndarray) -> np.ndarray:
        flat = np.zeros(n, np.int64)
        flat[slot] = values
        return flat

    level, members, own = scattered(depth), scattered(conv), scattered((n_convs - 1) * size)
    children, leaves, saved = (scattered(x) for x in more) if more else (np.zeros(n, np.int64) for _ in range(3))
    saved = saved + own
    inside = parent >= 0
    np.add.at(children, parent[inside], 1)
    leaves = leaves + (children == 0)
    order = np.argsort(-level, kind="stable")
    order = order[inside[order]]
    bounds = np.flatnonzero(np.diff(level[order])) + 1
    for nodes in np.split(order, bounds):
        np.add.at(leaves, parent[nodes], leaves[nodes])
        np.add.at(saved, parent[nodes], saved[nodes])
    above = np.where(inside, members[np.maximum(parent, 0)], -1)
    return {"slot": slot, "inside": inside[slot], "parent_conv_id": above[slot], "n_children": children[slot],
            "n_leaves": leaves[slot], "saved": saved[slot]}


TABLE = ("digest binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, hangs_from binary")


def _node_tables(nodes: DataFrame, shard: str = "shard") -> DataFrame:
    """The accumulated nodes of each shard; ``hangs_from`` is the parent of a shard's uppermost nodes."""

    def run(found: pa.Table) -> pa.Table:
        column = lambda c: found.column(c).combine_chunks()
        ints = {c: column(c).to_numpy(zero_copy_only=False) for c in ("depth", "n_convs", "bytes", "conv_id")}
        more = tuple(column(c).to_numpy(zero_copy_only=False) for c in ("more_children", "more_leaves", "more_saved"))
        got = accumulate(as_pairs(column("digest")), as_pairs(column("parent")), ints["depth"], ints["n_convs"], ints["bytes"],
                         ints["conv_id"], more)
        root = ints["depth"] == 0
        given = column("parent_conv_id")
        up = pa.array(got["parent_conv_id"], mask=~got["inside"])
        return pa.table({
            "digest": column("digest"), "conv_id": column("conv_id"), "depth": column("depth"),
            "parent_conv_id": pa.compute.coalesce(up, given), "n_convs": column("n_convs"),
            "n_children": pa.array(got["n_children"]), "n_leaves": pa.array(got["n_leaves"]), "saved_tokens": pa.array(got["saved"]),
            "hangs_from": pa.compute.if_else(pa.array(~got["inside"] & ~root), column("parent"), pa.scalar(None, pa.binary()))})

    import pyarrow.compute  # noqa: F401

    return nodes.groupBy(shard).applyInArrow(run, TABLE)


def _ends(prefixes: DataFrame) -> DataFrame:
    """digest and ends_sha256 of the nodes at which a conversation ends.

    The ids of a block become one string each, so that the last step reads a string per block and not a row per
    conversation of a node at which very many end.
    """
    blocks = (prefixes.where("ends").groupBy("digest", F.floor(F.col("conv_id") / END_BLOCK).alias("block"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_set("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))
    parts = int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(parts, "digest").sortWithinPartitions("digest", "block")

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in items:
            names, sums = [], []
            for digest, ids in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if digest != now:
                    if now is not None:
                        names.append(now)
                        sums.append(state.hexdigest())
                    now, state = digest, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield batches({"digest": pa.array(names, pa.binary()), "ends_sha256": pa.array(sums, pa.string())})
        if now is not None:
            yield batches({"digest": pa.array([now], pa.binary()), "ends_sha256": pa.array([state.hexdigest()])})

    return map_arrow(dealt, run, "digest binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, head=head_turns, least_top: int = LEAST_TOP, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row per node: digest, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``conversations`` are rows of conv_id, turn, role and text; other columns are ignored. Conversation c is rebuilt from
    the first ``head(c)`` turns of conversation c - c % 5 (the remainder has the sign of c, as in SQL) and its own turns
    after its first ``head(c)``. Turns are in the order of ``turn``, null first; equal ones by the digest of role and text.
    Repeated rows are turns of their own. Null role or text is empty; rows with a null conv_id are no conversation and are
    ignored. An empty table has no nodes. Should two different prefixes share a digest, the query fails.
    """
    spark = conversations.sparkSession
    turns = materialize(_turns(conversations), "trie-turns")
    seen = _prefixes(turns, None, 1, head)
    limit = max(least_top, turns.count() // MOST_TOP_NODES)
    counted = materialize(seen.groupBy("digest").agg(F.count("*").alias("n"), F.min("conv_id").alias("least")), "trie-counts")
    members = {bytes(r.digest): r.least for r in counted.where((F.col("n") > limit) | (F.col("digest") == ROOT)).select("digest", "least").collect()}
    n_shards = 1 + counted.count() // shard_nodes
    prefixes = materialize(_prefixes(turns, Top(members), n_shards, head), "trie-prefixes")

    same = F.struct("parent", "depth", "bytes", "shard", "parent_conv_id")
    nodes = prefixes.groupBy("digest").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                                           F.min(same).alias("same"), F.max(same).alias("other"))
    checked = F.when(F.col("same") != F.col("other"), F.raise_error(F.lit("two prefixes share a digest")).cast("long")).otherwise(F.col("n_convs"))
    nodes = materialize(nodes.select("digest", checked.alias("n_convs"), "conv_id", "same.*"), "trie-nodes")

    none = {f"more_{c}": F.lit(0).cast("long") for c in ("children", "leaves", "saved")}
    below = materialize(_node_tables(nodes.where(F.col("shard") != TOP_SHARD).withColumns(none)), "trie-below")
    hung = below.where("hangs_from is not null").groupBy("hangs_from").agg(
        F.count("*").alias("more_children"), F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
    # At most MOST_TOP_NODES nodes, so this one table is bounded.
    upper = nodes.where(F.col("shard") == TOP_SHARD).join(hung, F.col("digest") == F.col("hangs_from"), "left").drop("hangs_from")
    upper = _node_tables(upper.fillna(0, [f"more_{c}" for c in ("children", "leaves", "saved")]))
    every = below.unionByName(upper).drop("hangs_from")
    none_ends = hashlib.sha256(b"").hexdigest()
    return every.join(_ends(prefixes), "digest", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none_ends)))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("digest")


OP12_SQL = r"""
with recursive turns as (
  select conv_id, coalesce(text, '') as text,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as content,
         row_number() over (partition by conv_id order by turn nulls first, content) - 1 as place
  from conversations where conv_id is not null),
convs as (
  select distinct conv_id, list_reduce(
      list_prepend(cast(4294967295 as bigint), flatten(list_transform(string_split(cast(conv_id as varchar), ''),
                   lambda c: list_prepend(cast(ascii(c) as bigint), [-1, -1, -1, -1, -1, -1, -1, -1])))),
      lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as turned
  from turns),
heads as (select conv_id, xor(turned, 4294967295) % 9 as h from convs),
rebuilt as (
  select h.conv_id, t.place, t.content, t.text from heads h join turns t on t.conv_id = h.conv_id - h.conv_id % 5 where t.place < h.h
  union all select h.conv_id, t.place + 100, t.content, t.text from heads h join turns t on t.conv_id = h.conv_id where t.place >= h.h),
placed as (
  select conv_id, content, octet_length(encode(text)) as bytes, row_number() over (partition by conv_id order by place) as depth from rebuilt),
paths as (
  select conv_id, depth, bytes, sha256(string_agg(content, '') over (partition by conv_id order by depth)) as node,
         depth = max(depth) over (partition by conv_id) as ends from placed
  union all select conv_id, 0, 0, '', conv_id not in (select conv_id from placed) from heads),
nodes as (
  select node, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(bytes) as bytes,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) as ends_sha256
  from paths group by node, depth),
steps as (select distinct a.node as parent, b.node from paths a join paths b on a.conv_id = b.conv_id and b.depth = a.depth + 1),
kids as (select parent, count(*) as n_children from steps group by parent),
under as (select distinct a.node as top, b.node from paths a join paths b on a.conv_id = b.conv_id and b.depth >= a.depth),
sums as (
  select u.top, count(*) filter (k.parent is null) as n_leaves, sum((n.n_convs - 1) * n.bytes) as saved
  from under u join nodes n on n.node = u.node left join kids k on k.parent = u.node group by u.top)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children,
       s.n_leaves, cast(s.saved as bigint) as saved_tokens, n.ends_sha256
from nodes n join sums s on s.top = n.node left join kids k on k.parent = n.node
left join steps t on t.node = n.node left join nodes p on p.node = t.parent
"""
