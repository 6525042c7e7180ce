"""The prefix trie against SQL and a trie of nested dictionaries."""

import hashlib

import numpy as np
import pytest

from compare import connect, difference
from eventlode.llm.prefix_trie import OP12_SQL, SlotTable, head_turns, op12_prefix_trie, prefix_trie


def test_query_against_sql(spark, sf_dir):
    assert difference(spark, connect(sf_dir), op12_prefix_trie, OP12_SQL, sf_dir) is None


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(rows, head=head_turns):
    def content(r):
        role, text = r[2] or "", r[3] or ""
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()

    own = {}
    for r in rows:
        if r[0] is not None:
            own.setdefault(r[0], []).append(r)
    for turns in own.values():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, content(r)))
    members = {}
    paths = {}
    for c, turns in own.items():
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        path = [((r[2] or ""), (r[3] or "")) for r in own.get(base, [])[: head(c)] + turns[head(c) :]]
        paths[c] = tuple(path)
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in m if paths[c] == p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])),
                    sum(q not in children for q in below),
                    sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(trie):
    return sorted((tuple(r[c] for c in COLUMNS) for r in trie.collect()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string, digest string, shard int"


@pytest.mark.parametrize("least_top,shard_nodes", [(1_000, 200_000), (3, 20), (0, 1), (10**9, 7)])
def test_random_tables(spark, least_top, shard_nodes):
    rng = np.random.default_rng(least_top % 97 + shard_nodes)
    rows = []
    for c in [*range(-12, 60), 10_000, 10_003, 2**40]:
        for t in range(int(rng.integers(1, 13))):
            turn = None if rng.random() < 0.1 else int(rng.integers(0, 8))
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "é", "", None, "long " * 9]), "z", 1))
    rows += rows[:5] + [(None, 0, "user", "lost", "z", 1)]
    rows += [(c, t, "user", "same", "z", 1) for c in range(100, 180) for t in range(4)]
    rows = [tuple(str(x) if isinstance(x, np.str_) else x for x in r) for r in rows]
    given = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(prefix_trie(given, least_top=least_top, shard_nodes=shard_nodes)) == by_hand(rows)


def test_long_and_empty(spark):
    rows = [(7, t, "user", "x", "z", 1) for t in range(20_000)] + [(8, 0, "user", "x" * 200_000, "z", 1)]
    trie = prefix_trie(spark.createDataFrame(rows, SCHEMA), head=lambda c: 0, least_top=0)
    assert trie.count() == 20_002
    top = trie.where("depth = 0").first()
    assert (top.n_convs, top.n_children, top.n_leaves, top.saved_tokens, top.conv_id) == (2, 2, 2, 0, 7)
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    # Every own turn is replaced and the first of the block is absent: a conversation without turns.
    bare = found(prefix_trie(spark.createDataFrame([(6, 0, "user", "x", "z", 1)], SCHEMA), head=lambda c: 5))
    assert bare == [(6, 0, None, 1, 0, 1, 0, hashlib.sha256(b"6").hexdigest())]


def test_slots():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = rng.integers(0, 2**63, (n, 2)).astype(np.uint64)
        names = SlotTable(keys)
        assert sorted(names.slots(keys)) == list(range(n)) and names.n == n
        assert (names.slots(rng.integers(0, 2**63, (500, 2)).astype(np.uint64)) == -1).all()
    with pytest.raises(ValueError, match="repeat"):
        SlotTable(np.zeros((2, 2), np.uint64))
