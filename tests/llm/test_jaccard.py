"""Jaccard components against all pairs, and edge cases."""

import random
import re

import numpy as np
import pytest

from eventlode.llm.components import components
from eventlode.llm.jaccard import jaccard_components, keep_one_of_each, op9_jaccard_join, parity

WORD = re.compile("[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def all_pairs(texts, size, percent):
    ids = sorted(texts)
    sets = {i: shingles(texts[i], size) for i in ids}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    met = {(a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1 :]}
    for a, b in met:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(found, texts, size, percent):
    rows = found.collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == all_pairs(texts, size, percent)


def test_query_against_all_pairs(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check(op9_jaccard_join(spark, sf_dir), texts, 3, 90)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_random_copies(spark, size, percent):
    rng = random.Random(size)
    texts = {}
    for group in range(12):
        base = [rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(rng.choice((4, 30, 90)))]
        for _ in range(rng.choice((1, 3, 20))):
            words = list(base)
            for _ in range(rng.choice((0, 1, 2, 4))):
                words[rng.randrange(len(words))] = "Z" + str(rng.randrange(9))
            texts[len(texts)] = " ".join(words).upper() if rng.random() < 0.2 else "  ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(jaccard_components(docs, size, percent, sketch_bits=12), texts, size, percent)


def test_odd_texts(spark):
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
    rows = [(1, None, "k"), (2, "", "k"), (3, "one", "k"), (4, "ONE", "k"), (5, "one two", "k"), (6, "one two", "k"), (6, "one two", "k"),
            (7, long, "k"), (8, long + " tail", "k"), (None, "one two", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token string")
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_components(docs, 3, 90).collect())
    assert [x for x in found if x[0] < 7] == [(0, 1, 5), (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3), (5, 1, 5), (6, 1, 5), (6, 1, 5)]
    assert [x[2] for x in found if x[0] >= 7] == [7, 7]
    kept = keep_one_of_each(docs, 3, 90)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 5, 7]
    assert jaccard_components(docs.where("false")).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(10, 60)]
    star = [(100, 100 + i) for i in range(1, 40)] + [(101, 101), (None, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert found == {i: 10 for i in range(10, 61)} | {i: 100 for i in range(100, 140)}


def test_parity_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for n, same in ((0, 0), (5, 5), (60, 40), (500, 450), (5_000, 100)):
        both, own, other = (np.unique(rng.integers(0, 2**63, k).astype(np.uint64)) for k in (same, n - same, n - same))
        x, y = np.unique(np.r_[both, own]), np.unique(np.r_[both, other])
        apart = sum(int(v).bit_count() for v in (parity(x) ^ parity(y)).view(np.uint64))
        assert apart <= len(np.setxor1d(x, y)) and (n != 60 or apart > 20)
    assert (parity(np.zeros(0, np.uint64)) == 0).all()
