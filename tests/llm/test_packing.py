"""Packing: every id in one piece, no padding, and the level that a plain search over all windows takes."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventlode.llm.packing import Levels, Packer, default_tokenizer, ids_of, op11_sum_of_squares_packing, pack_documents, sequences


@pytest.fixture(scope="module")
def plain():
    own = Tokenizer.from_file(default_tokenizer())
    return lambda text: own.encode(text or "", add_special_tokens=False).ids + [0]


def held(rows, docs, plain, window=1024):
    """The pieces against the documents' ids; ``docs`` is (doc_id, text) with distinct ids."""
    pieces, sequence = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequence.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == {d for d, _ in docs}
    for doc_id, text in docs:
        ids, at = plain(text), 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            part = np.array(ids[at : at + r.length], "<u4")
            assert r.start == at and r.length == len(part) > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(ids)
    for group in sequence.values():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window and at & (at - 1) == 0
    return sequence


def test_query(spark, sf_dir, plain):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = held(op11_sum_of_squares_packing(spark, sf_dir).collect(), docs, plain)
    total = sum(len(plain(t)) for _, t in docs)
    short = [g for g in found.values() if sum(r.length for r in g) < 1024]
    assert len(found) < total / 1024 + 200 and len(short) < 200


HARD = ["", None, "<|endoftext|> a<|endoftext|>", "é" * 5_000, " " * 50_000, "a" * 30_000, "日本語 テキスト", "͸ \U0001faf8", "1" * 9_000,
        "don't  stop\r\n\t\x1c x y᠎z", "word " * 3_000, "x", "x"]


def test_hard_texts(spark, plain):
    rows = [(k, t, "z", 5) for k, t in enumerate(HARD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, start int").coalesce(2)
    packed = pack_documents(docs)
    held(packed.collect(), [(r[0], r[1]) for r in rows], plain)
    whole = sequences(packed).collect()
    assert all(len(r.input_ids) == r.n_tokens for r in whole)
    assert sum(r.n_tokens for r in whole) == sum(len(plain(t)) for t in HARD)


def test_small_windows_and_repeats(spark, plain):
    docs = spark.createDataFrame([(k, "w " * (k % 37)) for k in range(400)], "doc_id long, text string").repartition(3)
    held(pack_documents(docs, window=16, most_open=5).collect(), [(r.doc_id, r.text) for r in docs.collect()], plain, 16)
    again = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], "doc_id long, text string")
    found = pack_documents(again)
    assert found.where("doc_id = 1").agg(F.sum("length")).first()[0] == 2 * len(plain("a b"))
    assert found.where("doc_id is null").agg(F.sum("length")).first()[0] == len(plain("c")) + 1
    assert pack_documents(again.where("false")).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        pack_documents(again, window=1000)


def test_fast_engine_gives_the_same_ids(spark, sf_dir, plain):
    ids = ids_of(default_tokenizer())
    assert ids.fast is not None
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        assert [*ids.of(r.text or ""), 0] == plain(r.text)


def test_levels_against_a_plain_search():
    rng = np.random.default_rng(7)
    levels, counts = Levels(32), [0] * 33
    weigh = lambda c: sum(n * n for k, n in enumerate(c[1:32], 1) if k & (k - 1))

    def after(level, size):
        c = list(counts)
        c[level] -= level > 0
        c[level + size] += 1
        return weigh(c)

    for size in rng.integers(1, 32, 2_000):
        size = int(size)
        able = [k for k in range(33 - size) if k == 0 or counts[k]]
        best = min(after(k, size) for k in able)
        took = levels.place(size)
        assert took == max(k for k in able if after(k, size) == best)
        counts[took] -= took > 0
        counts[took + size] += took + size < 32
        assert list(levels.counts[1:32]) == counts[1:32] and levels.sum_of_squares() == weigh(counts)


def test_windows_held_are_bounded():
    packer = Packer(64, 10)
    for k in range(1_000):
        packer.add((k, 40), np.full(40, k, np.uint32))
        assert packer.n_open <= 10
    packer.finish()
    assert sum(len(p[2]) for s in packer.take() for p in s) == 40_000
