"""Class n-gram scores: base scores and counts by a plain count, and the class model against its base."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eventlode.llm import brown
from eventlode.llm.brown import class_number, cluster, exchange, mutual_information, op10_brown_scores, pair_counts, score, score_held_out, train

WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text):
    return [w.encode().lower() for w in WORD.findall(text or "")] + [b" "]


def check(rows, texts):
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, t in texts.items() if not held[i] for w in words(t))
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for r in rows:
        w = words(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(w), sum(counts[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)


def test_query_against_plain_count(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op10_brown_scores(spark, sf_dir).collect()
    check(rows, texts)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_small_head_and_odd_texts(spark):
    texts = {i: " ".join(f"W{(i * k) % 23}" for k in range(i % 40)) for i in range(120)}
    texts |= {500: None, 501: "", 502: " \n", None: "w1 w2", 503: "new " * 50_000}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, row int")
    check(score_held_out(docs, head_words=5, clustered_words=3, n_classes=2).collect(), texts)
    assert score_held_out(docs.where("false")).count() == 0


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(f"a{i % 5} b{i % 7} c",) for i in range(50)], "text string")
    model, _ = train(docs, head_words=20, clustered_words=8, n_classes=3)
    assert np.allclose((10**model.transitions).sum(axis=1), 1)
    emitted = np.zeros(5)
    ids = [k for k in range(len(model.counts)) if k != len(model.ids)]
    np.add.at(emitted, model.classes[ids], (model.counts[ids] + 1) / (model.sizes + model.kinds)[model.classes[ids]])
    emitted[model.rest] += 1 / (model.sizes + model.kinds)[model.rest]
    assert np.allclose(emitted[model.sizes > 0], 1)


def test_exchange_separates_contexts():
    # Words 0 and 1 stand before class 2 only, words 2 and 3 after it only.
    after = np.array([[0, 0, 9.0], [0, 0, 9], [0, 0, 0], [0, 0, 0]])
    before = after[::-1].copy()
    pairs = np.array([[0, 0, 15], [0, 0, 3], [3, 15, 0.0]])
    found = exchange(np.array([before, after]), pairs, np.array([0, 0, 1, 0]), np.arange(4), 2)
    assert found.tolist() == [0, 0, 1, 1]


@pytest.mark.parametrize("texts", [
    {i: "" for i in range(5)}, {i: None for i in range(3)}, {i: "only held out" for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2},
    {1: None, **{i: "a b" for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2}}])
def test_no_training_word(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = score_held_out(docs).collect()
    assert len(rows) == len(texts) and all(math.isfinite(r.score) and r.score <= 0 and math.isfinite(r.base_score) for r in rows)
    trained = sum(zlib.crc32(str(i).encode()) % 7 != 2 for i in texts)
    assert {(r.train_tokens, r.n_known > 0) for r in rows} == {(trained, trained > 0)}


def grammar(rows=300):
    """Texts in which three kinds of words take turns, every word in many contexts."""
    rng = np.random.default_rng(1)
    return [" ".join(f"{'xyz'[k % 3]}{rng.integers(12)}" for k in range(rng.integers(3, 40))) for _ in range(rows)]


def test_rounds_find_planted_classes(spark):
    texts = grammar()
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    ids = {f"{c}{k}".encode(): n for n, (k, c) in enumerate((k, c) for k in range(12) for c in "xyz")}
    pairs = pair_counts(docs, ids).cache()
    plain = Counter()
    for t in texts:
        own = [37, *[ids[w.encode()] for w in t.split()], 37]
        plain.update(zip(own, own[1:]))
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(plain)
    # Classes of the right kinds tell the next word's class almost surely; dealt ones are one rank apart and tell nothing.
    order = np.random.default_rng(2).permutation(36)
    mixed = pairs.select(*[spark_map(c, order) for c in "ab"], "n")
    classes, counts = cluster(mixed, 36, 3, 0.01)
    kinds = [{int(classes[order[k]]) for k in range(36) if k % 3 == c} for c in range(3)]
    assert all(len(x) == 1 for x in kinds) and len(set.union(*kinds)) == 3
    assert counts.sum() == sum(plain.values()) and mutual_information(counts) > 0.9


def spark_map(column, order):
    from pyspark.sql import functions as F

    return F.element_at(F.array(*[F.lit(int(x)) for x in [*order, 36, 37]]), F.col(column) + 1).alias(column)


def test_class_number_grows_with_the_vocabulary():
    assert [class_number(n) for n in (0, 1, 16, 400, 10_000, 200_000)] == [2, 2, 2, 10, 50, 223]


def test_scores_equal_a_plain_class_model(spark):
    texts = {i: t for i, t in enumerate([*grammar(60), "", None, "never seen x1", "x1 x1"])}
    docs = spark.createDataFrame([(i, t, False) for i, t in texts.items()], "doc_id long, text string, held_out boolean")
    model, counts = train(docs.select("text"), least_count=3)
    kind = lambda w: model.end if w == b" " else int(model.classes[model.ids[w]]) if w in model.ids else model.rest
    seen = Counter(w for t in texts.values() for w in words(t))
    assert all(kind(w) < model.rest for w, n in seen.items() if n >= 3 and w != b" ")
    follow, sizes, members = Counter(), Counter(), Counter(kind(w) for w in seen)
    members[model.rest] += 1
    for t in texts.values():
        own = [model.end, *map(kind, words(t))]
        follow.update(zip(own, own[1:]))
        sizes.update(own[1:])
    total = Counter()
    for (a, _), n in follow.items():
        total[a] += n
    n_classes = len(model.sizes)
    for r in score(docs, model, counts).collect():
        own, expected, before = words(texts[r.doc_id]), 0.0, model.end
        for w in own:
            k = kind(w)
            expected += math.log10((follow[before, k] + 0.5) / (total[before] + 0.5 * n_classes))
            expected += math.log10((seen[w] + 1) / (sizes[k] + members[k]))
            before = k
        assert r.score == pytest.approx(expected, rel=1e-9)


def random_docs(spark, kinds, texts=40, length=600):
    rng = np.random.default_rng(4)
    rows = [" ".join(f"w{k}" for k in rng.integers(kinds, size=length)) for _ in range(texts)]
    ids = {f"w{k}".encode(): k for k in range(kinds)}
    plain = Counter()
    for t in rows:
        own = [kinds + 1, *[ids[w.encode()] for w in t.split()], kinds + 1]
        plain.update(zip(own, own[1:]))
    return spark.createDataFrame([(t,) for t in rows], "text string").repartition(2), ids, plain


def sides(near, size):
    bits = size.bit_length()
    plain = lambda raw: sorted((int(x) & ((1 << bits) - 1), int(x) >> bits) for x in np.frombuffer(raw, np.int64))
    rows = near.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (plain(r.before), plain(r.after)) for r in rows}


def test_pairs_travel_many_to_a_row(spark, monkeypatch):
    docs, ids, plain = random_docs(spark, 300)
    moved, gathered = [], brown._gathered
    monkeypatch.setattr(brown, "_gathered", lambda dealt, size: (moved.append(dealt.count()), gathered(dealt, size))[1])
    assert {(r.a, r.b): r.n for r in pair_counts(docs, ids).collect()} == dict(plain)
    assert 0 < 20 * sum(moved) < len(plain)


def test_neighbours_of_a_frequent_word_in_parts(spark, monkeypatch):
    docs, ids, plain = random_docs(spark, 30)
    expected = {w: (sorted((a, n) for (a, b), n in plain.items() if b == w), sorted((b, n) for (a, b), n in plain.items() if a == w))
                for w in (*range(30), 31)}
    often = np.array([*[sum(n for (_, b), n in plain.items() if b == w) for w in range(30)], 0, 40])
    encoded = brown.encode(docs, ids)
    assert sides(brown.encoded_neighbours(encoded, often), 32) == expected
    monkeypatch.setattr(brown, "BUCKET_WORDS", int(np.median(often)))
    assert sides(brown.encoded_neighbours(encoded, often), 32) == expected


def test_words_are_cut_and_lowered_as_bytes():
    texts = ["Xx yÉ", None, "", " \t\n\x0b\x0c\r", "A\x1cB\x85c\x00D İZ\u2003q", " z  Z\n"] * 3
    for column in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["Front Ö"] * 50 + texts)[50:]):
        found, row = brown._split(column)
        assert list(zip(row.tolist(), found.cast(pa.large_binary()).to_pylist())) == [
            (k, w) for k, t in enumerate(texts) for w in (t or "").encode().lower().split()]


@pytest.mark.parametrize("head", [0, 1, 4, 7, 50])
def test_most_frequent_words_by_count_then_word(spark, head):
    texts = ["b a c d", "b a", "b d e f g"]
    _, ids, n = brown.vocabulary(spark.createDataFrame([(t,) for t in texts], "text string"), head)
    ranked = sorted(Counter(" ".join(texts).split()).items(), key=lambda x: (-x[1], x[0]))[:head]
    assert ([*ids], n.tolist()) == ([w.encode() for w, _ in ranked], [k for _, k in ranked])
