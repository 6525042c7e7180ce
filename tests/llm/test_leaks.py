"""Benchmark leaks against a plain comparison of all texts with all items, and paraphrases."""

import random

import numpy as np

from eventlode.llm.leaks import _sketch, common_length, drop_leaks, find_leaks, op1_decontamination


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def test_common_length():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(70))] for _ in range(2))
        assert common_length(a, b) == plain_common(a, b)


def test_query_finds_every_exact_leak(spark, sf_dir):
    docs = {r.doc_id: r.text.lower().split() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: r.text.lower().split() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id): r for r in op1_decontamination(spark, sf_dir).collect()}
    want = {(d, i) for d, words in docs.items() for i, item in items.items()
            if f" {' '.join(item)} " in f" {' '.join(words)} "}
    assert want and want <= set(found)
    for (d, i), r in found.items():
        # Whatever is reported has its share of common words; clean documents are left alone.
        assert r.common >= 0.45 and common_length(items[i], docs[d]) / len(items[i]) >= r.common - 1e-9


def test_paraphrases_and_odd_rows(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(900)] + ["the", "of", "and"] * 40

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    items = [(k, f"What is {prose(22)}? It is {prose(6)}.") for k in range(30)] + [(90, None), (91, ""), (92, items_ := "short item")]
    rows, want = [], set()
    for k in range(400):
        text = prose(rng.choice((20, 80, 300)))
        if k % 4 == 0:
            item = items[k % 30]
            parts = item[1].split()
            for _ in range(4):
                parts[rng.randrange(len(parts))] = "changed"
            text = f"{prose(40)} {' '.join(parts)} {prose(40)}"
            want.add((k, item[0]))
        rows.append((k, text, "x"))
    rows += [(500, None, "x"), (501, "", "x"), (None, items[3][1], "x"), (502, prose(60_000), "x"), (503, items[5][1], "x"), (503, items[5][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = [(r.doc_id, r.item_id) for r in find_leaks(docs, benchmark).collect()]
    assert want <= set(found) and found.count((503, 5)) == 2 and (None, 3) in found
    assert not {d for d, _ in found} - {d for d, _ in want} - {None, 503}
    kept = drop_leaks(docs, benchmark)
    assert sorted(kept.columns) == sorted(docs.columns) and kept.count() == len(rows) - len(want) - 2
    assert find_leaks(docs.where("false"), benchmark).count() == 0 == find_leaks(docs, benchmark.where("false")).count()
    assert items_ and np.isfinite([r.cosine for r in find_leaks(docs.limit(5), benchmark).collect()]).all()


def test_item_in_a_third_of_the_rows(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(900)] + ["the", "of", "and"] * 40

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    items = [(k, f"What is {prose(22)}? It is {prose(6)}.") for k in range(20)] + [(20, "w1 w2")]
    copy, parts = items[3][1], items[3][1].split()
    rows = []
    for k in range(600):
        # Copies of the item alone, near copies with a line of their own, and paraphrases between other items' words.
        changed = " ".join("other" if n % 4 == 3 else w for n, w in enumerate(parts))
        text = (copy, f"{copy} {prose(3)}", f"{prose(30)} {changed} {prose(30)}")[k // 3 % 3] if k % 3 == 0 else prose(60)
        rows.append((k, text))
    rows += [(900, f"{prose(30)} {items[7][1]} {prose(30)}"), (901, items[20][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(k, 3) for k in range(0, 600, 3)} | {(900, 7), (901, 20)} <= found
    texts = {k: t.lower().split() for k, t in rows}
    for d, i in found:
        item = items[i][1].lower().split()
        assert common_length(item, texts[d]) >= 0.45 * len(item)


def test_leaking_passage_before_a_longer_one(spark):
    question, answer = [f"q{k}" for k in range(32)], [f"a{k}" for k in range(8)]
    item = f"{' '.join(question)}? {' '.join(answer)}."
    filler = " ".join(f"x{k}" for k in range(300))
    # 22 of 40 words without the answer; elsewhere 20 of 40 with all of it.
    text = f"{' '.join(question[:22])} {filler} {' '.join(question[20:31])} {question[31]}? {' '.join(answer)}."
    docs = spark.createDataFrame([(1, text), (2, f"{' '.join(question[:22])} {filler}")], "doc_id long, text string")
    found = find_leaks(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.common, r.answer, r.leaked) for r in found] == [(1, 0.5, 1.0, True)]


def test_directions_come_from_all_texts(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('w', id % 7, ' w', 7 + id % 11, ' other') AS text")
    ids = {f"w{k}".encode(): k for k in range(18)}
    test = np.random.default_rng(1).standard_normal((18, 5)).astype(np.float32)
    sums, seen, passages = _sketch(docs, ids, test)
    k = np.arange(30_000)
    held = np.zeros((30_000, 18))
    held[k, k % 7] = held[k, 7 + k % 11] = 1
    assert passages == 30_000 and seen.tolist() == held.sum(axis=0).tolist()
    assert np.allclose(sums, held.T @ (held @ test), rtol=1e-3, atol=1)
