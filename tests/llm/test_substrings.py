"""Repeated windows against a plain dictionary, and edge cases."""

import hashlib
import random
import re

import pytest

from eventlode.llm import substrings
from eventlode.llm.substrings import op6_substring_dedup, remove_repeats

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain(texts, size=20):
    first, words = {}, {i: WORD.findall(t or "") for i, t in texts.items()}
    for i in sorted(words):
        for s in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][s : s + size]), (i, s))
    out = {}
    for i, w in words.items():
        gone = {k for s in range(len(w) - size + 1) if first[tuple(w[s : s + size])] != (i, s) for k in range(s, s + size)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def check(rows, texts, size=20):
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == plain(texts, size)


def test_query_against_dictionary(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check(op6_substring_dedup(spark, sf_dir).collect(), texts)


@pytest.mark.parametrize("few", [5_000, 3])
def test_random_repeats(spark, monkeypatch, few):
    # A low bound sends most suffixes through the longer prefixes.
    monkeypatch.setattr(substrings, "FEW", few)
    rng = random.Random(6)
    shared = [[f"p{k}w{rng.randrange(60)}" for _ in range(rng.choice((19, 20, 21, 45)))] for k in range(6)]
    texts = {}
    for i in range(150):
        words = []
        for _ in range(rng.randrange(5)):
            words += rng.choice(shared) if rng.random() < 0.6 else [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(30))]
        texts[i * 7 % 151] = " ".join(words)
    texts[200] = "same " * 60
    texts[201] = "same " * 25 + "end"
    texts[202] = texts[200]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    check(remove_repeats(docs).collect(), texts)


def test_odd_texts(spark):
    line = " ".join(f"w{i}" for i in range(30))
    long = " ".join(f"x{i % 5000}" for i in range(60_000))
    rows = [(1, None, 0), (2, "", 0), (3, "few words", 0), (4, line, 0), (4, line, 0), (5, line, 0), (None, line, 0), (6, long, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    found = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in remove_repeats(docs).collect())
    assert [x[:3] for x in found] == [(0, 30, 0), (1, 0, 0), (2, 0, 0), (3, 2, 0), (4, 30, 0), (4, 30, 0), (5, 30, 30), (6, 60_000, 55_000)]
    assert found[0][3] == line and found[3][3] == "few words" and found[6][3] == ""
    assert remove_repeats(docs.where("false")).count() == 0
