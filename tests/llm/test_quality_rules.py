"""Quality cascade against a plain count, and its edge cases."""

import re
from collections import Counter

from eventlode.llm.quality import RULES, Measures, estimate, keep_quality, measure_quality, op8_quality_rules, ordered

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def test_query_against_plain_count(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op8_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(texts[r.doc_id])
        assert not (r.kept and r.base_failed)
    assert sum(r.kept for r in rows) > len(rows) / 2


def test_odd_texts(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    texts = [None, "", " \n\t", "a b", "x y z", "é ü ß", "\n".join(["same line here"] * 30), long, long + " " + long]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "x"), (1, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    found = measure_quality(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, t in enumerate(texts):
        r = by_id[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(t)
    kept = keep_quality(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [7]
    assert measure_quality(docs.limit(0)).count() == 0 == keep_quality(docs.where("false")).count()


def test_order_by_rejections_per_cost():
    figures = [{"rule": r.name, "seconds": 1.0, "rejected": k} for k, r in enumerate(RULES)]
    assert [r.name for r in ordered(RULES, figures)] == [r.name for r in reversed(RULES)]
    assert ordered(RULES, []) == RULES
    assert Measures("STOP NOW " .encode() * 3).upper_share == 1.0


def test_estimate_counts_like_a_plain_loop(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = [r.text or "" for r in docs.collect()]
    for figures in (estimate(docs, sample_rows=len(texts)), estimate(docs.repartition(7), sample_rows=2 * len(texts))):
        found = {f["rule"]: (f["rejected"], f["tried"]) for f in figures}
        assert found == {r.name: (sum(bool(r.rejects(Measures(t.encode()))) for t in texts), len(texts)) for r in RULES}
    some = estimate(docs.repartition(5), sample_rows=50)
    assert {f["tried"] for f in some} == {50}
    assert {f["tried"] for f in estimate(docs.where("false"))} == {0}
    # One id for all rows: no task measures more than the sample's size.
    same = docs.selectExpr("cast(null as long) as doc_id", "text").repartition(3)
    assert {f["tried"] for f in estimate(same, sample_rows=20)} == {60}


def test_kept_is_what_no_rule_rejects(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op8_quality_rules(spark, sf_dir).collect()
    assert all(r.kept == (not any(x.rejects(Measures((texts[r.doc_id] or "").encode())) for x in RULES)) for r in rows)
