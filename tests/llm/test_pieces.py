"""Encoding and decoding against the sentencepiece library."""

import random

import pytest
import sentencepiece

from eventlode.llm.pieces import Transducer, decode_pieces, default_model, encode_pieces, op2_sentencepiece


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=default_model())


def test_query_against_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op2_sentencepiece(spark, sf_dir).collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids)


def test_random_texts(library):
    machine, rng = Transducer.load(default_model()), random.Random(2)
    vocabulary = [library.id_to_piece(k).replace("▁", " ") for k in range(259, 32_000)]
    alphabet = [" ", "  ", "    ", "a", "the", "ing", "é", "ß", "日", "😀", "\n", "\t", "0", "1", "ab", "</s>", "<0x41>", "­", "ñ", ".", ",,"]
    for k in range(4000):
        text = "".join(rng.choice(vocabulary if k % 2 else alphabet) for _ in range(rng.randrange(12)))
        ids = machine.encode(text)
        assert ids == library.encode(text), repr(text)
        assert machine.decode(ids) == library.decode(ids) == text, repr(text)


def test_unigram_path_is_the_shortest():
    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("ab", -4.0, 1), ("▁a", -4.5, 1), ("bb", -3.5, 1)]
    machine = Transducer(pieces, True, True, True)
    assert [pieces[k][0] for k in machine.encode(" abb ")] == ["▁a", "bb"]
    assert machine.encode("az") == [5, 0] and machine.encode("") == []


def test_odd_rows(spark, library):
    texts = [None, "", " ", "x" * 5_000, "word " * 60_000, "▁"]
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)] + [(None, "a b", 0)] * 2, "doc_id long, text string, ids int")
    rows = {r.doc_id: r for r in encode_pieces(docs).collect()}
    for k, t in enumerate(texts[:5]):
        assert rows[k].ids == library.encode(t or "") and rows[k].round_trip
    assert not rows[5].round_trip and rows[None].n_tokens == len(library.encode("a b"))
    back = {r.doc_id: r.text for r in decode_pieces(encode_pieces(docs)).collect()}
    assert [back[k] for k in range(5)] == [t or "" for t in texts[:5]]
    assert encode_pieces(docs.where("false")).count() == 0


def test_long_runs_of_marks(library):
    machine, rng = Transducer.load(default_model()), random.Random(3)
    for text in [" " * 100_000, "a" + " " * 30_001 + "b", *(" " * rng.randrange(200) + "x" + " " * rng.randrange(200) for _ in range(50))]:
        assert machine.encode(text) == library.encode(text)
    # Parts without a path of weight 0 are merged too.
    for part in ("=" * 5_000, "ab" * 3_000, "".join(rng.choice("aeinst") for _ in range(3_000))):
        assert [machine.arcs.get(x) for x in machine.merged("▁" + part)] == library.encode(part)
