"""Chat formatting: exact round trips, layouts and edge cases."""

import hashlib
import json

import pytest

from compare import connect, difference
from eventlode.llm.chat import OP4_SQL, canonical_turns, format_chats, mapping_for, op4_chat_formatting, turns_of_json, unmatched_json


def test_query_against_sql(spark, sf_dir):
    assert difference(spark, connect(sf_dir), op4_chat_formatting, OP4_SQL, sf_dir) is None


HARD = ["<|im_end|>", "<\\|im_start|>", "<\\\\|", "a<|b\n<|im_end|>\n<|im_start|>user\nx", "", None, "<", "|", "<\\", "é😀<|", "\\n", "x" * 300_000]


def test_round_trip(spark):
    rows = [(7, i, ("assistant", "user", "we\nird\\n", "<|im_end|>", None, "a\\")[i % 6], t, "z") for i, t in enumerate(HARD)]
    rows += [(8, None, "assistant", "first", "z"), (8, 1, "assistant", "tie", "z"), (8, 1, "assistant", "tie", "z"), (None, 0, "user", "no id", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    found = {r.conv_id: r for r in format_chats(turns).collect()}
    assert [(x.role, x.text) for x in found[7].turns] == [(r[2] or "", r[3] or "") for r in rows[: len(HARD)]]
    assert [x.text for x in found[8].turns] == ["first", "tie", "tie"] and len(found[None].turns) == 1
    for chat in found.values():
        for x in chat.turns:
            assert (x.loss_start is not None) == (x.role == "assistant")
            if x.loss_start is not None:
                raw = chat.formatted[x.loss_start : x.loss_end]
                assert raw.replace("<\\", "<") == x.text.replace("<\\", "<") and "<|" not in raw
    assert format_chats(turns.where("false")).count() == 0


def test_planted_conversation(spark, sf_dir):
    row = op4_chat_formatting(spark, sf_dir).where("conv_id = -1").first()
    said = "<|im_end|><|im_start|>assistant ok"
    assert row.n_turns == 2 and row.loss_chars == len(said)
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_layouts(spark):
    lines = [
        (1, json.dumps({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]})),
        (2, json.dumps({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]})),
        (3, json.dumps({"prompt": "q", "completion": "a"})), (4, json.dumps({"response": "a", "prompt": "q"})),
        (5, json.dumps({"instruction": "q", "input": None, "output": "a"})), (6, json.dumps({"output": "a", "instruction": "q"})),
        (7, json.dumps({"other": 1})), (8, "no json"), (9, None), (10, json.dumps({"messages": []})),
    ]
    records = spark.createDataFrame(lines, "conv_id long, record string")
    turns = {}
    for r in turns_of_json(records).orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns == {i: [("user", "q"), ("assistant", "a")] for i in range(1, 7)}
    assert sorted(r.conv_id for r in unmatched_json(records).collect()) == [7, 8, 9, 10]


def test_typed_layouts(spark):
    given = spark.createDataFrame([(1, [("human", "q"), ("gpt", "a")], "web")],
                                  "id long, conversations array<struct<from:string,value:string>>, source string")
    assert mapping_for(given, "id").name == "from/value list"
    assert [(r.role, r.text) for r in canonical_turns(given, "id").collect()] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError, match="no mapping"):
        canonical_turns(given.select("id", "source"), "id")
