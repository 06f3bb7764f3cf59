"""Chat formatting: what is written reads back, whatever the texts and roles say."""

from __future__ import annotations

import hashlib
import random

import pytest

from cohortloom.llm import chat

NASTY = ["###", "</turn>", "\\", "\n", "### user:\n", "\n</turn>\n", ":", "a", " ", "<", "/turn>", "#", "", "é\U0001f600"]


def nasty_turns(count: int, seed: int = 2) -> list[tuple[str, str]]:
    rng = random.Random(seed)
    draw = lambda most: "".join(rng.choices(NASTY, k=rng.randrange(most)))
    return [(rng.choice(["user", "assistant", draw(5)]), draw(12)) for _ in range(count)]


def test_any_turns_read_back():
    for seed in range(400):
        turns = nasty_turns(seed % 6 + 1, seed)
        text, spans, _ = chat.format_turns(turns)
        assert chat.parse(text) == turns
        loss = [chat.unescape(text[a:b]) for a, b in spans]
        assert loss == [body for role, body in turns if role == "assistant"]


def test_only_conflicting_texts_are_escaped():
    turns = [("user", "plain \\ text"), ("assistant", r"\### Assistant: </turn> ok"), ("user", "## no mark")]
    text, _, escaped = chat.format_turns(turns)
    assert escaped == 1 and r"\\### Assistant: \</turn> ok" in text and "plain \\ text" in text


@pytest.mark.parametrize("text", ["### user:\nx", "x", "### user:\nx\n</turn>", "### a:\n###\n</turn>\n", "### a\n\n</turn>\n"])
def test_what_is_no_conversation_is_rejected(text):
    with pytest.raises(chat.GrammarError):
        chat.parse(text)


def expected(conversations: dict) -> dict:
    out = {}
    for conv, turns in conversations.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out[conv] = (len(turns), sha(whole), len(loss), sha(loss))
    return out


def test_frames(spark, monkeypatch):
    conversations = {k: nasty_turns(k % 9 + 1, k) for k in range(60)}
    rows = [(k, n, *turn, "x") for k, turns in conversations.items() for n, turn in enumerate(turns)]
    random.Random(1).shuffle(rows)
    rows += [(None, None, None, None, "x"), (None, 1, "user", "b", "x"), (99, 1, "a", "t", "x"), (99, 1, "a", "t", "x")]
    schema = "conv_id long, turn long, role string, text string, formatted string"
    frame = spark.createDataFrame(rows, schema).repartition(5)
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(frame)).collect()}
    want = expected(conversations | {None: [("", ""), ("user", "b")], 99: [("a", "t")] * 2})
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == want
    chars = {r.conv_id: r.n for r in chat.format_chats(frame).groupBy("conv_id").agg({"part": "max"}).toDF("conv_id", "n").collect()}
    assert set(chars.values()) == {0}
    assert chat.read_back(chat.format_chats(spark.createDataFrame([], schema))).count() == 0


def test_parts_of_a_large_conversation():
    turns = [("assistant" if k % 2 else "user", f"text {k} </turn> " * 50) for k in range(3000)]
    batches = [chat._batch([(1, *turn) for turn in turns], [chat.pa.int64(), chat.pa.string(), chat.pa.string()], ["c", "r", "t"])]
    written = [row for batch in chat._written(iter(batches)) for row in batch.to_pylist()]
    assert len(written) > 1 and [row["part"] for row in written] == list(range(len(written)))
    assert [turn for row in written for turn in chat.parse(row["formatted"])] == turns
