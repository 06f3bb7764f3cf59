"""Byte-level BPE against tiktoken and against the library's own output and offsets."""

from __future__ import annotations

import base64
import random
import sys

import llm_cases as cases
import numpy as np
import pyarrow as pa
import pytest
import tiktoken

from cohortloom.llm import bpe
from cohortloom.llm.catalogue import ENGLISH, MULTILINGUAL
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def oracle():
    with open(MULTILINGUAL.path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=MULTILINGUAL.pattern, mergeable_ranks=ranks, special_tokens={})


def random_texts(count: int) -> list[str]:
    rng = random.Random(5)
    letters = " \n\t  aAeé'sß漢\U0001f600.,!  \x1c\x85019_-"
    return ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(count)]


def test_every_case_as_tiktoken(oracle):
    own = bpe.codec(MULTILINGUAL)
    texts = [t or "" for _, t in cases.TEXTS] + random_texts(3000)
    got = [np.frombuffer(b, "<u4").tolist() for b in own.encode_all(texts)]
    assert got == [oracle.encode_ordinary(t) for t in texts]
    assert [own.decode(np.array(ids, "int64")) for ids in got] == [t.encode() for t in texts]


def test_every_kind_of_code_point(oracle):
    points = [c for c in range(0, sys.maxunicode + 1, 17) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}1{chr(c)}! {chr(c)}{chr(c)}  b\n{chr(c)}" for c in points]
    got = bpe.Codec(bpe.codec(MULTILINGUAL).tokenizer, MULTILINGUAL.pattern).encode_all(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [oracle.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("vocabulary", [MULTILINGUAL, ENGLISH])
def test_ids_and_offsets_as_the_library(vocabulary):
    own = bpe.codec(vocabulary)
    for text in [t or "" for _, t in cases.TEXTS if t is not cases.LONG] + random_texts(500):
        whole = (own.whole or own.tokenizer).encode(text, add_special_tokens=False)
        ids = np.frombuffer(own.encode(text), "<u4").astype("int64")
        assert ids.tolist() == whole.ids
        starts, ends = own.offsets(text, ids)
        assert "".join(text[a:b] for a, b in sorted(set(zip(starts.tolist(), ends.tolist(), strict=True)))) or not text
        raw = [own.bytes_of[i] for i in ids]
        for a, b, piece in zip(starts, ends, raw, strict=True):
            assert piece in text[a:b].encode()


def test_small_dictionaries_change_nothing():
    own = bpe.codec(ENGLISH)
    tight = bpe.Codec(own.tokenizer, ENGLISH.pattern, cache=3)
    texts = random_texts(300)
    assert [tight.encode_all(texts[k : k + 7]) for k in range(0, 300, 7)] == [
        own.encode_all(texts[k : k + 7]) for k in range(0, 300, 7)
    ]
    assert len(tight.words) <= 3 and len(tight.pieces) <= 3


def test_frames(spark):
    docs = cases.with_clashes(spark)
    back = bpe.decode(bpe.encode(docs, MULTILINGUAL, offsets=True), MULTILINGUAL)
    assert {"starts", "ends", "raw", "a.b", "kept"} <= set(back.columns) and "text" not in back.columns
    raw = sorted(r.raw.decode() for r in back.select("raw").collect())
    assert raw == sorted(t or "" for _, t in cases.TEXTS)
    assert bpe.encode(cases.empty(spark), MULTILINGUAL).count() == 0


def test_unknown_ids_decode_to_nothing(spark):
    frame = spark.createDataFrame([(1, [-1, 10**6, None]), (2, None)], "doc_id long, ids array<int>")
    assert [bytes(r.raw) for r in bpe.decode(frame, ENGLISH).collect()] == [b"", b""]


def test_lookups_equal_whole_texts_and_long_words_are_forgotten():
    own = bpe.Codec(bpe.codec(ENGLISH).tokenizer, ENGLISH.pattern, cache=3)
    long_word = "x" * 500
    texts = ["", " ", "a", "a b  c", f"one {long_word} two", "don't stop\n now\t\there", "漢字 é 🙂", "end "]
    expected = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        found = [np.frombuffer(raw, "<u4").tolist() for raw in own.encode_all(texts)]
        assert found == expected
        assert len(own.words) <= 3 and long_word not in own.words
    assert own.encode_all([]) == []


class Counting:
    """A tokenizer that remembers how many texts it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts, add_special_tokens):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)


@pytest.mark.parametrize("vocabulary", [MULTILINGUAL, ENGLISH])
def test_unknown_words_go_to_the_library_many_at_once(vocabulary):
    rng = random.Random(7)
    letters = "aAeé'sß漢\U0001f600.,!\n\t019_-\u2003"
    texts = [" ".join("x" + "".join(rng.choices(letters, k=rng.randrange(9))) + "y" for _ in range(700)) for _ in range(6)]
    counting = Counting(bpe.codec(vocabulary).tokenizer)
    own = bpe.Codec(counting, vocabulary.pattern)
    got = [np.frombuffer(raw, "<u4").tolist() for raw in own.encode_all(texts)]
    assert got == [e.ids for e in counting.encode_batch(texts, add_special_tokens=False)]
    assert 3000 < len(own.words) and counting.texts < 50


def test_words_are_encoded_one_by_one_where_tokens_end_elsewhere():
    tokenizer = Tokenizer.from_file(ENGLISH.path)
    tokenizer.encode_special_tokens = True
    tokenizer.add_tokens(["one two"])
    own = bpe.Codec(tokenizer, ENGLISH.pattern)
    words = ["zero", "one", "two", "three"]
    expected = [tokenizer.encode(f" {word}", add_special_tokens=False).ids for word in words]
    for _ in range(2):
        got = own.encode_all([f"a {word}" for word in words])
        assert [np.frombuffer(raw, "<u4").tolist()[1:] for raw in got] == expected


def test_a_step_gives_memory_back(monkeypatch):
    pool, calls = pa.default_memory_pool(), []

    class Pool:
        def release_unused(self):
            calls.append(1)
            pool.release_unused()

    monkeypatch.setattr(bpe.pa, "default_memory_pool", Pool)
    rows = 2 * bpe.SLICE + 1
    columns = [pa.array(range(rows)), pa.array([f"one word{k} more" for k in range(rows)])]
    batch = pa.RecordBatch.from_arrays(columns, names=["__row", "value"])
    out = list(bpe._encoding(ENGLISH, False)(iter([batch])))
    assert sum(part.num_rows for part in out) == rows and len(calls) == 3
