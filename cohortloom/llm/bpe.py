"""Byte-level BPE over Arrow batches with the ``tokenizers`` library, and back.

The vocabulary is broadcast by path only: each Python worker opens the file once and keeps the tokenizer. A text is cut
where the split pattern always cuts (before a space that a word follows), so equal words are encoded once per worker: Arrow
finds the distinct words of some texts, two bounded dictionaries hold the ids of frequent words (Arrow and numpy arrays, no
Python object a word) and pieces, the library encodes what they lack. For the same reason unknown words go to the library many in one text, and the ids are dealt back by
the bytes of their tokens; where these do not end with every word, words are encoded one by one. Nothing is shuffled; a task
holds one Arrow batch.

Byte-to-character mapping: byte-level tokens may begin or end inside a character. Offsets are therefore made from the
tokens' byte lengths and the positions of the text's leading bytes: a token's span covers each character of which it holds
a byte. Decoding maps ids to byte strings through the reversed byte table and joins these before any character is read.

Defined cases: a null text is an empty one and gives no ids; other columns are passed through untouched; repeated rows
give equal results; an empty table gives an empty table; ids unknown to the vocabulary, and null ids, decode to nothing.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import os
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.frames import mapped

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

from tokenizers import Regex, Tokenizer, models, pre_tokenizers  # noqa: E402

#: Words, and pieces of words, that a worker remembers; about 40 bytes a word, and 200 a piece.
CACHE = 150_000
#: Longer words, in characters, are not remembered, so that the dictionaries' bytes are bounded too.
LONGEST = 100
#: Texts that are encoded together.
SLICE = 1024
#: Unknown words that the library gets as one text.
JOINED = 1024


@dataclass(frozen=True)
class Vocabulary:
    """``path``: a rank file (``*.tiktoken``) or a tokenizer file (``*.json``). ``pattern``: how texts are split.

    ``cache``: words, and pieces of words, that a worker remembers; it costs memory and saves time, never a result.
    ``added``: whether the added tokens of a tokenizer file stand for themselves where a text spells them, as the library
    has it unless told otherwise; else their strings are ordinary text. Rank files have none.
    """

    path: str
    pattern: str
    cache: int = CACHE
    added: bool = False


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in prints else next(rest)) for b in range(0x100)]


def from_ranks(path: str, pattern: str) -> Tokenizer:
    """A tokenizer that merges as the rank file says: any two neighbours whose joined bytes are a token, lowest rank first.

    So every way to cut a token into two tokens becomes a merge at the token's rank.
    """
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    letters = byte_characters()
    spelled = {token: "".join(letters[b] for b in token) for token in ranks}
    merges = [
        (spelled[token[:k]], spelled[token[k:]])
        for token in sorted(ranks, key=ranks.__getitem__)
        for k in range(1, len(token))
        if token[:k] in ranks and token[k:] in ranks
    ]
    model = models.BPE({spelled[token]: rank for token, rank in ranks.items()}, merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(False, use_regex=False)]
    )
    return tokenizer


def from_file(path: str) -> Tokenizer:
    """The file's tokenizer, to which the strings of special tokens are ordinary text."""
    tokenizer = Tokenizer.from_file(path)
    if json.loads(tokenizer.pre_tokenizer.__getstate__())["type"] != "ByteLevel":
        raise ValueError(f"{path} is not a byte-level vocabulary")
    tokenizer.encode_special_tokens = True
    return tokenizer


@dataclass
class Codec:
    """One worker's tokenizer, its dictionaries and its byte table."""

    tokenizer: Tokenizer
    pattern: str
    cache: int = CACHE
    #: The library as it comes, for texts that spell one of its added tokens; None if these are ordinary text.
    whole: Tokenizer | None = None
    #: Known words, the ids of all of them one after the other, and each one's number of ids.
    words: pa.Array = field(default_factory=lambda: pa.array([], pa.string()))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, "<u4"))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, "int64"))
    pieces: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.split = regex.compile(self.pattern).findall
        byte = {letter: b for b, letter in enumerate(byte_characters())}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(byte[letter] for letter in token)
        added = self.whole.get_added_tokens_decoder() if self.whole else {}
        self.bytes_of += [b""] * (max(added, default=-1) + 1 - len(self.bytes_of))
        for i, token in added.items():
            self.bytes_of[i] = token.content.encode()
        self.lengths = np.array([len(b) for b in self.bytes_of], "int64")
        self.added = [token.content for token in added.values()]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. One that spells an added token goes to the library whole."""
        special = [k for k, text in enumerate(texts) if any(token in text for token in self.added)]
        if not special:
            return self._encode_plain(texts)
        chosen = set(special)
        out = self._encode_plain(["" if k in chosen else text for k, text in enumerate(texts)])
        for k in special:
            ids = self.whole.encode(texts[k], add_special_tokens=False).ids
            out[k] = np.array(ids, "<u4").tobytes()
        return out

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """Distinct words are found by Arrow, those that the dictionary lacks are encoded at once, and texts are looked up."""
        odd = [_ODD_SPACES(text) is not None for text in texts]
        cut = pc.split_pattern(pa.array(["" if o else t for o, t in zip(odd, texts, strict=True)], pa.string()), pattern=" ")
        starts, words = cut.offsets.to_numpy(), cut.flatten()
        heads = words.take(pa.array(starts[:-1])).to_pylist()  # what stands before a text's first space
        heads = [self.split(text if o else head) for o, text, head in zip(odd, texts, heads, strict=True)]
        after = np.ones(len(words), bool)
        after[starts[:-1]] = False
        coded = words.filter(pa.array(after)).dictionary_encode()
        learned = self._learn(heads)
        known = self.pieces.__getitem__
        ids, edges = _looked_up(*self._ids_of(coded.dictionary), coded.indices.to_numpy())
        edges = edges[starts - np.arange(len(starts))]  # each text has one head among its words
        encoded = [
            b"".join(map(known, head)) + ids[a:b].tobytes()
            for head, a, b in zip(heads, edges[:-1].tolist(), edges[1:].tolist(), strict=True)
        ]
        _shrink(self.pieces, learned, self.cache)
        return encoded

    def _learn(self, lists: list[list[str]]) -> list[str]:
        """Have the library encode the pieces that are not known yet, and return these."""
        fresh = list({piece for pieces in lists for piece in pieces}.difference(self.pieces))
        self.pieces.update(zip(fresh, self._encoded(fresh), strict=True))
        return fresh

    def _ids_of(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Some ids, and where in them the ids of each word, with a space before it, begin and how many they are."""
        at = pc.index_in(distinct, value_set=self.words)
        unknown = pc.is_null(at)
        fresh = distinct.filter(unknown)
        ids, counts = self._encoded_words(fresh)
        every = np.concatenate([self.counts, counts])
        begins = np.cumsum(every) - every
        pool = np.concatenate([self.ids, ids])
        at = at.fill_null(0).to_numpy().astype("int64")
        at[unknown.to_numpy(zero_copy_only=False)] = np.arange(len(self.words), len(every))
        self._remember(fresh, ids, counts)
        return pool, begins[at], every[at]

    def _remember(self, fresh: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        """Keep words while there is room, but very long ones: what comes first is frequent."""
        room = self.cache - len(self.words)
        if room <= 0 or not len(fresh):
            return
        short = pc.less_equal(pc.utf8_length(fresh), LONGEST).to_numpy(zero_copy_only=False)
        short &= np.cumsum(short) <= room
        self.words = pa.concat_arrays([self.words, fresh.filter(pa.array(short))])
        self.ids = np.concatenate([self.ids, ids[np.repeat(short, counts)]])
        self.counts = np.concatenate([self.counts, counts[short]])

    def _encoded_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, each with a space before it, one after the other, and how many each has.

        The pattern cuts before each word's space, so a word with it is encoded alone as within any text.
        """
        if not len(words):
            return np.zeros(0, "<u4"), np.zeros(0, "int64")
        groups = pa.ListArray.from_arrays(pa.array([*range(0, len(words), JOINED), len(words)], pa.int32()), words)
        texts = [f" {text}" for text in pc.binary_join(groups, " ").to_pylist()]
        sizes = pc.binary_length(words).to_numpy().astype("int64") + 1
        found, counts = [], []
        for k, encoding in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(encoding.ids, "<u4")
            ends = np.cumsum(self.lengths[np.minimum(ids, len(self.lengths) - 1)])
            edges = np.cumsum(sizes[k * JOINED : (k + 1) * JOINED])
            last = np.searchsorted(ends, edges)  # the token that ends with the word
            if len(ids) and last[-1] == len(ids) - 1 and np.array_equal(ends[last], edges):
                counts.append(np.diff(last, prepend=-1))
            else:
                alone = self._encoded([f" {word}" for word in words.slice(k * JOINED, JOINED).to_pylist()])
                ids = np.frombuffer(b"".join(alone), "<u4")
                counts.append(np.array([len(raw) // 4 for raw in alone], "int64"))
            found.append(ids)
        return np.concatenate(found), np.concatenate(counts)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        encodings = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in (encoding.ids for encoding in encodings)]

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids[(ids >= 0) & (ids < len(self.bytes_of))]
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last of each token."""
        raw = np.frombuffer(text.encode(), "uint8")
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        return character[starts].astype("int32"), (character[ends - 1] + 1).astype("int32")


def _looked_up(
    pool: np.ndarray, begins: np.ndarray, sizes: np.ndarray, at: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words ``at[0], at[1], ...`` in one array, and where each of these begins and ends in it."""
    counts = sizes[at]
    edges = np.concatenate([[0], np.cumsum(counts)])
    return pool[np.repeat(begins[at] - edges[:-1], counts) + np.arange(edges[-1])], edges


def _shrink(known: dict[str, bytes], fresh: list[str], most: int) -> None:
    """Forget very long words, and what came last if there is too much; what came first is frequent."""
    full = len(known) > most
    for key in fresh:
        if full or len(key) > LONGEST:
            del known[key]


#: A space that no word follows; such texts are split by the pattern alone.
_ODD_SPACES = re.compile(r" (?:\s|\Z)").search


@functools.lru_cache(maxsize=4)
def codec(vocabulary: Vocabulary) -> Codec:
    """The worker's codec; workers are reused, so it outlives a task."""
    ranks = vocabulary.path.endswith(".tiktoken")
    tokenizer = from_ranks(vocabulary.path, vocabulary.pattern) if ranks else from_file(vocabulary.path)
    whole = Tokenizer.from_file(vocabulary.path) if vocabulary.added and not ranks else None
    return Codec(tokenizer, vocabulary.pattern, vocabulary.cache, whole)


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
_LISTS = T.ArrayType(T.IntegerType(), False)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", offsets: bool = False) -> DataFrame:
    """All columns but ``text``, which gives way to ``ids`` and, if asked for, ``starts`` and ``ends`` in characters.

    A column of one of these names is replaced.
    """
    made = {name: _LISTS for name in (["ids", "starts", "ends"] if offsets else ["ids"])}
    return _mapped(docs, text, _encoding(vocabulary, offsets), made)


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Beside all given columns, ``raw``: the bytes that ``ids`` stand for."""
    return _mapped(encoded, "ids", _decoding(vocabulary), {"ids": encoded.schema["ids"].dataType, "raw": T.BinaryType()})


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """Encode, decode and digest: the other columns, ``n_tokens`` and digests of the ids and of the decoded bytes.

    The ids are hashed as little-endian unsigned 32-bit integers. The steps are those of ``encode`` and ``decode``, batch
    by batch in one Python worker instead of a worker for each.
    """
    encoding, decoding = _encoding(vocabulary, False), _decoding(vocabulary)
    made = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    return _mapped(docs, text, lambda batches: _digested(decoding(encoding(batches))), made)


def _mapped(frame: DataFrame, value: str, step: Step, made: dict[str, T.DataType]) -> DataFrame:
    """Apply a step from ``(__row, value)`` to ``(__row, *made)``; ``__row`` holds all columns that stay as they are."""
    return mapped(frame, {"value": value}, ["value"], step, made, used_up=(value,))


def _encoding(vocabulary: Vocabulary, offsets: bool) -> Step:
    names = ["__row", "ids", "starts", "ends"] if offsets else ["__row", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for part in _slices(batches):
            texts = [x or "" for x in part.column("value").to_pylist()]
            found = [np.frombuffer(b, "<u4").astype("int32") for b in own.encode_all(texts)]
            columns = [_lists(found)]
            if offsets:
                spans = [own.offsets(t, ids) for t, ids in zip(texts, found, strict=True)]
                columns += [_lists([s for s, _ in spans]), _lists([e for _, e in spans])]
            yield pa.RecordBatch.from_arrays([part.column("__row"), *columns], names=names)

    return run


def _decoding(vocabulary: Vocabulary) -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for part in _slices(batches):
            ids = part.column(1)
            raw = pa.array([own.decode(_numbers(x)) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("__row"), ids, raw], names=["__row", "ids", "raw"])

    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [_numbers(x).astype("<u4") for x in batch.column("ids")]
        columns = [
            pa.array([len(x) for x in ids], pa.int64()),
            pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
            pa.array([hashlib.sha256(x.as_py()).hexdigest() for x in batch.column("raw")], pa.string()),
        ]
        names = ["__row", "n_tokens", "ids_sha256", "decoded_sha256"]
        yield pa.RecordBatch.from_arrays([batch.column("__row"), *columns], names=names)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE):
            yield batch.slice(begin, SLICE)
            # Else Arrow keeps what the words took, about 60 MB, for as long as the worker lives.
            pa.default_memory_pool().release_unused()


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype="int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, "int32")))


def _numbers(row: pa.Scalar) -> np.ndarray:
    if not row.is_valid:
        return np.zeros(0, "int64")
    return np.array(row.values.drop_null(), "int64")
