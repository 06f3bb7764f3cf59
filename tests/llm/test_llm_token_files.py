"""Token files: sequences, masks, views and documents."""

from __future__ import annotations

import zlib

import llm_cases as cases
import numpy as np
import public_tokenizers
import pyarrow as pa

from cohortloom.llm import bpe, catalogue, token_files
from cohortloom.llm.catalogue import ENGLISH
from tokenizers import Tokenizer


def expected(rows: list[tuple]) -> list[tuple]:
    own, at, out = Tokenizer.from_file(ENGLISH.path), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*own.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_documents_come_back(spark):
    rows = [(i, t) for i, t in cases.TEXTS if i is not None]
    docs = cases.with_clashes(spark).where("doc_id IS NOT NULL")
    for layout in (token_files.Layout(), token_files.Layout(length=16, rows=3)):
        got = token_files.read_documents(token_files.write_token_files(docs, ENGLISH, layout)).collect()
        assert sorted(map(tuple, got)) == expected(rows)


def test_null_ids_come_first(spark):
    got = token_files.read_documents(token_files.write_token_files(cases.docs(spark), ENGLISH)).collect()
    first = sorted(got, key=lambda r: r.start)[:2]
    assert [r.doc_id for r in first] == [None, None] and len(got) == len(cases.TEXTS)


def test_sequences_are_views_with_masks(spark):
    layout = token_files.Layout(length=32, rows=4)
    manifest = token_files.write_token_files(cases.docs(spark).coalesce(1), ENGLISH, layout).collect()
    for row in manifest:
        file = token_files.TokenFile(row.tokens)
        sequences = -(-row.n_ids // layout.length)
        before = pa.total_allocated_bytes()
        ids = [file[k][0] for k in reversed(range(sequences))][::-1]
        assert pa.total_allocated_bytes() - before < 1 << 16  # the ids stay in the mapped file
        assert all(len(view) == layout.length and not view.flags.owndata for view in ids)
        mask = np.concatenate([file[k][1] for k in range(sequences)])
        assert mask.sum() == row.n_ids and mask[: row.n_ids].all()
        assert np.array_equal(np.concatenate(ids)[: row.n_ids], file.span(0, row.n_ids))


def test_empty(spark):
    assert token_files.read_documents(token_files.write_token_files(cases.empty(spark), ENGLISH)).count() == 0


def test_added_tokens_as_the_library_has_them(spark):
    """Texts that spell an added token, against a tokenizer fresh from the file; told otherwise, it is ordinary text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    spelled = ["a<|endoftext|> b", "<|endoftext|>", " <|endoftext|><|endoftext|>\n", "<|endoftext|", "none", "", " x <|endoftext|>  y"]
    library = Tokenizer.from_file(path)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    for added, tokenizer in ((True, library), (False, plain)):
        own = bpe.codec(bpe.Vocabulary(path, public_tokenizers.PATTERN, added=added))
        want = [tokenizer.encode(text, add_special_tokens=False).ids for text in spelled]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode_all(spelled)] == want
        assert [own.decode(np.array(ids, "int64")).decode() for ids in want] == spelled
    assert catalogue.ENGLISH.added
