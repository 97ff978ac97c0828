"""Operator 1: exact round trips, damage, and the index against whole-text encoding."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from palimpsest.llm.context_coder import BLOCK_IDS, decode_block, encode_block
from palimpsest.llm import token_output
from palimpsest.llm.token_output import Encoder, by_bytes, decode_documents, encode_documents, encoder, pack_record, query, token_index, tokenizer_path, unpack_record

PARTS = ["a", "B", "\u00e9", "\u00df", "x", "1", "\u00b2", "'", "'s", "'ll", " ", "  ", "\n", "\r", "\t", "\u00a0", "\u0301", "\u4e2d", "!", "_", "\0", "\x1f", "\U0001f600", "\u01c5", "<|endoftext|>", "\u2019", "\u2028", "\x85", "Hello", "Word.", "W\u00f6rt,", ".", ",", "...", "\u01c5.", "\u0451.", "3."]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 299), min_size=1, max_size=900))
def test_any_ids_come_back(ids):
    data = encode_block(np.array(ids), 300)
    got, used = decode_block(memoryview(data), 300)
    assert got.tolist() == ids and used == len(data)


def test_a_full_block_of_a_skewed_source_is_smaller_than_its_entropy_of_order_0():
    r = np.random.default_rng(1)
    ids = np.tile(r.integers(0, 50_000, 500), BLOCK_IDS // 500)
    data = encode_block(ids, 50_000)
    assert len(data) < len(ids) * np.log2(500) / 8 / 2
    assert (decode_block(memoryview(data), 50_000)[0] == ids).all()


def test_damage_is_noticed():
    record = bytearray(pack_record([4, None], [np.arange(50), np.array([2])], 100))
    ids = unpack_record(bytes(record))
    assert ids[0] == [4, None] and [x.tolist() for x in ids[1]] == [list(range(50)), [2]]
    for at in range(len(record)):
        for flip in (0x01, 0x55, 0x80):
            broken = bytearray(record)
            broken[at] ^= flip
            with pytest.raises(ValueError):
                unpack_record(bytes(broken))
    for other in (record[:10], record[:40], record[:-1], record + b"\0"):
        with pytest.raises(ValueError):
            unpack_record(bytes(other))


def test_pieces_encode_like_whole_texts():
    r, e = random.Random(3), encoder(tokenizer_path())
    for _ in range(300):
        some = r.sample(PARTS, r.choice([4, 9, len(PARTS)]))
        texts = ["".join(r.choice(some) for _ in range(r.randint(0, 25))) for _ in range(20)]
        for text, got in zip(texts, e(pa.array(texts))):
            assert got.tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_other_tokenizers_encode_whole_texts():
    e = Encoder(tokenizer_path("word_bpe_49k.json"))
    texts = ["It's one. Two,  three\n\nfour", "", "A b c!", None]
    assert not e.cuts
    assert [x.tolist() for x in e(pa.array(texts))] == [e.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_a_full_memory_changes_no_id(monkeypatch):
    monkeypatch.setattr(token_output, "MEMO_PIECES", 40)
    e, r = Encoder(tokenizer_path()), random.Random(4)
    words = ["".join(r.choices("abcdeé", k=r.randint(1, 6))) + r.choice(["", ".", ",", "'s"]) for _ in range(120)]
    for _ in range(30):
        texts = [" ".join(r.choices(words, k=12)) for _ in range(6)]
        for text, got in zip(texts, e(pa.array(texts))):
            assert got.tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_slices_by_bytes():
    column = pa.array(["aaaa", None, "b", "c" * 9, "", "dd"])
    assert list(by_bytes(column, 5)) == [(0, 3), (3, 1), (4, 2)] and list(by_bytes(column.slice(0, 0), 5)) == []


def expected_index(rows):
    from tokenizers import Tokenizer

    t, start, out = Tokenizer.from_file(tokenizer_path()), 0, []
    for r in rows:
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_equals_whole_text_encoding(spark, sf_dir, documents):
    got = query(spark, sf_dir).orderBy("start").collect()
    assert [tuple(r)[:4] for r in got] == expected_index(sorted(documents, key=lambda r: r.doc_id))


def test_odd_rows(spark, odd_docs, no_docs):
    records = encode_documents(odd_docs)
    got = token_index(records).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7]
    assert [r.n_tokens for r in got if r.doc_id in (2, 3)] == [1, 1]
    assert got[7].ids_crc32 == got[8].ids_crc32 and got[-1].start == sum(r.n_tokens for r in got[:-1])
    ids = {r.doc_id: r.ids for r in decode_documents(records).collect()}
    text = next(r.text for r in odd_docs.collect() if r.doc_id == 7)
    assert encoder(tokenizer_path()).tokenizer.decode(ids[7][:-1]) == text
    assert token_index(encode_documents(no_docs)).count() == 0
