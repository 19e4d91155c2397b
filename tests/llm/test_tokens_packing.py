from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from keyfold.llm import packing, tokens
from tests.llm.tables import SCHEMA, messy, messy_rows

WHOLE = Tokenizer.from_file(tokens.vocabulary_path())
WHOLE.encode_special_tokens = True


def whole_ids(text: str) -> list[int]:
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aAbéÉ' ,.!stdm\n\t-<|>« ½0İKßχ́\x1c 漢", max_size=30), max_size=4))
def test_word_ids_are_those_of_the_whole_text(texts):
    tokenizer = tokens.word_tokenizer(tokens.vocabulary_path())
    assert [x.tolist() for x in tokenizer.encode([t.encode() for t in texts])] == [whole_ids(t) for t in texts]
    assert tokenizer.counts([t.encode() for t in texts]).tolist() == [len(whole_ids(t)) for t in texts]


LIBRARY = Tokenizer.from_file(tokens.vocabulary_path())
LITERALS = ["<|startoftext|>", "<|endoftext|>", "<|EndOfText|>", "<|endof", "text|>", "e", "́", " ", "\n", "A's", "<|", "|>", ".", "<<"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(LITERALS), max_size=8).map("".join), max_size=4))
def test_literals_of_added_tokens_are_these_tokens(texts):
    wanted = [LIBRARY.encode(t, add_special_tokens=False).ids for t in [*texts, "a<|endoftext|>b"]]
    tokenizer = tokens.word_tokenizer(tokens.vocabulary_path())
    encoded = [t.encode() for t in [*texts, "a<|endoftext|>b"]]
    assert wanted[-1][1] == 49407 and [x.tolist() for x in tokenizer.encode(encoded)] == wanted
    assert tokenizer.counts(encoded).tolist() == [len(x) for x in wanted]


def test_new_words_are_encoded_many_at_once(monkeypatch):
    class Counting:
        def __init__(self, inner):
            self.inner, self.handed = inner, 0

        def encode(self, *args, **named):
            self.handed += 1
            return self.inner.encode(*args, **named)

        def encode_batch_fast(self, texts, **named):
            self.handed += len(texts)
            return self.inner.encode_batch_fast(texts, **named)

    plain = " ".join(f"word{i}x é{i}" for i in range(2000))
    # the sign itself, signs in a row and inside words, and words without ids
    odd = "a\x01b \x01 \x01\x01 x \x02 \x00 a\x00b \u0301x <|endoftext|>"
    for group in (tokens.GROUP, 1, 3):
        monkeypatch.setattr(tokens, "GROUP", group)
        tokenizer = tokens.WordTokenizer(tokens.vocabulary_path())
        tokenizer.tokenizer = counting = Counting(tokenizer.tokenizer)
        for text in (plain, odd, ""):
            assert [x.tolist() for x in tokenizer.encode([text.encode()])] == [LIBRARY.encode(text, add_special_tokens=False).ids]
            assert text != plain or group == 1 or counting.handed <= 4000 // group + 1


def test_long_texts_and_a_full_cache(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 50)
    monkeypatch.setattr(tokens, "PART_BYTES", 64)
    tokenizer = tokens.WordTokenizer(tokens.vocabulary_path())
    text = " ".join(f"word{i % 97}, " for i in range(500)) + "x" * 300 + " end"
    for _ in range(2):
        assert next(tokenizer.encode([text.encode()])).tolist() == whole_ids(text)
    monkeypatch.setattr(tokens, "KEPT_IDS", 100)
    assert next(tokenizer.encode([text.encode()])).tolist() == whole_ids(text)
    assert len(tokenizer.slots) < 200
    parts = tokens.split_parts(text.encode(), 64)
    assert b"".join(parts) == text.encode() and len(parts) > 20


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 5000])
def test_pieces_are_binary_digits(n):
    lengths = packing.piece_lengths(n)
    assert sum(lengths) == n and all(x & (x - 1) == 0 and x <= 2048 for x in lengths)
    assert lengths == sorted(lengths, reverse=True) and max(lengths) * 2 > min(n, 2048)


def test_every_id_lies_in_one_piece(spark):
    rows = messy_rows()
    out = packing.packed(messy(spark)).collect()
    found = {}
    for r in out:
        found.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    expected = {}
    for doc_id, text, *_ in rows:
        ids = np.array([*whole_ids(text or ""), 1], "<u4")
        expected.setdefault((doc_id, len(ids)), []).append(ids)
    assert found.keys() == expected.keys()
    for key, pieces in found.items():
        wanted = sorted(
            (s, n, zlib.crc32(ids[s : s + n]))
            for ids in expected[key]
            for s, n in zip(np.cumsum([0, *packing.piece_lengths(len(ids))]).tolist(), packing.piece_lengths(len(ids)))
        )
        assert sorted((p.start, p.length, p.ids_crc32) for p in pieces) == wanted
    assert len({r.sequence_id for r in out}) == len(out) and all(r.offset == 0 for r in out)
    assert all(r.length == 1 << r.bucket for r in out)
    batches = {}
    for r in out:
        batches.setdefault(r.batch, set()).add(r.length)
    assert all(len(x) == 1 for x in batches.values())


def test_empty_table(spark):
    assert packing.packed(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        packing.packed(spark.createDataFrame([], SCHEMA), longest=100)
