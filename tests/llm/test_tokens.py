import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tilewright.llm import token_ids
from tilewright.llm.queries import tokenizer_path


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=40))
def test_codec_round_trip(values):
    control, data = token_ids.encode(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert token_ids.decode(control, data, len(values)).tolist() == values


@pytest.fixture(scope="module")
def whole():
    return token_ids.word_tokenizer(tokenizer_path(), "<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcABC .,!?'\n\t\r\x0b\x1c\x85éÉßİΣς́ñ日<|>_19s"), st.characters(codec="utf-8")), max_size=40))
def test_words_give_the_ids_of_the_whole_text(whole, text):
    assert np.frombuffer(whole.encode(text.encode()), "<u4").tolist() == whole.tokenizer.encode(text, add_special_tokens=False).ids


def test_special_tokens_and_eviction(whole, monkeypatch):
    monkeypatch.setattr(token_ids, "CACHE_WORDS", 5)
    for text in ("<|endoftext|> <|ENDOFTEXT|> x<|startoftext|>y", " ".join(f"word{i} word," for i in range(40))):
        assert np.frombuffer(whole.encode(text.encode()), "<u4").tolist() == whole.tokenizer.encode(text, add_special_tokens=False).ids


def test_files(make, corpus, odd, whole, monkeypatch):
    monkeypatch.setattr(token_ids, "BLOCK_TOKENS", 500)
    rows = corpus + [(i + 100_001 if i is not None else i, t) for i, t in odd]
    found = token_ids.token_ids(make(rows), tokenizer_path()).collect()
    expected, at = [], 0
    coded = [(i, [*whole.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
    for i, ids in sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0)):
        expected.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert token_ids.token_ids(make([]), tokenizer_path()).collect() == []
