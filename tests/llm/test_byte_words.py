"""Ids put together from words looked up as bytes equal the library's on whole texts."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from canopy.llm import byte_words
from canopy.llm.byte_words import ByteWords
from canopy.llm.token_count import load_json

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    *("a", "'s", "'", " ", "  ", "\n", "\t", "\x01", "\x1c", "▁", "é", "É", "×", "÷", "́", "<|endoftext|>", ".", ",", "?!", ";:"),
    *("日本", "1", "23", "!?", "İ", " ", " ", "　", "\u0085", "don't", "The", "ſ", "ß", "\x00", "�", "😀", "​", "﻿"),
    *("straße", "abcdefghijklmno", "abcdefghijklmnop", "ⅷ", "²", "ª", "ÿ", "ǆ", "ʼ"),
]


def texts(n, seed=5):
    draw = random.Random(seed)
    weights = [5 if p in ("a", " ", "\n", ".") else 1 for p in PARTS]
    return ["".join(draw.choices(PARTS, weights, k=draw.randint(0, 25))) for _ in range(n)]


def want(given):
    return [[*e.ids, 7] for e in load_json(PATH).encode_batch([t or "" for t in given], add_special_tokens=False)]


def found(words, column):
    ids, sizes = words(column)
    return [i.tolist() for i in np.split(ids, np.cumsum(sizes)[:-1])] if len(sizes) else []


@pytest.mark.parametrize("kept, at_once, window", [(1 << 20, 1 << 17, 1 << 22), (60, 30, 7), (60, 1, 64)])
def test_equal_to_library(kept, at_once, window, monkeypatch):
    monkeypatch.setattr(byte_words, "WINDOW", window)
    given = texts(3000 if window > 100 else 400)
    given[3] = given[4] = None
    words = ByteWords(PATH, 7, kept=kept, words_at_once=at_once)
    assert words.by_bytes
    expected = want(given)
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(given, kind)
        for k in range(0, len(given), 64):
            assert found(words, column.slice(k, 64)) == expected[k : k + 64]


def test_empty_columns_and_texts():
    words = ByteWords(PATH, 7)
    assert found(words, pa.array([], pa.string())) == []
    assert found(words, pa.array(["", None, ""], pa.string())) == [[7], [7], [7]]
    assert found(words, pa.array(["", "a b", None], pa.string())) == want(["", "a b", None])


def test_words_met_before_are_not_encoded_again(monkeypatch):
    words = ByteWords(PATH, 7)
    given = ["Some plain words, and a word of more than fifteen characters: unquestionably.\nSome words."] * 5
    expected = want(given)
    assert found(words, pa.array(given)) == expected
    monkeypatch.setattr(ByteWords, "_encoded", None)
    assert found(words, pa.array(given)) == expected


def test_a_tokenizer_of_another_shape_encodes_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    words = ByteWords(path, 1)
    assert not words.by_bytes
    given = ["Some plain words, and more.", None, ""]
    assert found(words, pa.array(given)) == [[*load_json(path).encode(t or "", add_special_tokens=False).ids, 1] for t in given]
