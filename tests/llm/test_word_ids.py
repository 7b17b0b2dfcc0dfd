"""Ids put together from words equal the libraries' on whole texts."""

import random

import public_tokenizers
import pytest

from canopy.llm import word_ids
from canopy.llm.token_count import load_json, sentence_pieces
from canopy.llm.word_ids import WordIds, json_ids, piece_ids

PARTS = [
    *("a", "'s", "'", " ", "  ", "\n", "\t", "\x01", "\x1c", "\x1d", "▁", "é", "́", "<|endoftext|>"),
    *("<|startoftext|>", "日本", "1", "23", "!?", "İ", " ", " ", "\u0085", "don't", "The", "ſ", "Σ"),
    *("\x00", "�", "😀", "<0x41>", "​", "﻿"),
]


def texts(n=3000):
    draw = random.Random(5)
    weights = [4 if p in ("a", " ") else 1 for p in PARTS]
    return ["".join(draw.choices(PARTS, weights, k=draw.randint(0, 25))) for _ in range(n)]


def library(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        return lambda t: sentence_pieces(path).encode(t, num_threads=1)
    return lambda t: [e.ids for e in load_json(path).encode_batch(t, add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
@pytest.mark.parametrize("stretch", [1 << 18, 5])
def test_equal_to_library(name, stretch):
    path = public_tokenizers.path(name)
    words = piece_ids(path) if name.endswith(".model") else json_ids(path)
    assert words.cut is not None
    small = WordIds(words.encode, words.cut, words.place, between=words.between, lead=words.lead, tails=words.tails, fold=words.fold, kept=50, longest=8, stretch=stretch)
    given = texts()
    found = [ids.tolist() for k in range(0, len(given), 64) for ids in small(given[k : k + 64])]
    assert found == [list(i) for i in library(name)(given)]


def test_without_a_known_shape_texts_are_encoded_whole():
    plain = WordIds(lambda texts: [[len(t)] for t in texts])
    assert [i.tolist() for i in plain(["a b", "", "xyz"])] == [[3], [0], [3]]
    assert plain([]) == []


def test_words_kept_after_forgetting_are_placed_at_once(monkeypatch):
    texts = [" ".join(f"w{i % 40} x{i * k} {'long' * 30}{i}" for i in range(200)) for k in range(1, 6)]
    words = json_ids.__wrapped__(public_tokenizers.path("byte_bpe_50k.json"), kept=300)
    want = [load_json(public_tokenizers.path("byte_bpe_50k.json")).encode(t, add_special_tokens=False).ids for t in texts]
    assert [words([t])[0].tolist() for t in texts] == want
    monkeypatch.setattr(word_ids.Places, "__missing__", None)  # a word kept is not asked for again
    words._forget()
    assert len(words.words) == words.places.n == 150 and [words.places[w] for w in words.words] == list(range(150))
    monkeypatch.undo()
    assert [words([t])[0].tolist() for t in texts] == want


def test_a_leading_space_needs_no_pattern(monkeypatch):
    rng, marks = random.Random(6), [" ", " ", "a", "b.", "\n", "\u3000", "\x1c", "é"]
    texts = [first + "".join(rng.choice(marks) for _ in range(rng.randint(0, 7))) for first in (" ", "x", "\n") for _ in range(400)]
    for text in texts:
        plain = [w[k > 0 :] for k, w in enumerate(word_ids.BEFORE_SPACE.split(text))]
        assert word_ids.cut_before_space(text) == [" " + plain[0], *plain[1:]], text
    monkeypatch.setattr(word_ids, "BEFORE_SPACE", None)
    assert word_ids.cut_before_space(" some plain words") == ["  some", "plain", "words"]
