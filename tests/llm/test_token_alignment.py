"""Alignment of two tokenizers against a plain version that walks bytes and counts pairs."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from canopy.llm import token_alignment as T
from canopy.llm.queries import JSON_50K, PIECES_32K
from canopy.llm.token_alignment import Merge, align, byte_level_tokens, diagonal, distinct_places, piece_tokens, same_bytes, spans
from canopy.llm.token_count import load_json, sentence_pieces
from canopy.llm.word_ids import json_ids

A, B = public_tokenizers.path(JSON_50K), public_tokenizers.path(PIECES_32K)


def plain(texts):
    """By document: ids, ends, links and groups, byte by byte."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    found = []
    for text in texts:
        ids_a = tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = sentence_pieces(B).encode(text or "")
        bytes_a, bytes_b = [byte_level_tokens(A)[i] for i in ids_a], [piece_tokens(B)[i] for i in ids_b]
        data = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            found.append(None)
            continue
        owner_a = [k for k, t in enumerate(bytes_a) for _ in t]
        owner_b = [k for k, t in enumerate(bytes_b) for _ in t]
        links = sorted(set(zip(owner_a, owner_b, strict=True)))
        groups, now = [], ([], [])
        for at in range(len(data)):
            last_a = at + 1 == len(data) or owner_a[at + 1] != owner_a[at]
            last_b = at + 1 == len(data) or owner_b[at + 1] != owner_b[at]
            if last_a:
                now[0].append(ids_a[owner_a[at]])
            if last_b:
                now[1].append(ids_b[owner_b[at]])
            if last_a and last_b:
                groups.append(now)
                now = ([], [])
        found.append((ids_a, ids_b, [(ids_a[i], ids_b[j]) for i, j in links], groups))
    counts = Counter(p for f in found if f for p in f[2])
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in f[3])
        best = sum(counts[p] == top[p[1]] for p in f[2])
        rows.append((len(f[0]), len(f[1]), len(f[3]), len(f[2]), best, sum(counts[p] for p in f[2]), hashlib.sha256(text.encode()).hexdigest()))
    return rows


def test_diagonals():
    draw = random.Random(1)
    for _ in range(200):
        a = sorted(draw.sample(range(40), draw.randint(1, 20)))
        b = sorted(draw.sample(range(40), draw.randint(1, 20)))
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        at = np.arange(len(merged) + 1)
        wanted = [sum(side == 0 for _, side in merged[:k]) for k in at]
        assert diagonal(np.array(a), np.array(b), at).tolist() == wanted


@pytest.mark.parametrize("piece,batch", [(1, 1), (1, 4), (3, 3), (3, 12), (7, 14), (128, 128), (128, 1 << 20)])
def test_pieces_of_any_size_merge_alike(piece, batch):
    draw = random.Random(2)
    for _ in range(40):
        end = draw.randint(1, 60)
        a = np.array(sorted({*draw.sample(range(1, end + 1), draw.randint(1, end)), end}))
        b = np.array(sorted({*draw.sample(range(1, end + 1), draw.randint(1, end)), end}))
        owner_a, owner_b = np.searchsorted(a, np.arange(1, end + 1)), np.searchsorted(b, np.arange(1, end + 1))
        merge = Merge(a, b, piece, batch)
        assert list(zip(merge.link_a, merge.link_b, strict=True)) == sorted(set(zip(owner_a, owner_b, strict=True)))
        both = np.array(sorted(set(a.tolist()) & set(b.tolist())))
        assert merge.n_groups == len(both)
        assert merge.group_a.tolist() == np.searchsorted(both, a).tolist()
        assert merge.group_b.tolist() == np.searchsorted(both, b).tolist()


@pytest.mark.parametrize("slice_chars", [1, 300, 1 << 22])
def test_against_plain_version(spark, slice_chars):
    draw = random.Random(4)
    words = ["the", "The", "naïve", "日本語", "token's", "12345", "foo_bar", "😀", "a▁b", "<|endoftext|>", "<s>", "<0x41>", "ﬁ", "x" * 70]
    texts = [None, "", " ", "  two", "end ", "a\n\nb\tc", "a", "a", "▁"]
    texts += [draw.choice([" ", "  ", "\n"]).join(draw.choices(words, k=draw.randint(1, 30))) for _ in range(60)]
    texts.append(" ".join(draw.choices(words[:8], k=5000)))
    rows = [(k, t, 7) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pair int").repartition(3)
    found = {r.doc_id: tuple(r)[1:] for r in align(df, A, B, slice_chars=slice_chars, piece=16).collect()}
    assert [found[k] for k in range(len(texts))] == plain(texts)
    assert sum(f[0] > 0 for f in found.values()) > 30


def test_null_and_repeated_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "same text"), (1, "same text"), (1, None)], "doc_id long, text string")
    rows = sorted((r.doc_id is None, r.n_a, r.n_links) for r in align(df, A, B).collect())
    assert rows[0] == (False, 0, 0) and rows[1][1:] == rows[2][1:] and rows[2][0]
    assert align(df.limit(0), A, B).collect() == []


def test_pairs_are_told_apart_by_hash_as_by_sorting():
    rng = np.random.default_rng(4)
    for pairs in (rng.integers(0, 50, 3000) << 32, rng.integers(-5, 1 << 50, 200), np.array([7]), np.zeros(9, np.int64)):
        want = np.unique(pairs, return_inverse=True, return_counts=True)
        assert all((a == b).all() for a, b in zip(distinct_places(pairs), want, strict=True))


def test_tokens_that_differ_from_their_text_are_found_among_others():
    path = public_tokenizers.path(JSON_50K)
    tokenizer = Tokenizer.from_file(path)
    texts = ["", " a plain text", " é ▁ 你好", "", " another one " * 9000, " last"]
    ids = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts]
    assert same_bytes(texts, ids, path, byte_level_tokens) == [True] * 6
    # one byte moved to the neighbour leaves the whole as it was
    assert same_bytes([*texts[:1], " a plain tex", "t é ▁ 你好", *texts[3:]], ids, path, byte_level_tokens) == [True, False, False, True, True, True]
    assert same_bytes(texts, [*ids[:-1], ids[1]], path, byte_level_tokens) == [True] * 5 + [False]
    assert same_bytes([], [], path, byte_level_tokens) == []
    assert list(spans([3, 9, 1, 1, 0, 2], 4)) == [(0, 1), (1, 2), (2, 6)]


def test_a_slice_is_cut_into_words_part_by_part(monkeypatch):
    texts = [None, *(f"word{k} other " * 40 for k in range(60)), "", "x " * 3000, "end"]
    whole = T.slice_of(0, list(range(len(texts))), texts, A, B, 128)
    seen, of = [], {n: getattr(T, n) for n in ("json_ids", "piece_ids")}

    def noted(name):
        def get(*how):
            encode = of[name](*how)
            return lambda some: (seen.append([len(t) for t in some]), encode(some))[1]

        return get

    for name in of:
        monkeypatch.setattr(T, name, noted(name))
    monkeypatch.setattr(T, "PART_CHARS", 2000)
    parts = T.slice_of(0, list(range(len(texts))), texts, A, B, 128)
    assert all(len(sizes) == 1 or sum(sizes) <= 2000 + len(sizes) for sizes in seen) and len(seen) > 20
    assert all(np.array_equal(whole[c][0], parts[c][0]) for c in whole)


def test_the_tokenizer_of_plain_specials_is_the_only_one_loaded():
    load_json.cache_clear()
    json_ids.__wrapped__(A, True)
    assert load_json.cache_info().currsize == 0
