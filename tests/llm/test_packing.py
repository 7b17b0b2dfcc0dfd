"""Packing: every id once, gapless sequences, no padding, levels by sum of squares."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from canopy.llm.packing import Packer, pack
from canopy.llm.queries import WORD_49K
from canopy.llm.token_count import load_json


def slow_level(levels, size, window):
    """The level of least sum of squares, counted in full for each."""
    best = None
    for h in range(window - size, -1, -1):
        if h and not levels[h]:
            continue
        after = list(levels)
        if h:
            after[h] -= 1
        if h + size < window:
            after[h + size] += 1
        total = sum(n * n for n in after)
        if best is None or total < best[0]:
            best = total, h
    return best[1]


@pytest.mark.parametrize("window", [8, 32])
def test_levels_by_sum_of_squares(window):
    draw = random.Random(3)
    packer = Packer(window, 1 << 30)
    for doc in range(600):
        size = draw.randint(1, window)
        if size < window:
            assert packer.level_for(size) == slow_level(packer.levels.tolist(), size, window)
        packer.add(doc, np.arange(size, dtype=np.uint32))
    assert packer.n_open == packer.levels.sum() == sum(map(len, packer.at))


@pytest.mark.parametrize("open_windows", [0, 3, 1000])
@pytest.mark.parametrize("seed", range(4))
def test_every_id_once_and_no_padding(open_windows, seed):
    draw = random.Random(seed)
    docs = [np.arange(draw.choice([1, 3, 7, 16, 17, draw.randint(1, 90)]), dtype=np.uint32) for _ in range(draw.randint(0, 200))]
    packer = Packer(16, open_windows)
    for doc, ids in enumerate(docs):
        packer.add(doc, ids)
        assert packer.n_open <= open_windows + 1
    packer.finish()
    seen = defaultdict(list)
    short = []
    for sequence in packer.done:
        size = sum(len(p.ids) for p in sequence)
        assert 0 < size <= 16 and size & (size - 1) == 0
        short += [size] * (size < 16)
        for p in sequence:
            assert p.total == len(docs[p.doc]) and (p.ids == docs[p.doc][p.start : p.start + len(p.ids)]).all()
            seen[p.doc] += range(p.start, p.start + len(p.ids))
    assert len(set(short)) == len(short)  # one part-filled window at most, as binary digits
    assert {d: sorted(at) for d, at in seen.items()} == {d: list(range(len(ids))) for d, ids in enumerate(docs)}


def test_sizes_that_never_fit_together_stay_bounded():
    packer = Packer(16, 10)
    for doc in range(1000):
        packer.add(doc, np.zeros(9, np.uint32))
        assert packer.n_open <= 11
    packer.finish()
    assert sum(len(p.ids) for s in packer.done for p in s) == 9000


def test_against_the_library(spark):
    long = " ".join(f"Word{k % 977}'s number {k}," for k in range(4000))
    texts = ["A small text.", "", None, long, "A small text.", "<|endoftext|> a\tB\n\né", " "] + [f"text number {k} " * (k % 50) for k in range(200)]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(None, "no id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string").repartition(3)
    path = public_tokenizers.path(WORD_49K)
    found = pack(df, path, ids=True).collect()
    tokenizer = load_json(path)
    wanted = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for k, t, _ in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        assert r.length == len(r.ids) and r.doc_tokens == len(wanted[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc[r.doc_id].append((r.start, r.ids))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert {d: [i for _, ids in sorted(p) for i in ids] for d, p in by_doc.items()} == wanted
    for pieces in by_sequence.values():
        pieces.sort()
        size = sum(n for _, n in pieces)
        assert [at for at, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert size <= 2048 and size & (size - 1) == 0


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), public_tokenizers.path(WORD_49K)).collect() == []
