import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from canopy.llm import context_coder as C
from canopy.llm.token_count import load_json
from canopy.llm.token_files import read_token_files, write_token_files

PATH = P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("seed", range(6))
def test_round_trip_of_any_ids(seed):
    rng = np.random.default_rng(seed)
    streams = [
        rng.integers(0, 65536, 3000),
        rng.integers(0, 3, 5000),
        np.zeros(777, int),
        np.tile(rng.integers(0, 50257, 40), 60),
        np.minimum(rng.geometric(0.01, 4000), 65535),
        np.zeros(0, int),
        np.array([65535]),
    ]
    for ids in streams:
        for block in (1, 100, 2048):
            if block == 1 and len(ids) > 1000:
                continue
            blocks = C.encode_blocks(ids.astype(np.uint16), block)
            sizes = [min(block, len(ids) - k * block) for k in range(len(blocks))]
            assert (C.decode_blocks(blocks, sizes) == ids).all()
    assert sum(map(len, C.encode_blocks(streams[1].astype(np.uint16), 2048))) < 0.4 * len(streams[1])
    assert sum(map(len, C.encode_blocks(streams[3].astype(np.uint16), 2048))) < 0.3 * len(streams[3])


def test_blocks_are_independent():
    ids = np.random.default_rng(0).integers(0, 500, 4096).astype(np.uint16)
    blocks = C.encode_blocks(ids, 1024)
    assert (C.decode_blocks([blocks[2]], [1024]) == ids[2048:3072]).all()
    assert C.encode_blocks(ids[2048:3072], 1024) == [blocks[2]]


def test_ranges_over_a_multiple_of_a_word_are_cut():
    rng = np.random.default_rng(1)
    lanes, steps = 300, 400
    total = np.uint64(8192)
    said = rng.integers(0, 8192, (steps, lanes)).astype(np.uint64)
    one = lambda x: (x, np.ones(lanes, np.uint64))
    every, coder = np.arange(lanes), C.Encoder(lanes, steps + 1)
    coder.low[:] = np.uint64((1 << 40) - 1)  # just below a multiple
    coder.range[:] = np.uint64((1 << 33) + 5)
    for row in said:
        coder.pick(every, total, row, one)
    back = C.Decoder(coder.finish())
    back.low[:], back.range[:] = np.uint64((1 << 40) - 1), np.uint64((1 << 33) + 5)
    assert all((back.pick(every, total, lambda place: place, one) == row).all() for row in said)


def test_a_step_shifts_each_lane_once_at_most(monkeypatch):
    shifts, shift = [], C.Encoder.shift
    monkeypatch.setattr(C.Encoder, "shift", lambda self, lanes, low: (shifts.append(len(lanes)), shift(self, lanes, low))[1])
    blocks = C.encode_blocks(np.random.default_rng(2).integers(0, 65536, 6400).astype(np.uint16), 64)
    assert len(shifts) <= C.MOST_WORDS * 64 + 1 and sum(shifts) * 4 == sum(map(len, blocks))  # 32 bits each


def test_every_changed_byte_is_noticed():
    data = C.pack_segment([5, None, 7], [3, 0, 4], np.array([1, 2, 0, 9, 9, 9, 0]), 4)
    assert C.unpack_segment(data)[:2] == ([5, None, 7], [3, 0, 4])
    for k in range(len(data)):
        with pytest.raises(C.Corrupt):
            C.unpack_segment(data[:k] + bytes([data[k] ^ 1]) + data[k + 1 :])
        with pytest.raises(C.Corrupt):
            C.unpack_segment(data[:k])
    with pytest.raises(ValueError):
        C.pack_segment([1], [1], np.array([70000]), 4)


def want(rows):
    start, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*load_json(PATH).encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment_ids", [1, 500, 1 << 22])
def test_files(spark, docs, tmp_path, segment_ids):
    rng = random.Random(2)
    rows = [(i * 3 - 50, " ".join(rng.choice(["a", "the", "!", "é", "<|endoftext|>", "word"]) for _ in range(rng.randint(0, 80)))) for i in range(120)]
    rows += [(1, None), (2, ""), (None, "x"), (4, "y"), (4, "y"), (5000, "long text " * 20000)]
    rng.shuffle(rows)
    df = docs(rows).selectExpr("*", "1 as part", "2 as start").repartition(4)
    write_token_files(df, PATH, f"{tmp_path}/t", segment_ids=segment_ids, block_ids=300)
    back = read_token_files(spark.read.parquet(f"{tmp_path}/t"), ids=True).collect()
    assert sorted(map(str, (tuple(r)[:4] for r in back))) == sorted(map(str, want(rows)))
    by = {r.doc_id: r.ids for r in back}
    assert by[5000] == [*load_json(PATH).encode("long text " * 20000, add_special_tokens=False).ids, 0]


def test_empty_table(spark, docs, tmp_path):
    write_token_files(docs([]), PATH, f"{tmp_path}/t")
    assert read_token_files(spark.read.parquet(f"{tmp_path}/t")).collect() == []


def test_lanes_step_together_by_few_array_operations(monkeypatch):
    settled, settle = [], C.settle
    monkeypatch.setattr(C, "settle", lambda coder, lanes, low, size: (settled.append(len(size)), settle(coder, lanes, low, size)))
    ids = np.random.default_rng(3).integers(0, 50257, 64 * 100).astype(np.uint16)
    blocks = C.encode_blocks(ids, 64)
    assert len(settled) == 64  # an id takes one range, whichever prediction holds
    assert (C.decode_blocks(blocks, [64] * 100) == ids).all() and len(settled) == 128


def test_blocks_of_other_lengths_and_too_long_ones(monkeypatch):
    ids = np.random.default_rng(4).integers(0, 900, 8300).astype(np.uint16)

    def check(part, block):
        blocks = C.encode_blocks(part, block)
        sizes = [min(block, len(part) - k) for k in range(0, len(part), block)]
        assert (C.decode_blocks(blocks, sizes) == part).all()
        assert (C.decode_blocks(blocks[-1:], sizes[-1:]) == part[-sizes[-1] :]).all()
        return blocks

    for n, block in ((50, 1), (100, 3), (1000, 300), (100, 70000), (8300, 8200)):
        check(ids[:n], block)
    plain = check(ids[:1000], 300)
    monkeypatch.setattr(C, "pair_type", lambda steps: np.uint64)  # as for blocks of more than 65,536 ids
    assert check(ids[:1000], 300) == plain
    with pytest.raises(ValueError):
        C.encode_blocks(ids, C.MOST_IDS + 1)
