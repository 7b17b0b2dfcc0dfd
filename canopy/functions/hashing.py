"""md5 of many short texts at once, one numpy lane a text."""

from __future__ import annotations

import hashlib
import math

import numpy as np

LANES = 16384  # texts hashed together; their state stays in the cache
BLOCK = 64
ROOM = 55  # bytes of a text that fit one block with the end mark and the length

_SINES = np.array([int(abs(math.sin(i + 1)) * 2**32) for i in range(64)], np.uint32)
_TURNS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _first_words(words: np.ndarray) -> np.ndarray:
    """The first four digest bytes, as a big-endian number, of one-block messages (16 words by messages)."""
    n = words.shape[1]
    a, b, c, d = (np.full(n, v, np.uint32) for v in _START)
    t, u = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        turn = i // 16
        if turn == 0:
            np.bitwise_xor(c, d, out=t)
            t &= b
            t ^= d
        elif turn == 1:
            np.bitwise_xor(b, c, out=t)
            t &= d
            t ^= c
        elif turn == 2:
            np.bitwise_xor(b, c, out=t)
            t ^= d
        else:
            np.invert(d, out=t)
            t |= b
            t ^= c
        t += a
        t += _SINES[i]
        t += words[(i, 5 * i + 1, 3 * i + 5, 7 * i)[turn] % 16]
        shift = _TURNS[turn][i % 4]
        np.left_shift(t, np.uint32(shift), out=u)
        t >>= np.uint32(32 - shift)
        u |= t
        u += b
        a, b, c, d, u = d, u, b, c, a
    return (a + np.uint32(_START[0])).byteswap()


def md5_numbers(offsets: np.ndarray, data: np.ndarray, endings: list[bytes]):
    """For each ending, the first 32 bits of ``md5(text + ending)`` of all texts (``data`` between ``offsets``)."""
    lengths = np.diff(offsets)
    n, widest = len(lengths), max(map(len, endings))
    short = np.flatnonzero(lengths + widest <= ROOM)
    long = np.flatnonzero(lengths + widest > ROOM)
    raw = data.tobytes() if len(long) else b""
    out = [np.empty(n, np.int64) for _ in endings]
    for first in range(0, len(short), LANES):
        at = short[first : first + LANES]
        own = lengths[at]
        place = np.arange(BLOCK)
        inside = place < own[:, None]
        block = np.zeros((len(at), BLOCK), np.uint8)
        block[inside] = data[(offsets[at][:, None] + place)[inside]]
        row = np.arange(len(at))
        for k, ending in enumerate(endings):
            block[:, ROOM + 1 :] = 0
            for j in range(widest + 1):  # the ending, its mark, and nothing of the one before
                block[row, own + j] = (ending + b"\x80")[j] if j <= len(ending) else 0
            words = np.ascontiguousarray(block.view("<u4").T)
            words[14] = (own + len(ending)) * 8
            out[k][at] = _first_words(words)
    for i in long:
        text = raw[offsets[i] : offsets[i + 1]]
        for k, ending in enumerate(endings):
            out[k][i] = int.from_bytes(hashlib.md5(text + ending).digest()[:4], "big")
    return out
