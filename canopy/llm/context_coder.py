"""Adaptive context-mixing range coder for blocks of token ids.

A block of ids is coded on its own: the coder and all its statistics start
afresh, and a checksum guards its bytes.  Many blocks are coded side by side,
one numpy lane each, so every step is a few array operations over all lanes.

A block begins with its ids in ascending order, by interpolation: the one in
the middle as so many bits as the bounds left and right of it leave open, then
those in the middle of both halves.  An id is then its place, the number of
smaller ids in the block, and is coded by up to three kinds of predictions:

* order 2: the place last seen after the two places before.  The probability
  that it is that one is mixed from what order 2 (its confidence), order 1 (its
  confidence, and whether it agrees) and order 0 (the overall share of hits)
  say, by weights that follow who was right;
* order 1: likewise for the place last seen after the one before, if it differs;
* order 0: otherwise the place itself, by how often its id is in the block.

Every lane takes every step in the same way, so nothing is picked out of the
lanes but those that shift. All arithmetic is of integers, so any machine
decodes what another encoded.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache
from itertools import groupby

import numpy as np

#: Ids are 16-bit numbers.
ID_LIMIT = 1 << 16
WORD, WORD_BITS, ALL_BITS = np.uint64(1 << 32), np.uint64(32), np.uint64((1 << 64) - 1)
#: Words an id can shift out: one for which prediction holds, one for its place, half of one in the list of ids.
MOST_WORDS = 3
#: A range of 2**32 leaves room for a probability and a place of such a block.
MOST_IDS = 1 << 20
ONE_BITS = 12
ONE = 1 << ONE_BITS  # probabilities are of so many parts
ONE_PART, ONE_MORE = np.uint64(ONE_BITS), np.uint64(1)


def zeros(n: int, kind) -> np.ndarray:
    """Memory that is written at once, which systems may give in large pages; those of ``np.zeros`` come one by one."""
    found = np.empty(n, kind)
    found.fill(0)
    return found


class Encoder:
    """Carry-less range encoder, one lane a block; 64-bit numbers, of which 32 bits at a time go out."""

    def __init__(self, lanes: int, words: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, ALL_BITS, np.uint64)
        self.out = zeros(words * lanes, np.uint32)  # a row holds all lanes' words of one number
        self.at = np.arange(lanes)

    def pick(self, lanes, total, known, bounds):
        """Code symbol ``known`` of each lane; ``bounds`` gives (low, size) of symbols."""
        low, size = bounds(known)
        part = self.range[lanes] // total
        settle(self, lanes, self.low[lanes] + low * part, size * part)
        return known

    def shift(self, lanes, low):
        at = self.at.take(lanes)
        self.out[at] = low >> WORD_BITS
        self.at[lanes] = at + len(self.low)

    def finish(self) -> list[bytes]:
        # the first number of 32 bits, then zeros, that isn't below ``low``; the range reaches farther
        self.shift(np.arange(len(self.low)), self.low + (WORD - np.uint64(1)))
        words = self.at // len(self.low)
        out = np.ascontiguousarray(self.out.reshape(-1, len(self.low))[: words.max()].T, ">u4")
        return [row[:n].tobytes() for row, n in zip(out, words.tolist(), strict=True)]


class Decoder:
    """The counterpart of ``Encoder``."""

    def __init__(self, data: list[bytes]):
        lanes, self.words = len(data), max(map(len, data)) // 4 + 2
        width = 4 * self.words
        words = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in data), ">u4").reshape(lanes, self.words)
        self.data = np.ascontiguousarray(words.T, np.uint32).ravel()  # a row holds all lanes' words of one number
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, ALL_BITS, np.uint64)
        self.begin(np.arange(lanes))

    def begin(self, at: np.ndarray) -> None:
        """Each lane's first number is its two words from ``at`` on."""
        one, two = (self.data.take(at + k * len(at), mode="clip").astype(np.uint64) for k in range(2))
        self.at, self.code = at + 2 * len(at), (one << WORD_BITS) | two

    def pick(self, lanes, total, find, bounds):
        """The coded symbol of each lane; ``find`` turns a place below ``total`` into its symbol."""
        part, start = self.range[lanes] // total, self.low[lanes]
        place = np.minimum((self.code[lanes] - start) // part, total - np.uint64(1))
        symbol = find(place)
        low, size = bounds(symbol)
        settle(self, lanes, start + low * part, size * part)
        return symbol

    def shift(self, lanes, low):
        at = self.at.take(lanes)
        self.code[lanes] = (self.code.take(lanes) << WORD_BITS) | self.data.take(at, mode="clip")
        self.at[lanes] = at + len(self.low)


def settle(coder, lanes, low, size) -> None:
    """Take over the lanes' new range; those whose range got small shift 32 bits out (or in), once."""
    coder.low[lanes], coder.range[lanes] = low, size
    at = np.flatnonzero(size < WORD)
    if len(at):
        low, size = low.take(at), size.take(at)
        lanes = at if isinstance(lanes, slice) else lanes.take(at)
        # a range that reaches over a multiple of 2**32 ends there
        size = np.minimum(size, WORD - (low & (WORD - np.uint64(1))))
        coder.shift(lanes, low)
        coder.low[lanes], coder.range[lanes] = low << WORD_BITS, size << WORD_BITS


@lru_cache(maxsize=8)
def levels(n: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each level of halving places 1 to ``n``: those in the middle, and those that bound them left and right."""
    a, b, out = np.zeros(1, np.int64), np.full(1, n), []
    while len(a):
        middle = (a + b) >> 1
        out.append((middle + 1, a, b + 1))
        a, b = np.concatenate([a, middle + 1]), np.concatenate([middle, b])
        some = a < b
        a, b = a[some], b[some]
    return out


#: How many bits a number below ``ID_LIMIT`` has.
BITS = np.repeat(np.arange(17, dtype=np.uint8), [1, *(1 << k for k in range(16))])


def put_sorted(coder: Encoder, first: int, ids: np.ndarray) -> None:
    """Write the ascending ``ids`` (places x lanes) of the lanes from ``first`` on."""
    n, lanes = ids.shape
    bounded = np.zeros((n + 2, lanes), np.int32)
    bounded[1:-1], bounded[-1] = ids, ID_LIMIT - 1
    rest, width = np.empty((n, lanes), np.uint64), np.empty((n, lanes), np.int32)
    done = 0
    for middle, left, right in levels(n):
        own = slice(done, done := done + len(middle))
        low = bounded[left]
        rest[own] = bounded[middle] - low
        width[own] = BITS.take(bounded[right] - low)
    ends = np.cumsum(width, axis=0, dtype=np.int32)
    words = (ends[-1] + 31) >> 5
    most = int(words.max()) + 1
    ends -= width
    rest <<= (64 - width - (ends & 31)).view(np.uint32)
    where = ((ends >> 5) * np.int64(lanes) + np.arange(lanes)).ravel()
    # bits of different numbers don't meet, and their sums are exact
    out = np.bincount(where, (rest >> WORD_BITS).ravel(), most * lanes)
    out[lanes:] += np.bincount(where, rest.astype(np.uint32).ravel(), most * lanes)[:-lanes]
    out = out.astype(np.uint64).reshape(most, lanes) << WORD_BITS
    for k in range(most):
        own = np.flatnonzero(words > k)
        if len(own):
            coder.shift(own + first, out[k, own])


def get_sorted(coder: Decoder, first: int, n: int, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """What ``put_sorted`` wrote (places x lanes), and where each lane goes on."""
    bounded = np.zeros((n + 2, lanes), np.int32)
    bounded[-1] = ID_LIMIT - 1
    at, base, row = np.zeros(lanes, np.int32), np.arange(lanes) + first, np.int64(len(coder.low))
    for middle, left, right in levels(n):
        low = bounded[left]
        width = BITS.take(bounded[right] - low, mode="clip")
        ends = np.cumsum(width, axis=0, dtype=np.int32)
        ends += at
        at = ends[-1].copy()
        ends -= width
        where = (ends >> 5) * row + base
        bits = (coder.data.take(where, mode="clip").astype(np.uint64) << WORD_BITS) | coder.data.take(where + row, mode="clip")
        bits <<= (ends & 31).view(np.uint32)
        bits >>= np.uint8(63) - width
        bounded[middle] = low + (bits >> np.uint64(1)).astype(np.int32)
    return bounded[1:-1], ((at + 31) >> 5) * row + base


def paired(ids: np.ndarray, kind) -> np.ndarray:
    """Of ascending ids (lanes x places): the first place of the same id, and how many it has less one (``code_lanes``)."""
    edge = np.ones(ids.shape, bool)
    np.not_equal(ids[:, 1:], ids[:, :-1], out=edge[:, 1:])
    starts = np.flatnonzero(edge)
    counts = np.diff(starts, append=ids.size)
    pairs = ((starts % ids.shape[1]) << np.dtype(kind).itemsize * 4) + (counts - 1)
    return np.repeat(pairs.astype(kind), counts).reshape(ids.shape)


class Mixed:
    """Probability that a guess is right: order 0's share of hits, drawn by weights towards the counters of higher orders."""

    def __init__(self, lanes: int, states: tuple[int, ...]):
        self.share = np.full(lanes, ONE // 2, np.int32)
        self.counters = [np.full(lanes * n, ONE // 2, np.int32) for n in states]
        self.base = [np.arange(lanes) * n for n in states]
        self.weights = [np.full(lanes, ONE // 2, np.int32) for _ in states]

    def probability(self, n: int, *states: np.ndarray) -> np.ndarray:
        """``states``: how sure each higher order is, the lowest first."""
        p, self.seen = self.share[:n], []
        for counter, base, weight, state in zip(self.counters, self.base, self.weights, states, strict=True):
            said = counter.take(at := base[:n] + state)
            off = said - p
            p = p + ((off * weight[:n]) >> ONE_BITS)
            self.seen.append((at, said, off, p))
        return np.minimum(np.maximum(p, 16), ONE - 16)

    def learn(self, n: int, asked: np.ndarray, truth: np.ndarray) -> None:
        """Counters and weights follow the truth (0 or ``ONE``); ``asked`` is 0 for a lane that wasn't asked, else -1."""
        share = self.share[:n]
        share += ((truth - share) >> 4) & asked
        error = (truth - self.seen[-1][-1]) & asked
        for counter, weight, (at, said, off, _) in zip(self.counters, self.weights, self.seen, strict=True):
            counter[at] = said + (((truth - said) >> 4) & asked)
            off *= error
            off >>= 14
            weight = weight[:n]
            weight += off


def updated(guess: np.ndarray, sure: np.ndarray, got: np.ndarray) -> np.ndarray:
    """The entries of a table of guesses (place and how sure it is, 0: none) after ``got`` was seen.

    A guess gets surer by one up to 7 if it is right, else half as sure; one that is at most 1 gives way to what was seen.
    """
    kind = guess.dtype.type
    differs = guess ^ got
    right = (differs == 0).astype(kind)
    differs &= -(sure < 2).astype(kind)
    differs ^= guess
    differs <<= kind(3)
    less = np.maximum(sure >> kind(1), kind(1))
    differs |= less
    more = np.minimum(sure + kind(1), kind(7))
    more -= less
    more *= right
    differs += more
    return differs


def pair_type(steps: int):
    """Half of its bits hold a place of a block, or a count."""
    return np.uint32 if steps <= 1 << 16 else np.uint64


def code_lanes(coder, lengths: np.ndarray, known: np.ndarray | None, found: np.ndarray | None, steps: int) -> np.ndarray:
    """Code the lanes; lengths descend.  Returns the places (steps x lanes).

    A place is given with how often its id is in the block, as ``place << bits | count - 1``, ``bits`` half of
    the number's: ``known`` (steps x lanes) when encoding, ``found`` (lanes x places, by any place of the id) when decoding.
    """
    pairs = found.ravel() if known is None else known
    kind, bits, lanes = pairs.dtype.type, pairs.dtype.itemsize * 4, len(lengths)
    cell = np.uint16 if steps <= 1 << 13 else np.uint32  # a place and how sure it is
    out = np.zeros((steps, lanes) if known is None else (0, lanes), cell)
    slots = max(8, (steps - 1).bit_length())
    tables = zeros(lanes * steps + (lanes << slots), cell)
    table1, table2 = tables[: lanes * steps], tables[lanes * steps :]
    hit2, hit1 = Mixed(lanes, (16, 8)), Mixed(lanes, (8,))
    before, mixed2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.uint32)
    every, last, lane_step = np.arange(lanes), np.uint64(steps - 1), np.int64(lanes)
    base, base2 = every * steps, every << slots
    sizes = np.array([(m - 1).bit_length() for m in lengths.tolist()], np.uint64)  # a place is of so many bits
    down = np.uint32(32) - np.maximum(sizes, 8).astype(np.uint32)  # leaves the bits of a context's hash
    half, low_bits = kind(bits), kind((1 << bits) - 1)
    n, edges, answers = lanes, np.zeros((4, lanes), np.uint64), np.zeros((3, lanes), cell)
    flat_edges, flat_answers = edges.ravel(), answers.ravel()
    for step in range(steps):
        while lengths[n - 1] <= step:  # lanes that ended are the last ones
            n -= 1
        x1 = before[:n].astype(np.uint32)
        at1 = base[:n] + before[:n]
        at2 = (x1 * np.uint32(0x85EBCA6B) + mixed2[:n]) >> down[:n]
        at2 = at2 + base2[:n]
        said1, said2 = table1.take(at1), table2.take(at2)
        sure1, sure2 = said1 & cell(7), said2 & cell(7)
        guess1, guess2 = said1 >> cell(3), said2 >> cell(3)
        agree = guess1 == guess2
        asked2 = sure2 > 0
        asked1 = sure1 > 0
        asked1 &= ~(agree & asked2)
        p2 = hit2.probability(n, sure1 + (agree.view(np.uint8) << 3), sure2) * asked2
        p1 = hit1.probability(n, sure1) * asked1
        p1 *= ONE - p2
        p1 >>= ONE_BITS
        p1 += p2
        part, low = coder.range[:n] >> ONE_PART, coder.low[:n]
        # what lies below edge k + 1 and not below edge k: order 2's guess, order 1's, neither
        np.multiply(p2.astype(np.uint64), part, out=edges[1, :n])
        np.multiply(p1.astype(np.uint64), part, out=edges[2, :n])
        np.left_shift(part, ONE_PART, out=edges[3, :n])
        if known is None:
            at = coder.code[:n] - low
            which = (at >= edges[1, :n]).view(np.int8) + (at >= edges[2, :n]).view(np.int8)
        else:
            pair = known[step, :n]
            got = (pair >> half).astype(cell)
            not2 = (guess2 != got) | ~asked2
            which = not2.view(np.int8) + (not2 & ((guess1 != got) | (p1 == p2))).view(np.int8)
        where = which * lane_step
        where += every[:n]
        begin = flat_edges.take(where)
        size = flat_edges.take(where + lanes)
        size -= begin
        miss = which == 2
        size >>= miss * sizes[:n]
        if known is None:
            at -= begin
            at //= size
            np.minimum(at, last, out=at)
            pair = pairs.take(at.view(np.int64) + base[:n])
        pair = pair & -miss.astype(kind)  # a guess that is right begins at 0 and has the whole size
        place = pair >> half
        begin += place * size
        begin += low
        pair &= low_bits
        size *= pair + ONE_MORE
        settle(coder, slice(n), begin, size)
        if known is None:
            answers[0, :n], answers[1, :n], answers[2, :n] = guess2, guess1, place
            got = flat_answers.take(where)
            out[step, :n] = got
        hit2.learn(n, -asked2.astype(np.int32), (which == 0).astype(np.int32) << ONE_BITS)
        hit1.learn(n, -(asked1 & (which > 0)).astype(np.int32), (which == 1).astype(np.int32) << ONE_BITS)
        table1[at1] = updated(guess1, sure1, got)
        table2[at2] = updated(guess2, sure2, got)
        np.multiply(x1, np.uint32(0xC2B2AE35), out=mixed2[:n])
        before[:n] = got
    return out


#: Blocks coded side by side: enough to make numpy's calls cheap, few enough to keep their tables (about 8 kB each) near.
LANES = 8192


def runs(lengths: list[int], most: int = 256) -> list[tuple[int, int, int]]:
    """Stretches of lanes of one length, so few that what is made of them stays near: first lane, number of lanes, length."""
    out, at = [], 0
    for n, own in groupby(lengths):
        end = at + len([*own])
        out += [(k, min(most, end - k), n) for k in range(at, end, most)]
        at = end
    return out


def encode_blocks(ids: np.ndarray, block: int) -> list[bytes]:
    """The stream cut in blocks of ``block`` ids (the last may be short), each as bytes of its own."""
    if block > MOST_IDS:
        raise ValueError(f"blocks of {MOST_IDS} ids at most")
    group = LANES * block
    return [b for k in range(0, len(ids), group) for b in encode_group(ids[k : k + group], block)]


def encode_group(ids: np.ndarray, block: int) -> list[bytes]:
    lengths = [min(block, len(ids) - k) for k in range(0, len(ids), block)]
    lanes, steps = len(lengths), lengths[0]
    coder = Encoder(lanes, MOST_WORDS * steps + 2)
    known = np.zeros((steps, lanes), kind := pair_type(steps))
    half = kind(known.itemsize * 4)
    for lane, m, n in runs(lengths):
        key = ids[lane * block :][: m * n].reshape(m, n).astype(kind) << half
        key |= np.arange(n, dtype=kind)
        key.sort(axis=1)
        ordered = (key >> half).astype(np.uint16)
        put_sorted(coder, lane, ordered.T)
        at = (key & kind((1 << int(half)) - 1)).astype(np.int64) + np.arange(0, m * n, n)[:, None]
        own = np.empty(m * n, kind)
        own[at.ravel()] = paired(ordered, kind).ravel()
        known[:n, lane : lane + m] = own.reshape(m, n).T
    code_lanes(coder, np.array(lengths), known, None, steps)
    return coder.finish()


def decode_blocks(blocks: list[bytes], lengths: list[int]) -> np.ndarray:
    found = [np.zeros(0, np.uint16)]
    for at in range(0, len(blocks), LANES):
        found += decode_group(blocks[at : at + LANES], lengths[at : at + LANES])
    return np.concatenate(found)


def decode_group(blocks: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    lanes, steps = len(lengths), lengths[0]
    coder = Decoder(blocks)
    ids, found = (zeros(lanes * steps, kind).reshape(lanes, steps) for kind in (np.uint16, pair_type(steps)))
    begin = np.zeros(lanes, np.int64)
    for lane, m, n in runs(lengths):
        own = slice(lane, lane + m)
        ordered, begin[own] = get_sorted(coder, lane, n, m)
        ids[own, :n] = ordered.T
        found[own, :n] = paired(ids[own, :n], found.dtype)
    coder.begin(begin)
    places = code_lanes(coder, np.array(lengths), None, found, steps).T
    out = ids.ravel().take(places + np.arange(0, ids.size, steps)[:, None])
    return [out[lane : lane + m, :n].ravel() for lane, m, n in runs(lengths)]


# Fixed values of the segment format: name and version, then little-endian fields.
MAGIC = b"CMRC\x03"
HEAD = struct.Struct("<III")  # documents, blocks, ids a block
BLOCK = struct.Struct("<III")  # ids, bytes, checksum


class Corrupt(ValueError):
    """Bytes that are not what was written."""


def pack_segment(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, block: int) -> bytes:
    """A segment of whole documents: header with its own checksum, then the blocks with theirs."""
    if len(ids) and int(ids.max()) >= ID_LIMIT:
        raise ValueError("ids of 16 bits only")
    blocks = encode_blocks(ids.astype(np.uint16), block)
    sizes = [min(block, len(ids) - k * block) for k in range(len(blocks))]
    null = np.array([i is None for i in doc_ids], np.uint8).tobytes()
    names = np.array([i or 0 for i in doc_ids], "<i8").tobytes()
    head = HEAD.pack(len(doc_ids), len(blocks), block) + null + names + np.array(counts, "<u8").tobytes()
    head += b"".join(BLOCK.pack(n, len(b), zlib.crc32(b)) for n, b in zip(sizes, blocks, strict=True))
    return MAGIC + head + struct.pack("<I", zlib.crc32(head)) + b"".join(blocks)


def unpack_segment(data: bytes) -> tuple[list[int | None], list[int], np.ndarray]:
    """Document ids, counts and all ids of a segment; every checksum is verified."""
    if data[: len(MAGIC)] != MAGIC or len(data) < len(MAGIC) + HEAD.size:
        raise Corrupt("not a segment")
    at = len(MAGIC) + HEAD.size
    n_docs, n_blocks, _ = HEAD.unpack(data[len(MAGIC) : at])
    end = at + 17 * n_docs + BLOCK.size * n_blocks
    head = data[len(MAGIC) : end]
    if len(data) < end + 4 or struct.unpack("<I", data[end : end + 4])[0] != zlib.crc32(head):
        raise Corrupt("header checksum")
    null = data[at : at + n_docs]
    names = np.frombuffer(data, "<i8", n_docs, at + n_docs).tolist()
    counts = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).tolist()
    table = [BLOCK.unpack_from(data, at + 17 * n_docs + BLOCK.size * k) for k in range(n_blocks)]
    blocks, at = [], end + 4
    for _, size, checksum in table:
        blocks.append(data[at : at + size])
        at += size
        if len(blocks[-1]) != size or zlib.crc32(blocks[-1]) != checksum:
            raise Corrupt(f"checksum of block {len(blocks) - 1}")
    ids = decode_blocks(blocks, [n for n, _, _ in table])
    if len(ids) != sum(counts):
        raise Corrupt("counts")
    return [None if z else i for z, i in zip(null, names, strict=True)], counts, ids
