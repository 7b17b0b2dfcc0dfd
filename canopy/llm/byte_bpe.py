"""Byte-level BPE with numpy matrices of padded words.

A text is split by a pattern; the distinct words of a slice of documents
are put into matrices by length class (a power of two, so that at most half
of a row is padding).  In each round every row merges its leftmost pair of
minimum rank: ranks of adjacent pairs are held beside the ids, so a round
costs one arg-min, one shift and two hashed pair lookups a row.  Rows without
a pair left are taken out (compaction).  Rows longer than ``MATRIX_WIDTH``
are merged alone: all occurrences of the minimum pair at once, which equals
merging them one by one, leftmost first, unless a merge creates a pair of
lower rank; then only the leftmost is merged in that round.

The result is that of the tiktoken library for the same ranks: a word that
is itself a token is that token, other words are merged by rank.

Defined results: a null text counts as empty (no ids, empty bytes); an empty
table gives an empty table; repeated rows give one result row each; null ids
stay null; other columns of the input are ignored.  Decoding gives bytes: ids
cut anywhere need not be text.  An id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from canopy.llm.common import arrow_map

NO_PAIR = np.int32(2**31 - 1)
MATRIX_WIDTH = 256
#: Words whose ids a Python worker keeps between slices; beyond it, it starts again.
CACHED_WORDS = 120_000


class PairTable:
    """Open-addressing hash table from a pair of ids to the id of their merge."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(4, int(len(left) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NO_PAIR, np.int32)
        keys = self._key(left, right)
        slots, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slots[todo]] == -1]
            self.keys[slots[free]] = keys[free]  # of rivals for a slot one stays
            won = self.keys[slots[todo]] == keys[todo]
            self.values[slots[todo[won]]] = merged[todo[won]]
            todo = todo[~won]
            slots[todo] = (slots[todo] + 1) & self.mask

    @staticmethod
    def _key(left, right):
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id of each pair, NO_PAIR where there is none (a negative id pairs with nothing)."""
        keys = self._key(left, right)
        out = np.full(keys.shape, NO_PAIR, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        slots = self._slot(keys.ravel()[todo])
        flat, wanted = out.ravel(), keys.ravel()
        while len(todo):
            there = self.keys[slots]
            hit = there == wanted[todo]
            flat[todo[hit]] = self.values[slots[hit]]
            more = ~hit & (there != -1)
            todo, slots = todo[more], (slots[more] + 1) & self.mask
        return flat.reshape(keys.shape)


class MatrixBPE:
    """Encoder and decoder for one rank table (id = rank)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = {i: b for b, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[t[:k]], ranks[t[k:]], i)
            for t, i in ranks.items()
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        ]
        self.pairs = PairTable(*np.array(pairs or np.empty((0, 3)), np.int64).T)
        self.cache: dict[str, tuple[list[int], str, bytes]] = {}

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(words)
        classes: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if (own := self.ranks.get(w)) is not None:
                out[k] = [own]
            elif len(w) > MATRIX_WIDTH:
                out[k] = self._merge_long(w)
            elif w:
                classes.setdefault(max(2, 1 << (len(w) - 1).bit_length()), []).append(k)
        for width, rows in classes.items():
            for k, ids in zip(rows, self._merge_matrix([words[k] for k in rows], width), strict=True):
                out[k] = ids
        return out

    def _merge_matrix(self, words: list[bytes], width: int) -> list[list[int]]:
        n = len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        ids = np.where(np.arange(width) < lengths[:, None], self.byte_ids[data], np.int32(-1))
        ids = np.concatenate([ids, np.full((n, 1), -1, np.int32)], axis=1)  # a column of padding to shift from
        pair = np.concatenate([self.pairs.find(ids[:, :-1], ids[:, 1:]), np.full((n, 1), NO_PAIR, np.int32)], axis=1)
        done: list[list[int] | None] = [None] * n
        active, columns = np.arange(n), np.arange(width + 1)
        while len(active):
            at = pair.argmin(axis=1)
            rows = np.arange(len(active))
            best = pair[rows, at]
            ended = best == NO_PAIR
            if ended.any():
                for k, row in zip(active[ended].tolist(), ids[ended].tolist(), strict=True):
                    done[k] = [i for i in row if i >= 0]
                active, ids, pair, at, best = active[~ended], ids[~ended], pair[~ended], at[~ended], best[~ended]
                rows = np.arange(len(active))
                if not len(active):
                    break
            after = columns[None, :-1] > at[:, None]
            ids[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
            pair[:, :-1] = np.where(after, pair[:, 1:], pair[:, :-1])
            ids[:, -1] = -1
            pair[:, -1] = NO_PAIR
            ids[rows, at] = best
            pair[rows, at] = self.pairs.find(best, ids[rows, at + 1])
            before = np.flatnonzero(at > 0)
            pair[before, at[before] - 1] = self.pairs.find(ids[before, at[before] - 1], best[before])
        return done

    def _merge_long(self, word: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        while len(ids) > 1:
            pair = self.pairs.find(ids[:-1], ids[1:])
            best = pair.min()
            if best == NO_PAIR:
                break
            found = np.flatnonzero(pair == best)
            run = np.concatenate([[0], np.cumsum(np.diff(found) > 1)])  # neighbours overlap: each second one merges
            first = np.searchsorted(run, run)
            at = found[(np.arange(len(found)) - first) % 2 == 0]
            # from left to right, up to the first one that leaves a lower pair behind: that pair comes next
            follows = np.concatenate([[False], at[1:] == at[:-1] + 2])
            left = np.where(follows, best, ids[np.maximum(at - 1, 0)])
            right = ids[np.minimum(at + 2, len(ids) - 1)]
            lower = (at > 0) & (self.pairs.find(left, np.full_like(left, best)) < best)
            lower |= (at + 2 < len(ids)) & (self.pairs.find(np.full_like(right, best), right) < best)
            if lower.any():
                at = at[: int(lower.argmax()) + 1]
            merged = self._replaced(ids, at, best)
            ids = merged
        return ids.tolist()

    @staticmethod
    def _replaced(ids: np.ndarray, at: np.ndarray, merged: int) -> np.ndarray:
        out = ids.copy()
        out[at] = merged
        return np.delete(out, at + 1)

    def learn(self, texts: list[str]) -> list[list[str]]:
        """Split the texts; afterwards every word of them is in the cache."""
        split = [self.pattern.findall(t) for t in texts]
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        new = list(set(chain.from_iterable(split)) - self.cache.keys())
        for w, ids in zip(new, self.encode_words([w.encode() for w in new]), strict=True):
            self.cache[w] = ids, ",".join(map(str, ids)), self.decode(ids)
        return split

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [list(chain.from_iterable(self.cache[w][0] for w in words)) for words in self.learn(texts)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.token[i] for i in ids])


@lru_cache(maxsize=2)
def load_ranks(path: str, pattern: str) -> MatrixBPE:
    """The coder of a rank file (a base64 token and its rank a line), kept by each Python worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return MatrixBPE(ranks, pattern)


def encode_texts(df: DataFrame, path: str, pattern: str, *, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, ids``: the ids of each whole text."""

    def rows(given):
        yield {"doc_id": given[id_col], "ids": load_ranks(path, pattern).encode([t or "" for t in given[text_col]])}

    return arrow_map(df, [id_col, text_col], rows, "doc_id long, ids array<int>")


def decode_ids(df: DataFrame, path: str, pattern: str, *, id_col="doc_id", ids_col="ids") -> DataFrame:
    """``doc_id, data``: the bytes of each row of ids (null: empty)."""

    def rows(given):
        coder = load_ranks(path, pattern)
        yield {"doc_id": given[id_col], "data": [coder.decode(ids or []) for ids in given[ids_col]]}

    return arrow_map(df, [id_col, ids_col], rows, "doc_id long, data binary")


def round_trip_digests(df: DataFrame, path: str, pattern: str, *, id_col="doc_id", text_col="text", with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: the ids of each text
    (decimal, joined by commas) and the bytes decoded from them, as digests,
    so that neither leaves the task; ``with_ids`` also returns ``ids``."""

    def rows(given):
        coder = load_ranks(path, pattern)
        split = coder.learn([t or "" for t in given[text_col]])
        cache, n, ids, data = coder.cache, [], [], []
        for words in split:
            known = [cache[w] for w in words]
            n.append(sum([len(k[0]) for k in known]))
            ids.append(hashlib.sha256(",".join([k[1] for k in known]).encode()).hexdigest())
            data.append(hashlib.sha256(b"".join([k[2] for k in known])).hexdigest())
        out = {"doc_id": given[id_col], "n_tokens": n, "ids_sha256": ids, "decoded_sha256": data}
        if with_ids:
            out["ids"] = [list(chain.from_iterable([cache[w][0] for w in words])) for words in split]
        yield out

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return arrow_map(df, [id_col, text_col], rows, schema)
