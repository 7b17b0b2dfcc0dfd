"""Token ids of whole texts by a byte-level BPE, put together from those of their words, without a Python string a word.

Like ``word_ids``, by which new words get their ids, but words are found and
looked up as bytes, all words of a slice of texts at once.  A word begins

* before a single space between two characters that are no white space: no
  token reaches from the left into white space;
* before and after a single line end between two such characters, which is a
  token of its own;
* before one of ``.,;:!?`` behind an ASCII letter or digit or one of the letters
  from U+00C0 to U+00FF: the splitter parts letters, digits and others.

A word of up to 15 bytes is two 64-bit numbers, its bytes and their number,
which an open hash table holds as they are; longer ones are keys of a dict.
Memory is bounded: beyond ``kept`` words of either kind those stay that were
met again, half of ``kept`` at most.  A tokenizer of another shape, or one with
a special string that holds any of these, encodes each text by ``json_ids``.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from canopy.llm.token_count import byte_level_splice, load_json
from canopy.llm.word_ids import LETTERS_END, MARK, json_ids, ragged

#: Bytes that aren't, and don't begin, a character that is surely no white space; ASCII controls count as white space.
WHITE = np.array([b <= 0x20 or b == 0x7F for b in range(256)])
BREAK = np.array([b in b" \n" for b in range(256)])
POINT = np.array([b in b".,;:!?" for b in range(256)])
NAME = np.array([bytes([b]).isalnum() for b in range(256)])  # ASCII only
LATIN = np.array([0x80 <= b < 0xC0 and b not in (0x97, 0xB7) for b in range(256)])  # letters, behind byte C3
LINE, LATIN_FIRST, SPACE = 0x0A, 0xC3, 0x20
#: First bytes of white space beyond ASCII, by the character in UTF-8.
FAR_WHITE = [c.encode() for c in map(chr, range(0x80, 0x3001)) if c.isspace()]
FAR_FIRST = np.array([b in {w[0] for w in FAR_WHITE} for b in range(256)])
#: Row n: which bits of two numbers belong to the first n bytes, and n as the last byte.
SHORT = 15
MASKS = np.array([[(1 << 8 * min(n, 8)) - 1, (1 << 8 * max(n - 8, 0)) - 1] for n in range(SHORT + 1)], np.uint64)
TOP = np.uint64(56)
WINDOW = 1 << 22


def white(data: np.ndarray) -> np.ndarray:
    """Whether each byte is of white space (bytes of a cut character: of none)."""
    found = WHITE.take(data)
    far = np.flatnonzero(FAR_FIRST.take(data))
    if len(far):
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        three = [padded.take(far + k) for k in range(3)]
        for w in FAR_WHITE:
            own = np.logical_and.reduce([part == b for part, b in zip(three, w, strict=False)])
            if own.any():
                at = far[own]
                for k in range(len(w)):
                    found[np.minimum(at + k, len(data) - 1)] = True
    return found


def word_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where words begin; ``texts`` are the places where texts do, in order."""
    found = []
    for a in range(0, len(data), WINDOW):
        b = min(a + WINDOW, len(data))
        left, right = max(a - 4, 0), min(b + 4, len(data))  # what decides may lie beyond the edge
        part = data[left:right]
        blank, name = white(part), NAME.take(part)
        name[1:] |= LATIN.take(part[1:]) & (part[:-1] == LATIN_FIRST)
        cut = np.zeros(len(part), bool)
        cut[1:-1] = BREAK.take(part[1:-1]) & ~blank[:-2] & ~blank[2:]
        cut[1:] |= (cut & (part == LINE))[:-1] | (POINT.take(part[1:]) & name[:-1])
        cut = cut[a - left : b - left]
        own = texts[np.searchsorted(texts, a) : np.searchsorted(texts, b)]
        cut[own - a] = True
        found.append(np.flatnonzero(cut) + a)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


#: How a byte-level BPE writes the bytes: printable ones of Latin 1 as they are, the others from U+0100 on.
SHOWN = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
AS_LETTERS = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in SHOWN)}


SHOWN_SPACE = chr(AS_LETTERS[SPACE])


def as_letters(word: str) -> str:
    return word.encode().decode("latin-1").translate(AS_LETTERS)


def one_token(word: str) -> bool:
    """Whether ``word`` is letters, with or without a space before them, and stays in one part."""
    name = word.removeprefix(" ")
    return name.isalpha() and max(name) < LETTERS_END


def joinable(word: str) -> bool:
    """Whether ``word`` between marks has the ids it has alone."""
    first = word[1:2] if word[0] == " " else word[0]
    return first > "'" and not first.isspace() and not word[-1].isspace() and len(word) <= 64 and MARK not in word


class ByteWords:
    """Ids of the texts of Arrow columns, each text's followed by an end id."""

    def __init__(self, path: str, end_id: int, *, kept: int = 1 << 20, words_at_once: int = 1 << 17):
        self.plain = json_ids(path)
        with open(path, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f).get("added_tokens") or []]
        self.by_bytes = byte_level_splice(path) is not None and self.plain.mark_id is not None
        self.by_bytes &= not any(t.isalpha() or any(c.isspace() or c in f"{MARK}.,;:!?" for c in t) for t in special)
        self.model = load_json(path).model
        self.end_id, self.kept, self.words_at_once = end_id, kept, words_at_once
        self.bits = max(4, int(2 * kept - 1).bit_length())  # the table is at most half full, and what one call adds
        self.down = np.uint64(64 - self.bits)
        self._clear()

    def _clear(self) -> None:
        self.key0, self.key1 = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.uint64)
        self.place = np.zeros(1 << self.bits, np.int32)
        self.long: dict[bytes, int] = {}
        # place 0: the end
        self.n, self.n_ids, self.n_short = 1, 1, 0
        self.start, self.size, self.again = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, bool)
        self.size[0] = 1
        self.ids = np.full(1 << 14, self.end_id, np.uint32)

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """New places for words that have so many of the ids each."""
        n, n_ids = self.n + len(sizes), self.n_ids + len(ids)
        if n > len(self.start):
            self.start, self.size, self.again = (np.concatenate([x, np.zeros(n + n // 2 - len(x), x.dtype)]) for x in (self.start, self.size, self.again))
        if n_ids > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(n_ids + n_ids // 2 - len(self.ids), np.uint32)])
        self.start[self.n : n] = self.n_ids + np.cumsum(sizes) - sizes
        self.size[self.n : n] = sizes
        self.again[self.n : n] = False
        self.ids[self.n_ids : n_ids] = ids
        places = np.arange(self.n, n)
        self.n, self.n_ids = n, n_ids
        return places

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words by the library, one word's after the other's, and how many each has."""
        sizes, flat, parts, names = np.zeros(len(words), np.int64), [], [], {}
        letters, joined, single = [k for k, w in enumerate(words) if w.removeprefix(b" ").isalpha()], [], []
        shown = b"\n".join([words[k] for k in letters]).decode().replace(" ", SHOWN_SPACE).split("\n") if letters else []
        left = set(range(len(words))).difference(letters)
        for k in left:
            names[k] = word = words[k].decode()
            if one_token(word):
                letters.append(k)
                shown.append(as_letters(word))
            else:
                (joined if joinable(word) else single).append(k)
        # the splitter leaves letters whole, so the model alone will do
        tokenize, counts = self.model.tokenize, []
        for word in shown:
            own = [t.id for t in tokenize(word)]
            counts.append(len(own))
            flat += own
        sizes[letters] = counts
        parts.append(np.array(flat, np.uint32))
        for a in range(0, len(joined), 64):
            own = joined[a : a + 64]
            # a word, the mark, a word, the mark, ...; each mark is one id
            row = np.array(self.plain.encode([MARK.join([*(names[k] for k in own), ""])])[0], np.uint32)
            ends = np.flatnonzero(row == self.plain.mark_id)
            sizes[own] = np.diff(ends, prepend=-1) - 1
            parts.append(row[row != self.plain.mark_id])
        if single:
            found = self.plain.encode([names[k] for k in single])
            sizes[single] = list(map(len, found))
            parts.append(np.fromiter(chain.from_iterable(found), np.uint32))
        order = np.array(letters + joined + single, np.int64)  # as the ids come
        starts = np.zeros(len(words), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate(parts)[ragged(starts, sizes)], sizes

    def _slots(self, key0: np.ndarray, key1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key its slot, or the first free one where it would be, and whether it is there."""
        mixed = key0 * np.uint64(0x9E3779B97F4A7C15) + key1 * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        slots = (mixed >> self.down).view(np.int64)
        there1 = self.key1.take(slots)
        found = (there1 == key1) & (self.key0.take(slots) == key0)
        open_ = np.flatnonzero(~found & (there1 != 0))
        last = len(self.key1) - 1
        while len(open_):
            at = (slots.take(open_) + 1) & last
            slots[open_] = at
            there1 = self.key1.take(at)
            same = (there1 == key1.take(open_)) & (self.key0.take(at) == key0.take(open_))
            found[open_] = same
            open_ = open_[~same & (there1 != 0)]
        return slots, found

    def _put(self, keys: np.ndarray, places: np.ndarray) -> None:
        """Different new keys (rows of two numbers) into the table."""
        left = np.arange(len(keys))
        while len(left):
            slots, _ = self._slots(keys[left, 0], keys[left, 1])
            _, one = np.unique(slots, return_index=True)  # one key a slot; the others look on
            at, own = slots[one], left[one]
            self.key0[at], self.key1[at], self.place[at] = keys[own, 0], keys[own, 1], places[own]
            left = np.delete(left, one)
        self.n_short += len(keys)

    def _forget(self) -> None:
        """Words met again stay, half of ``kept`` at most."""
        slots = np.flatnonzero(self.key1)
        slots = slots[self.again[self.place[slots]]][: self.kept // 2]
        keys, places = np.stack([self.key0[slots], self.key1[slots]], axis=1), self.place[slots]
        long = [(w, p) for w, p in self.long.items() if self.again[p]][: self.kept // 2]
        old = np.concatenate([places, np.fromiter((p for _, p in long), np.int64, len(long))]).astype(np.int64)
        sizes = self.size[old]
        ids = self.ids[ragged(self.start[old], sizes)]
        self._clear()
        new = self._add(ids, sizes)
        self._put(keys, new[: len(keys)])
        self.long.update(zip((w for w, _ in long), new[len(keys) :].tolist(), strict=True))

    def _places(self, data: np.ndarray, padded: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The places of the words at these stretches of ``data``."""
        if max(self.n_short, len(self.long)) > self.kept - min(len(starts), self.kept // 2):
            self._forget()
        at8 = np.ndarray((len(padded) - 15,), "<u8", padded, 0, (1,))
        after = np.ndarray((len(padded) - 15,), "<u8", padded, 8, (1,))
        masks = MASKS.take(np.minimum(sizes, SHORT), axis=0)
        key0 = at8[starts] & masks[:, 0]
        key1 = (after[starts] & masks[:, 1]) | (sizes.astype(np.uint64) << TOP)
        long = np.flatnonzero(sizes > SHORT)
        slots, found = self._slots(key0, key1)
        places = self.place.take(slots).astype(np.int64)
        found[long] = True
        self.again[places[found]] = True
        new = np.flatnonzero(~found)
        if len(new):
            rows = np.stack([key0[new], key1[new]], axis=1)
            different, one, which = np.unique(rows.view("S16").ravel(), return_index=True, return_inverse=True)
            own = rows[one]
            words = [w[: w[15]] for w in different.tolist()]
            added = self._add(*self._encoded(words))
            self._put(own, added)
            places[new] = added[which]
        if len(long):
            raw = data.tobytes() if len(data) < WINDOW else None
            ends = (starts + sizes)[long].tolist()
            words = [raw[a:b] if raw else data[a:b].tobytes() for a, b in zip(starts[long].tolist(), ends, strict=True)]
            known = list(map(self.long.get, words))
            unknown = list({w for w, p in zip(words, known, strict=True) if p is None})
            self.again[[p for p in known if p is not None]] = True
            if unknown:
                self.long.update(zip(unknown, self._add(*self._encoded(unknown)).tolist(), strict=True))
            places[long] = [self.long[w] for w in words]
        return places

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column, and how many each text has with its end id; null is the empty text."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = pc.fill_null(texts, "")
        if not self.by_bytes:
            end = np.array([self.end_id], np.uint32)
            found = [np.concatenate([ids, end]) for ids in self.plain(texts.to_pylist())]
            return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))
        wide = pa.types.is_large_string(texts.type)
        offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset :][: len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets -= offsets[0]
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        some = offsets[:-1][offsets[1:] > offsets[:-1]]
        starts = word_starts(data, some)
        sizes = np.diff(starts, append=len(data))
        found = []
        upto = np.searchsorted(starts, offsets[1:])  # words that begin before a text's end
        for a in range(0, max(len(starts), 1), self.words_at_once):
            b = min(a + self.words_at_once, len(starts))
            places = self._places(data, padded, starts[a:b], sizes[a:b])
            ends = upto[np.searchsorted(upto, a, "right" if a else "left") : np.searchsorted(upto, b, "right")]
            places = np.insert(places, ends - a, 0)
            counts = self.size[places]
            found.append((self.ids[ragged(self.start[places], counts)], counts, places == 0))
        sizes = np.concatenate([c for _, c, _ in found])
        ends = np.cumsum(sizes)[np.concatenate([e for _, _, e in found])]
        return np.concatenate([i for i, _, _ in found]), np.diff(ends, prepend=0)


@lru_cache(maxsize=2)
def byte_words(path: str, end_id: int) -> ByteWords:
    """A worker's own, with the words it has met."""
    return ByteWords(path, end_id)
