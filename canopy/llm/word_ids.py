"""Token ids of whole texts, put together from the ids of their words.

Cut at the right places, a text's ids are the ids of its stretches one after
the other, and most stretches (words) come again and again.  So every worker
keeps the ids of words it has met, and the library encodes only words it
hasn't.  What is the right place follows from the tokenizer file:

* byte-level BPE with its own splitter (``byte_level``): before a single space
  between two characters that are no white space.  No token reaches from the
  left into white space, and what starts there starts with that space.
* BPE with word ends, lower case, white space dropped (``word_ends``): at any
  run of ASCII white space.  No match of its pattern holds white space, and
  neither normal form nor lower case look across it.
* sentencepiece BPE (``pieces``): at a single space between two characters that
  are neither white space nor U+2581, if no piece has U+2581 behind another
  character: then nothing is ever merged across it.  The model puts
  a space before each stretch itself.

What is left of a new word is often known: both JSON shapes split letters from the
punctuation behind them, and the second folds capitals, so these are told apart.

A tokenizer of another shape encodes each text whole; the answer is the same.
Memory is bounded: words kept are counted, long ones go first, and a very
long text is taken stretch by stretch.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np

from canopy.llm.token_count import byte_level_splice, load_json, sentence_pieces

BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)")
SPACES = re.compile(r"[\x20\x09-\x0D]+")
PLAIN_SPACE = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
#: Other characters Python or a splitter takes for white space, and U+2581.
BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "] + ["▁"]
SEPARATORS = [c for c in BLANKS if "\x1c" <= c <= "\x1f"]  # white space to Python alone
# Fixed value: the pattern a word-end tokenizer must have to be cut at white space.
WORD_ENDS_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Stands between words that are encoded in one call.
MARK = "\x01"
#: ASCII punctuation, and the end of the letters that every version of Unicode knows alike.
PUNCTUATION, LETTERS_END = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", "\u0250"


def single_spaces(text: str) -> bool:
    """Whether each space of ``text`` stands singly between characters that are no blanks."""
    if "  " in text or text[0] == " " or text[-1] == " ":
        return False
    return not any(c in text and (f" {c}" in text or f"{c} " in text) for c in BLANKS)


def cut_before_space(text: str) -> list[str]:
    """Stretches without the one space each begins with; the first, which may have none, is led by a space."""
    led = text[0] == " "
    rest = text[1:] if led else text  # nothing is cut before the first space
    words = rest.split(" ") if rest and single_spaces(rest) else [w[k > 0 :] for k, w in enumerate(BEFORE_SPACE.split(rest))]
    words[0] = "  " + words[0] if led else " " + words[0]
    return words


def cut_at_spaces(text: str) -> list[str]:
    if text.isascii() and "<" not in text:  # no special string: capitals are folded at once
        text = text.lower()
    return SPACES.split(text) if any(c in text for c in SEPARATORS) else text.split()


def cut_at_plain_space(text: str) -> list[str]:
    return text.split(" ") if single_spaces(text) else PLAIN_SPACE.split(text)


class Places(dict):
    """Word -> its place; a word asked for the first time gets the next one and is noted in ``new``."""

    def __init__(self):
        self.new: list[str] = []
        self.n = 0

    def __missing__(self, word: str) -> int:
        place = self[word] = self.n
        self.n += 1
        self.new.append(word)
        return place


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all stretches ``start .. start + size`` one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class WordIds:
    """Ids of texts by ``encode`` (lists of stretches to lists of ids).

    ``cut`` makes words of a text and ``place`` finds where one may end.  Every word met has
    a place in an array of ids; when there are more than ``kept`` words, the half used most
    stays.  ``between`` lets the library see many words as one text: the mark's single id says
    where they part.  ``lead`` is what a word has lost by the cut.  With ``tails``,
    letters and the punctuation behind them have ids of their own, with ``fold`` ASCII
    capitals have those of small letters.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[list[int]]],
        cut: Callable[[str], list[str]] | None = None,
        place: re.Pattern | None = None,
        *,
        between: str | None = None,
        lead: str = "",
        tails: bool = False,
        fold: bool = False,
        kept: int = 1 << 18,
        longest: int = 64,
        stretch: int = 1 << 18,
    ):
        self.encode, self.cut, self.place = encode, cut, place
        self.kept, self.longest, self.stretch = kept, longest, stretch
        self.between, self.lead, self.tails, self.fold = between, lead, tails, fold
        self.mark_id = None
        if between is not None:
            alone = encode([MARK])[0]
            self.mark_id = alone[0] if len(alone) == 1 else None
        self.tail_ids: dict[str, bytes] = {"": b""}
        self.places, self.words = Places(), []
        self.start, self.size, self.uses = (np.zeros(1 << 12, np.int64) for _ in range(3))
        self.ids, self.n_ids = np.zeros(1 << 14, "<u4"), 0

    def _joinable(self, word: str) -> bool:
        """Whether ``word`` between marks has the ids it has alone."""
        if MARK in word or len(word) > self.longest:
            return False
        return not self.lead or not (word[0] == " " or word[-1].isspace())

    def _whole(self, word: str) -> str:
        """The text a word stands for."""
        return word[1:] if self.lead and word[0] == " " else self.lead + word

    def _encoded(self, words: list[str]) -> dict[str, bytes]:
        found, single = {}, words
        if self.mark_id is not None:
            joined = [w for w in words if self._joinable(w)]
            single = [w for w in words if not self._joinable(w)]
            parts = [joined[k : k + 4096] for k in range(0, len(joined), 4096)]
            # a word, the mark, a word, the mark, ...; each mark is one id
            ids = self.encode([self.lead + self.between.join([*part, ""]) for part in parts]) if parts else []
            for part, row in zip(parts, ids, strict=True):
                row = np.array(row, "<u4")
                data, ends = row.tobytes(), np.flatnonzero(row == self.mark_id)
                starts = np.concatenate([[0], ends[:-1] + 1])
                cut = zip(part, (starts * 4).tolist(), (ends * 4).tolist(), strict=True)
                found.update((w, data[a:b]) for w, a, b in cut)
        if single:
            ids = self.encode([self._whole(w) for w in single])
            data = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
            ends = (np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) * 4).tolist()
            found.update((w, data[a:b]) for w, a, b in zip(single, [0, *ends[:-1]], ends, strict=True))
        return found

    def _parts(self, word: str) -> tuple[str, str] | None:
        """The word's letters and the punctuation behind them, if that is all of it and not what it is already."""
        core = word if word.isalpha() else word.rstrip(PUNCTUATION)
        if core is word and not self.fold or not core.isalpha() or len(core) > self.longest:
            return None
        if core.isascii():
            small = core.lower() if self.fold else core
            return (small, word[len(core) :]) if small != word else None
        if core is word or max(core) >= LETTERS_END or not core.lower().isalpha():
            return None
        return core, word[len(core) :]

    def _learn(self) -> None:
        """Give the new words their ids."""
        first, words, parts = len(self.words), self.places.new, {}
        if self.tails:
            parts = {w: p for w in words if (p := self._parts(w))}
            for core, _ in parts.values():
                self.places[core]  # new as well, if not known
            ends = [t for t in {tail for _, tail in parts.values()} if t not in self.tail_ids]
            for tail, ids in zip(ends, self.encode(ends) if ends else [], strict=True):
                self.tail_ids[tail] = np.array(ids, "<u4").tobytes()
        found = self._encoded([w for w in words if w and w not in parts])
        found[""] = b""
        for word, (core, tail) in parts.items():
            at = self.places[core]
            ids = found[core] if at >= first else self.ids[self.start[at] : self.start[at] + self.size[at]].tobytes()
            found[word] = ids + self.tail_ids[tail]
        data = [found[w] for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data)) // 4
        flat = np.frombuffer(b"".join(data), "<u4")
        n = first + len(words)
        if n > len(self.start):
            self.start, self.size, self.uses = (np.resize(x, 2 * n) for x in (self.start, self.size, self.uses))
            self.uses[first:] = 0
        if self.n_ids + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.n_ids + len(flat)))
        self.start[first:n] = self.n_ids + np.cumsum(sizes) - sizes
        self.size[first:n] = sizes
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        self.n_ids += len(flat)
        self.words += words
        self.places.new = []

    def _forget(self) -> None:
        """Keep the half of ``kept`` words used most; long words go."""
        n = len(self.words)
        short = np.fromiter(map(len, self.words), np.int64, n) <= self.longest
        most = min(self.kept // 2, int(short.sum()))
        by_use = np.argpartition(np.where(short, -self.uses[:n], 1), most - 1)[:most] if most else np.zeros(0, np.int64)
        words, start, size, uses = self.words, self.start[by_use], self.size[by_use], self.uses[by_use] // 2
        ids = self.ids[ragged(start, size)]
        self.words = [words[k] for k in by_use.tolist()]
        self.places = Places()
        self.places.update(zip(self.words, range(most), strict=True))
        self.places.n = most
        m = max(most, 1)
        self.start, self.size, self.uses = (np.zeros(2 * m, np.int64) for _ in range(3))
        self.start[: len(size)], self.size[: len(size)], self.uses[: len(size)] = np.cumsum(size) - size, size, uses
        self.ids, self.n_ids = np.resize(ids, 2 * len(ids) + 1), len(ids)

    def _many(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) > self.kept or self.n_ids > 8 * self.kept:
            self._forget()
        found, place_of = [], self.places.__getitem__
        for text in texts:
            words = self.cut(text) if text else []
            found.append(np.fromiter(map(place_of, words), np.int64, len(words)))
        if self.places.new:
            self._learn()
        places, counts = np.concatenate(found), [len(f) for f in found]
        self.uses[: len(self.words)] += np.bincount(places, minlength=len(self.words))
        sizes = self.size[places]
        ids = self.ids[ragged(self.start[places], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        return np.split(ids, ends[:-1])

    def _stretches(self, text: str):
        at = 0
        while len(text) - at > self.stretch:
            m = self.place.search(text, at + self.stretch)
            if m is None:
                break
            yield text[at : m.start()]
            at = m.end()
        yield text[at:]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as 32-bit numbers."""
        if self.cut is None:
            return [np.array(i, np.uint32) for i in self.encode(texts)] if texts else []
        short = [k for k, t in enumerate(texts) if len(t) <= self.stretch]
        out: list = [None] * len(texts)
        if short:
            for k, ids in zip(short, self._many([texts[k] for k in short]), strict=True):
                out[k] = ids
        for k, text in enumerate(texts):
            if out[k] is None:
                out[k] = np.concatenate([self._many([s])[0] for s in self._stretches(text)])
        return out


@lru_cache(maxsize=4)
def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _word_ends(path: str) -> bool:
    """Whether the file is a BPE with word ends whose matches never hold white space."""
    spec = _spec(path)
    normal = spec.get("normalizer") or {}
    steps = [s.get("type") for s in normal.get("normalizers", [])]
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    loose = any(t.get(k) for t in spec.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    return (
        set(steps) <= {"NFC", "Replace", "Lowercase"}
        and all(s.get("pattern") == {"Regex": "\\s+"} and s.get("content") == " " for s in normal.get("normalizers", []) if s["type"] == "Replace")
        and split[0].get("pattern") == {"Regex": WORD_ENDS_PATTERN}
        and split[0].get("behavior") == "Removed"
        and bool(split[0].get("invert"))
        and not any(p.get("add_prefix_space") for p in split)
        and not loose
        and all("<" in t["content"] for t in spec.get("added_tokens") or [])
        and not spec.get("truncation")
        and not spec.get("post_processor")
        and spec["model"].get("type") == "BPE"
        and not spec["model"].get("dropout")
    )


@lru_cache(maxsize=4)
def json_ids(path: str, plain_specials: bool = False, kept: int = 1 << 18) -> WordIds:
    """Of a ``.json`` file, without added special tokens; ``plain_specials``: their strings are plain text."""
    if plain_specials:  # one of its own, and no other is loaded
        tokenizer = load_json.__wrapped__(path)
        tokenizer.encode_special_tokens = True
    else:
        tokenizer = load_json(path)

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    if byte_level_splice(path):
        return WordIds(encode, cut_before_space, BEFORE_SPACE, between=f"{MARK} ", lead=" ", tails=True, kept=kept)
    if _word_ends(path):
        return WordIds(encode, cut_at_spaces, SPACES, between=f" {MARK} ", tails=True, fold=True, kept=kept)
    return WordIds(encode)


@lru_cache(maxsize=4)
def piece_ids(path: str, kept: int = 1 << 17) -> WordIds:
    """Of a sentencepiece ``.model`` file."""
    model = sentence_pieces(path)
    names = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    apart = not any("▁" in p.lstrip("▁") for p in names)
    space = model.encode("x", out_type=str)[0].startswith("▁")
    how = (cut_at_plain_space, PLAIN_SPACE) if apart and space else ()
    return WordIds(lambda texts: model.encode(texts, num_threads=1), *how, kept=kept)
