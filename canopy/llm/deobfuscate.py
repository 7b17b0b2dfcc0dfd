"""Personal data, also where it is disguised, at its place in the source text.

Three transducers rewrite a text, each over the output of the one before:
look-alike characters become the ASCII ones, runs of spelled digits become
digits, and at/dot disguises become ``@`` and ``.``.  A transducer is a list of
edits (source range -> replacement); what lies between edits is copied, and
positions of the output are mapped back through the edits, so every span found
in the normalised text is a range of source characters.

Plain detectors run on the source (the *base* spans) and, where any edit was
made, on the normalised text.  A normalised span is added when it contains an
edit and overlaps no base span of its kind.  Base spans always stay.

All detectors take time linear in the text: they start from ``@``, ``+`` or the
first digit of a run and never retry inside a run.

Defined results: a null text counts as empty (no spans); an empty table gives
an empty table; repeated rows give one result row each; null ids stay null;
other columns of the input are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import arrow_map

#: The order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"

Span = tuple[str, int, int]

# ---------------------------------------------------------------- detectors

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
AT = re.compile("@")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterable[tuple[int, int]]:
    end = 0
    for m in AT.finditer(text):
        at = start = m.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end


def ips(text: str) -> Iterable[tuple[int, int]]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def cards(text: str) -> Iterable[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
            yield m.span()


def phones(text: str) -> Iterable[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 10 <= len(only_digits(m[0])) <= 15:
            yield m.span()


def detect(text: str) -> list[Span]:
    found = [(k, s, e) for k, f in zip(KINDS, (emails, ips, cards, phones), strict=True) for s, e in f(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


# -------------------------------------------------------------- transducers

# Cyrillic and Greek letters that look like Latin ones, and other signs for @ . - +
LOOK_ALIKE = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухԁԛԝ", "ABESIJKMHOPCTYXaesijopcyxdqw", strict=True))
LOOK_ALIKE |= dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοιν", "ABEZHIKMNOPTYXoiv", strict=True))
LOOK_ALIKE |= {"﹫": "@", "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹢": "+"}
INVISIBLE = "­​‌‍⁠﻿"
#: Ranges that hold look-alikes, other decimal digits (none lie below U+0660), invisible and full-width signs.
STRANGE = re.compile(r"[­Ͱ-᱙​-−。꘠-꯹﹢-～\U000104a0-\U0001fbf9]")


def plain_character(c: str) -> str:
    if c in INVISIBLE:
        return ""
    if "！" <= c <= "～":  # full-width forms lie at a fixed distance
        return chr(ord(c) - 0xFEE0)
    digit = unicodedata.decimal(c, None)
    return LOOK_ALIKE.get(c, c) if digit is None else str(digit)


class Rewrite:
    """A text and the map of its positions to those of the source."""

    def __init__(self, text: str):
        self.text = text
        #: (start here, end here, source start, source end) of each edit, in order
        self.edits: list[tuple[int, int, int, int]] = []

    def source(self, at: int, end: bool) -> int:
        """The source position of a boundary; inside an edit, that edit's own start or end."""
        k = bisect_right(self.edits, at, key=lambda e: e[0]) - 1
        if end and k >= 0 and self.edits[k][0] == at and self.edits[k][1] > at:
            k -= 1  # a span that ends where an edit starts doesn't hold it
        if k < 0:
            return at
        here, stop, source, source_stop = self.edits[k]
        if at >= stop:
            if not end and at == stop == here:
                return source_stop
            return source_stop + at - stop
        return source_stop if end and at > here else source

    def holds_edit(self, start: int, end: int) -> bool:
        k = bisect_right(self.edits, start, key=lambda e: e[1])
        return k < len(self.edits) and self.edits[k][0] < end

    def apply(self, found: list[tuple[int, int, str]]) -> Rewrite:
        """The text after the edits (start, end, replacement), still mapped to the source."""
        if not found:
            return self
        pieces, out, at, marks = [], Rewrite(""), 0, []
        length = 0
        for start, end, new in found:
            pieces += [self.text[at:start], new]
            length += start - at
            marks.append((length, length + len(new), start, end))
            length += len(new)
            at = end
        pieces.append(self.text[at:])
        out.text = "".join(pieces)
        # earlier edits that no new one swallowed move along; a new one covers the source of those in it
        moved, shift, old = [], 0, iter([*self.edits, None])
        edit = next(old)
        for here, stop, start, end in marks:
            while edit and edit[1] <= start:
                moved.append((edit[0] + shift, edit[1] + shift, edit[2], edit[3]))
                edit = next(old)
            source, source_stop = self.source(start, False), self.source(end, True)
            while edit and edit[0] < end:
                source, source_stop = min(source, edit[2]), max(source_stop, edit[3])
                edit = next(old)
            moved.append((here, stop, source, source_stop))
            shift = stop - end
        while edit:
            moved.append((edit[0] + shift, edit[1] + shift, edit[2], edit[3]))
            edit = next(old)
        out.edits = moved
        return out


def look_alikes(text: str) -> list[tuple[int, int, str]]:
    if text.isascii():
        return []
    found = [(m.start(), m.end(), plain_character(m[0])) for m in STRANGE.finditer(text)]
    return [(s, e, new) for s, e, new in found if new != text[s:e]]


# English digit names.
DIGIT_NAMES = dict(zip("zero one two three four five six seven eight nine oh".split(), "01234567890", strict=True))
NAME = rf"(?:{'|'.join(DIGIT_NAMES)})"
#: At least three names or single digits one after the other, a name among them.
SPELLED = re.compile(rf"(?<![A-Za-z0-9])(?:plus[ -]{{1,2}})?(?:{NAME}|[0-9])(?:[ ,-]{{1,2}}(?:{NAME}|[0-9]))+(?![A-Za-z0-9])", re.I)
UNIT = re.compile(rf"plus|{NAME}|[0-9]", re.I)
#: One digit name between dots or beside digits and a dot disguise, as in "ten dot"-less addresses.
DOTTED = re.compile(rf"(?<![A-Za-z0-9])(?:{NAME}|[0-9])(?=[ ]+(?:dot|point)[ ]+)|(?<=dot[ ])(?:{NAME})(?![A-Za-z0-9])", re.I)
HAS_NAME = re.compile(NAME, re.I)
RARE_NAME = re.compile("zero|one|two|three|four|five|six|seven|eight|nine", re.I)


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    found = []
    if not RARE_NAME.search(text):
        return found
    for m in SPELLED.finditer(text):
        units = UNIT.findall(m[0])
        names = [u for u in units if u.lower() in DIGIT_NAMES]
        if names and len(units) >= 3:
            digits = "".join("+" if u.lower() == "plus" else DIGIT_NAMES.get(u.lower(), u) for u in units)
            found.append((*m.span(), digits))
    taken = iter([*found, (len(text) + 1,) * 2])
    now, single = next(taken), []
    for m in DOTTED.finditer(text):
        while now[1] <= m.start():
            now = next(taken)
        if m.end() <= now[0] and m[0].lower() in DIGIT_NAMES:
            single.append((*m.span(), DIGIT_NAMES[m[0].lower()]))
    return sorted(found + single)


#: Bracketed forms, and bare words where a name, "at", a name, "dot" and a name follow each other.
DISGUISE = re.compile(
    r"[ ]{0,2}[\[({<][ ]?(?P<at>at|@)[ ]?[\])}>][ ]{0,2}"
    r"|[ ]{0,2}[\[({<][ ]?(?P<dot>dot|\.)[ ]?[\])}>][ ]{0,2}"
    r"|(?<=[A-Za-z0-9])[ ]{1,2}(?P<bare_at>at)[ ]{1,2}(?=[A-Za-z0-9-]{1,63}(?:[ ]{1,2}dot[ ]{1,2}|[ ]?[\[({<][ ]?dot)[A-Za-z0-9\])}> ])"
    r"|(?<=[A-Za-z0-9])[ ]{1,2}(?P<bare_dot>dot)[ ]{1,2}(?=[A-Za-z0-9])",
    re.I,
)
#: Looked for first, as most texts have none.
DISGUISE_HINT = re.compile(r"[ \[({<](?:dot|at|@|\.)[ \])}>]", re.I)


def disguises(text: str) -> list[tuple[int, int, str]]:
    if not DISGUISE_HINT.search(text):
        return []
    return [(*m.span(), "@" if m["at"] or m["bare_at"] else ".") for m in DISGUISE.finditer(text)]


TRANSDUCERS: tuple[Callable[[str], list[tuple[int, int, str]]], ...] = (look_alikes, spelled_digits, disguises)


def normalised(text: str) -> Rewrite:
    out = Rewrite(text)
    for find_edits in TRANSDUCERS:
        out = out.apply(find_edits(out.text))
    return out


def all_spans(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) of every span, by start, kind as listed, end."""
    base = detect(text)
    spans = [(*s, True) for s in base]
    rewrite = normalised(text)
    if rewrite.edits:
        own = {k: [(s, e) for kind, s, e in base if kind == k] for k in KINDS}
        for kind, start, end in detect(rewrite.text):
            if rewrite.holds_edit(start, end):
                s, e = rewrite.source(start, False), rewrite.source(end, True)
                k = bisect_right(own[kind], s, key=lambda x: x[1])
                if s < e and not (k < len(own[kind]) and own[kind][k][0] <= s and e <= own[kind][k][1]):
                    spans.append((kind, s, e, False))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


# ---------------------------------------------------------------- operators


def find(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: every span of each whole text, in code points, end exclusive."""

    def rows(given):
        spans = [all_spans(t) if t else [] for t in given[text_col]]
        keys = ("kind", "start", "end", "base")
        yield {"doc_id": given[id_col], "spans": [[dict(zip(keys, s, strict=True)) for s in x] for x in spans]}

    return arrow_map(df, [id_col, text_col], rows, f"doc_id long, spans {SPANS}")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def replaced(text: str) -> str:
    """The text with every span (overlapping ones as one) replaced by its kind in angle brackets."""
    out, at = [], 0
    stop, kind = -1, ""
    for k, start, end, _ in all_spans(text):
        if start < stop:
            stop = max(stop, end)
            continue
        if stop >= 0:
            out.append(f"<{kind.upper()}>")
            at = stop
        out.append(text[at:start])
        stop, kind = end, k
    if stop >= 0:
        out.append(f"<{kind.upper()}>")
        at = stop
    return "".join([*out, text[at:]])


def redact(df: DataFrame, *, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``df`` with spans in the text replaced; ``length_col``, where there, follows the text."""
    names = df.columns

    def rows(given):
        out = dict(given)
        out[text_col] = [t and replaced(t) for t in given[text_col]]
        if length_col in out:
            out[length_col] = [n if t is None else len(t) for t, n in zip(out[text_col], given[length_col], strict=True)]
        yield out

    return arrow_map(df, names, rows, df.schema.simpleString()[len("struct<") : -1])
