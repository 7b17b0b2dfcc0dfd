"""Repeated passages by relative Lempel-Ziv parsing of all documents.

Every document is parsed against all earlier text.  The text is indexed in
*reference blocks* whose limits depend on the words alone: of the five-word
grams in a window of ``window`` words the one of least hash is the window's
anchor, and a block is the stretch of windows that share an anchor.  Equal
windows have equal anchors, so a window can occur elsewhere only in blocks of
the same anchor, which meet in one place of the index.

* A block that occurs earlier as a whole is a match.  Going through a
  document, matches that continue each other in the same earlier document are
  one *factor* (start, words, reference document and start).  A factor has at
  least ``window`` words, as a block does.
* At factor boundaries, where blocks of one anchor differ, the windows are
  checked one by one: only these, and only those of the first occurrence of
  each different block, are looked up by their own digest.

The earliest occurrence of a window lies in the first occurrence of its block,
so the outcome is exact: a window is repeated if and only if a block or window
lookup finds it at an earlier place (digests have 128 bits; see ``digests``).

A passage that many documents share costs a slice of documents one index row:
within a slice every occurrence but the first is matched at once.  What is
left is shuffled once by anchor and read in order with constant memory.

Defined results: a null text has no words; texts shorter than a window lose
nothing; a document with a null id is neither searched nor found; rows that
repeat an id are the same document (an equal start is not an earlier one) and
must be equal; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm.common import arrow_map, stored
from canopy.llm.minhash import HASHES, scrambled

GRAM = 5
ROWS = "g long, e long, doc long, start int, windows int, ref_doc long, ref_start int"
ODD = np.uint64(0xD6E8FEB86659FD93)
ODD_INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8, unchanged: bytes split at space and 0x09 to 0x0D."""
    return text.encode().split() if text else []


class Powers:
    """Powers of the hash base and of its inverse, grown as longer texts come."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 2 * n
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, ODD)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, ODD_INVERSE)]), dtype=np.uint64)
        return self.up[:n], self.down[:n]


POWERS = Powers()


class Hashed:
    """Word hashes of one text and digests of its stretches."""

    def __init__(self, words: list[bytes]):
        h = np.array([HASHES[w] for w in words], np.uint64)
        self.n = len(h)
        up, self.down = POWERS.get(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(h * up[: self.n], out=self.sums[1:])

    def digests(self, start: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        """A 64-bit digest of the words of each stretch, the same wherever it stands."""
        value = (self.sums[start + length] - self.sums[start]) * self.down[start]
        return scrambled(value + np.asarray(length).astype(np.uint64))


def blocks_of(words: list[bytes], window: int) -> tuple[np.ndarray, ...] | None:
    """(anchor digest, block digest, first window, number of windows) of every block."""
    n_windows = len(words) - window + 1
    if n_windows < 1:
        return None
    text = Hashed(words)
    grams = text.digests(np.arange(len(words) - GRAM + 1), GRAM)
    span = window - GRAM + 1
    at = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1) + np.arange(n_windows)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.concatenate([first, [n_windows]]))
    anchor = at[first]
    whole = text.digests(first, count + window - 1)
    return grams[anchor], scrambled(whole ^ (anchor - first).astype(np.uint64)), first, count


def joined_matches(doc, start, windows, ref_doc, ref_start) -> np.ndarray:
    """Where a new factor starts, of matches in order of document and start."""
    follows = (
        (doc[1:] == doc[:-1])
        & (start[1:] == start[:-1] + windows[:-1])
        & (ref_doc[1:] == ref_doc[:-1])
        & (ref_start[1:] - start[1:] == ref_start[:-1] - start[:-1])
    )
    return np.flatnonzero(np.concatenate([[True], ~follows]))


def index_rows(df: DataFrame, id_col: str, text_col: str, window: int, slice_rows: int) -> DataFrame:
    """Of each slice of documents the first occurrence of every block, and as factors the matches inside the slice."""

    def rows(given):
        found = []
        for doc, text in zip(given[id_col], given[text_col], strict=True):
            if doc is not None and (blocks := blocks_of(words_of(text), window)):
                found.append((*blocks, np.full(len(blocks[0]), doc, np.int64)))
        if not found:
            return
        g, e, start, windows, doc = map(np.concatenate, zip(*found, strict=True))
        order = np.lexsort((start, doc, e, g))
        g, e, start, windows, doc = g[order], e[order], start[order], windows[order], doc[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (e[1:] != e[:-1])])
        ref = np.flatnonzero(new)[np.cumsum(new) - 1]
        none = np.zeros(new.sum(), np.int64)
        missing = np.ones(len(none), bool)
        yield columns(g[new], e[new], doc[new], start[new], windows[new], (none, missing), (none, missing))
        later = ~new & ((doc != doc[ref]) | (start != start[ref]))
        d, s, w, rd, rs = doc[later], start[later], windows[later], doc[ref][later], start[ref][later]
        if len(d):
            order = np.lexsort((s, d))
            d, s, w, rd, rs = d[order], s[order], w[order], rd[order], rs[order]
            heads = joined_matches(d, s, w, rd, rs)
            w = np.add.reduceat(w, heads)
            d, s, rd, rs = d[heads], s[heads], rd[heads], rs[heads]
            spread = scrambled(d.view(np.uint64))
            yield columns(spread, spread, d, s, w, (rd, None), (rs, None))

    def columns(g, e, doc, start, windows, ref_doc, ref_start):
        return {
            "g": g.view(np.int64),
            "e": e.view(np.int64),
            "doc": doc,
            "start": start.astype(np.int32),
            "windows": windows.astype(np.int32),
            "ref_doc": pa.array(ref_doc[0], pa.int64(), mask=ref_doc[1]),
            "ref_start": pa.array(ref_start[0].astype(np.int32), pa.int32(), mask=ref_start[1]),
        }

    return arrow_map(df, [id_col, text_col], rows, ROWS, slice_rows=slice_rows)


def look_up(rows: DataFrame) -> DataFrame:
    """Matches (``ref_doc`` not null) and blocks to be checked window by window (``ref_doc`` null).

    All rows of an anchor meet in order of block and place.  The first row of
    a block is its reference, later ones are matches; if an anchor has several
    blocks, the first of each is to be checked.  Rows matched before pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last row and the reference, first block and state of its anchor
        for batch in batches:
            passing = batch.column(5).is_valid()
            yield batch.filter(passing)
            part = batch.filter(pa.compute.invert(passing))
            if not part.num_rows:
                continue
            g, e, doc, start, windows = (part.column(k).to_numpy() for k in range(5))
            if last is not None:  # the open block and anchor of the batch before come first
                g, e, doc, start, windows = (np.concatenate([x, y]) for x, y in zip(last[0], (g, e, doc, start, windows), strict=True))
            n, held = len(g), 0 if last is None else len(last[0][0])
            at = np.arange(n)
            new_g = np.concatenate([[True], g[1:] != g[:-1]])
            new_e = new_g | np.concatenate([[True], e[1:] != e[:-1]])
            ref = np.maximum.accumulate(np.where(new_e, at, 0))
            head = np.maximum.accumulate(np.where(new_g, at, 0))
            match = ~new_e & ((doc != doc[ref]) | (start != start[ref])) & (at >= held)
            second = new_e & ~new_g
            checked = second & (at >= held)
            several = np.zeros(n, bool)
            several[head[second]] = True
            if last is not None and last[1]:
                several[0] = False  # was given out with an earlier batch
            checked |= several
            out = np.concatenate([at[match], at[checked]])
            missing = np.concatenate([np.zeros(match.sum(), bool), np.ones(checked.sum(), bool)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(g[out]),
                    pa.array(e[out]),
                    pa.array(doc[out]),
                    pa.array(start[out]),
                    pa.array(windows[out]),
                    pa.array(doc[ref[out]], mask=missing),
                    pa.array(start[ref[out]], mask=missing),
                ],
                schema=batch.schema,
            )
            keep = np.unique([head[-1], ref[-1]])  # first block of the open anchor, and the open block
            given = bool(second[head[-1] :].any() or (last is not None and last[1] and head[-1] == 0))
            last = tuple(x[keep] for x in (g, e, doc, start, windows)), given

    ordered = rows.repartition("g").sortWithinPartitions("g", "e", "doc", "start")
    return ordered.mapInArrow(run, ROWS)


def joined_ranges(blocks: list[dict]) -> list[tuple[int, int]]:
    """The blocks' windows as ranges (first, end), adjoining and repeated ones as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((x["start"], x["start"] + x["windows"]) for x in blocks):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def window_rows(df: DataFrame, checked: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Each window of the blocks to be checked as an index row of its own."""
    lists = checked.groupBy("doc").agg(F.collect_list(F.struct("start", "windows")).alias("blocks"))
    texts = df.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))

    def rows(given):
        out = {c: [] for c in ("g", "e", "doc", "start")}
        for doc, text, blocks in zip(given["doc"], given["text"], given["blocks"], strict=True):
            words = words_of(text)
            for a, b in joined_ranges(blocks):
                hashed = Hashed(words[a : b + window - 1])  # only the words of these windows are hashed
                at = np.arange(b - a)
                halves = hashed.digests(at, window // 2), hashed.digests(at + window // 2, window - window // 2)
                out["g"].append(hashed.digests(at, window).view(np.int64))
                out["e"].append(scrambled(halves[0] + scrambled(halves[1])).view(np.int64))
                out["doc"].append(np.full(len(at), doc, np.int64))
                out["start"].append((at + a).astype(np.int32))
        if out["g"]:
            full = {c: np.concatenate(x) for c, x in out.items()}
            n = len(full["g"])
            yield {**full, "windows": np.ones(n, np.int32), "ref_doc": pa.nulls(n, pa.int64()), "ref_start": pa.nulls(n, pa.int32())}

    return arrow_map(texts.join(lists, "doc"), ["doc", "text", "blocks"], rows, ROWS)


def parse(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 20, slice_rows: int = 1024) -> DataFrame:
    """``doc, factors``: of every document with a repeated window its matches, in order, as stored table."""
    found = stored(look_up(index_rows(df, id_col, text_col, window, slice_rows)), "lz-blocks")
    checked = found.where("ref_doc is null")
    single = look_up(window_rows(df, checked, id_col, text_col, window)).where("ref_doc is not null")
    matches = found.where("ref_doc is not null").union(single)
    factor = F.struct("start", "windows", "ref_doc", "ref_start")
    return matches.groupBy("doc").agg(F.collect_list(factor).alias("factors"))


def merged_factors(factors: list[dict], window: int) -> list[dict]:
    """Matches in order, those that continue each other in one reference as one: start, words, ref_doc, ref_start."""
    if not factors:
        return []
    names = ("start", "windows", "ref_doc", "ref_start")
    s, w, rd, rs = (np.array([f[k] for f in factors], np.int64) for k in names)
    order = np.argsort(s, kind="stable")
    s, w, rd, rs = s[order], w[order], rd[order], rs[order]
    heads = joined_matches(np.zeros(len(s), np.int64), s, w, rd, rs)
    total = np.add.reduceat(w, heads) + window - 1
    columns = zip(s[heads].tolist(), total.tolist(), rd[heads].tolist(), rs[heads].tolist(), strict=True)
    return [dict(zip(("start", "words", "ref_doc", "ref_start"), x, strict=True)) for x in columns]


def remove_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 20, text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, n_factors`` of every document;
    with ``text`` also ``kept`` (the words that stay, joined by a space) and ``factors``."""
    parsed = parse(df, id_col=id_col, text_col=text_col, window=window)
    texts = df.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(parsed, "doc", "left")

    def rows(given):
        out = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept_sha256", "n_factors", "kept", "factors")}
        for doc, whole, matches in zip(given["doc"], given["text"], given["factors"], strict=True):
            words = words_of(whole)
            factors = merged_factors(matches or [], window)
            kept, at = [], 0
            for f in factors:
                if f["start"] > at:
                    kept += words[at : f["start"]]
                at = max(at, f["start"] + f["words"])
            kept += words[at:]
            data = b" ".join(kept)
            out["doc_id"].append(doc)
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["kept_sha256"].append(hashlib.sha256(data).hexdigest())
            out["n_factors"].append(len(factors))
            if text:
                out["kept"].append(data.decode())
                out["factors"].append(factors)
        yield out

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_factors int"
    if text:
        schema += ", kept string, factors array<struct<start:long,words:long,ref_doc:long,ref_start:long>>"
    return arrow_map(texts, ["doc", "text", "factors"], rows, schema)
