"""Which tokens of two tokenizers lie over each other, by merge-path partitioning.

Both tokenizers cut the same bytes, so each gives ascending byte offsets at which
its tokens end.  Merging the two lists says everything: a token pair overlaps for
each distinct end, and where both end the text falls into *groups*.  The merge of
all documents of a slice (laid end to end: a document's end is an end of both) is
cut by diagonals: for every ``piece`` steps a binary search finds how many ends of
either list come before, all searches at once.  The pieces are independent and of
equal work whatever the documents are, so they are merged side by side, one numpy
lane each; pieces emit overlaps, and groups that run over a piece's edge are
stitched by the sums of groups that the pieces before have closed.

A pair's count covers the whole corpus.  Each slice is stored with its distinct pairs and
how often they occur; counts are one aggregation of these with a map-side combine,
the highest count of a B id is a window over distinct pairs, and the answer goes back
to the slices by one join on the pair: one row for a pair of a slice, so a pair that
occurs everywhere costs a row a slice, not a row an occurrence.

Tokenizers: A is a byte-level BPE ``.json`` file, its special strings plain text; B is
a sentencepiece ``.model`` that puts a space before the text, which A is given, too.
Where the bytes of A's or B's tokens joined aren't that space and the text, the
document has no tokens, as have null and empty texts: zeros and an empty digest.

Defined results: null ids stay null; rows of one id are documents of their own; an
empty table gives an empty table; other columns are ignored.  Texts are encoded word by
word; a task holds the merge of one slice, which is about ``slice_chars`` characters or
one document, in batches of ``batch`` steps.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from canopy.llm.common import stored
from canopy.llm.token_count import sentence_pieces
from canopy.llm.word_ids import json_ids, piece_ids, ragged

DOC = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
SLICE = (
    "slice long, "
    + ", ".join(f"{c} array<long>" for c in DOC)
    + ", groups_sha256 array<string>, pair array<long>, times array<long>, links binary, n_pairs int"
)
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
#: Slices a task can make before numbers of two tasks could meet.
TASK_SLICES = 1 << 32
B_BITS = 32  # a pair is A's id and, in the lower bits, B's
#: Characters of a slice that are cut into words at a time: a word takes far more memory than its ids.
PART_CHARS = 1 << 18
#: Words a worker keeps with their ids, of A and of B; more would cost memory, fewer CPU time.
KEPT_A, KEPT_B = 1 << 17, 1 << 16


@lru_cache(maxsize=2)
def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE file.

    Bytes that are visible Latin-1 characters stand for themselves, the others, in
    order, for the characters from 256 on.
    """
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(visible)]
    byte_of = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    found = {i: bytes(byte_of[c] for c in token) for token, i in spec["model"]["vocab"].items()}
    for t in spec.get("added_tokens") or []:
        found.setdefault(t["id"], t["content"].encode())
    return [found.get(i, b"") for i in range(max(found) + 1)]


@lru_cache(maxsize=2)
def piece_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a sentencepiece model: U+2581 is a space, ``<0xHH>`` a byte."""
    model = sentence_pieces(path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [
        bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)
    ]


def diagonal(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first ``at`` of the merge of ``a`` and ``b`` (equal ones: a's first)."""
    low, high = np.maximum(at - len(b), 0), np.minimum(at, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        k = np.minimum(middle, len(a) - 1)
        before = open_ & (a[k] <= b[np.clip(at - 1 - middle, 0, len(b) - 1)])
        low = np.where(before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)


class Merge:
    """The merge of ascending ends ``a`` and ``b`` (both with the same last end).

    ``link_a, link_b``: indexes of the tokens of every overlap, in order;
    ``group_a, group_b``: the group of each token.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, piece: int = 128, batch: int = 1 << 18):
        total = len(a) + len(b)
        far = np.int64(np.iinfo(np.int64).max)
        more_a, more_b = np.append(a, far), np.append(b, far)
        self.group_a, self.group_b = np.empty(len(a), np.int32), np.empty(len(b), np.int32)
        links_a, links_b, closed = [], [], 0
        for first in range(0, total, batch):
            starts = np.arange(first, min(first + batch, total), piece)
            i = diagonal(a, b, starts)
            j = starts - i
            lanes = len(starts)
            at_a, at_b = np.empty((lanes, piece), np.int32), np.empty((lanes, piece), np.int32)
            takes, closes = np.empty((lanes, piece), bool), np.empty((lanes, piece), bool)
            for step in range(piece):
                end_a, end_b = more_a[i], more_b[j]
                take = end_a <= end_b
                at_a[:, step], at_b[:, step], takes[:, step] = i, j, take
                # b's end, after an equal one of a's, emits no overlap but closes a group
                closes[:, step] = ~take & (i > 0) & (more_a[i - 1] == end_b)
                i = i + take
                j = j + ~take
                if step + 1 < piece:  # the last piece may be short
                    i, j = np.minimum(i, len(a)), np.minimum(j, len(b))
            n = min(batch, total - first)
            # stitch: groups closed by the pieces before, then within the piece
            own = closes.cumsum(axis=1) if lanes > 1 else closes[:, :n].cumsum(axis=1)
            if lanes > 1:
                short = n - (lanes - 1) * piece
                own[-1, short:] = own[-1, short - 1]
            sums = own[:, -1]
            group = (own + (closed + np.cumsum(sums) - sums)[:, None]).ravel()[:n] - closes.ravel()[:n]
            closed += int(sums.sum())
            take, i, j = takes.ravel()[:n], at_a.ravel()[:n], at_b.ravel()[:n]
            self.group_a[i[take]] = group[take]
            self.group_b[j[~take]] = group[~take]
            linked = ~closes.ravel()[:n]
            links_a.append(i[linked])
            links_b.append(j[linked])
        none = [np.empty(0, np.int32)]
        self.link_a, self.link_b = np.concatenate(links_a or none), np.concatenate(links_b or none)
        self.n_groups = closed


@lru_cache(maxsize=4)
def decimals(n: int) -> np.ndarray:
    """Decimal texts of 0..n-1 followed by each of ``,`` ``|`` ``;`` (blocks of n)."""
    return np.array([f"{i}{mark}" for mark in ",|;" for i in range(n)], object)


def group_text(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, size: int) -> Iterator[str]:
    """``a1,a2|b1;a3|b2,b3`` of one document, in parts."""
    n = len(ids_a) + len(ids_b)
    first = int(group_a[0])
    groups = int(group_a[-1]) - first + 1
    # a group's A ids come first: behind all ids of earlier groups
    upto_a = np.cumsum(np.bincount(group_a - first, minlength=groups))
    before_b = np.cumsum(np.bincount(group_b - first, minlength=groups))
    text = np.empty(n, np.int64)
    at_a = np.arange(len(ids_a)) + np.concatenate([[0], before_b])[group_a - first]
    at_b = np.arange(len(ids_b)) + upto_a[group_b - first]
    text[at_a] = ids_a + size * np.append(group_a[1:] != group_a[:-1], True)
    text[at_b] = ids_b + 2 * size * np.append(group_b[1:] != group_b[:-1], True)
    names = decimals(size)
    for k in range(0, n, 1 << 18):
        part = "".join(names[text[k : k + (1 << 18)]].tolist())
        yield part if k + (1 << 18) < n else part[:-1]


def place_type(n: int) -> str:
    return "<u2" if n <= 1 << 16 else "<u4"


@lru_cache(maxsize=2)
def token_bytes(path: str, tokens_of: Callable[[str], list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes one after the other, and where each token starts and how long it is."""
    tokens = tokens_of(path)
    long = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(long) - long, long


def same_bytes(texts: list[str], ids: list[np.ndarray], path: str, tokens_of: Callable[[str], list[bytes]]) -> list[bool]:
    """Whether the bytes of each text's tokens joined are the text's, for many short texts at a time."""
    data, starts, long = token_bytes(path, tokens_of)
    found = []
    for first, last in spans([len(i) for i in ids], 1 << 16):
        some = np.concatenate(ids[first:last]).astype(np.int64)
        joined = data[ragged(starts[some], long[some])].tobytes()
        ends = np.concatenate([[0], np.cumsum(long[some])])
        stops = ends[np.cumsum([len(i) for i in ids[first:last]])].tolist()
        for text, a, b in zip(texts[first:last], [0, *stops], stops, strict=False):
            found.append(joined[a:b] == text.encode())
    return found


def spans(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive stretches of about ``most`` in sum, or of one."""
    first, total = 0, 0
    for k, size in enumerate(sizes):
        if k > first and total + size > most:
            yield first, k
            first, total = k, 0
        total += size
    if sizes:
        yield first, len(sizes)


def distinct_places(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in ascending order, the place of each pair among them, and how often each occurs; by hash, not by sorting all."""
    coded = pa.array(pairs).dictionary_encode()
    met, at = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    order = np.argsort(met)
    place = np.empty(len(met), np.int64)
    place[order] = np.arange(len(met))
    return met[order], place[at], np.bincount(at, minlength=len(met))[order]


def slice_of(number: int, docs: list, texts: list[str | None], a_path: str, b_path: str, piece: int) -> dict[str, list]:
    """One stored row: the documents of a slice, its distinct pairs and every link as a pair's place."""
    tokens_a, tokens_b = byte_level_tokens(a_path), piece_tokens(b_path)
    long_a, long_b = (np.array([len(t) for t in tokens]) for tokens in (tokens_a, tokens_b))
    all_a, all_b, kept = [], [], []
    for first, last in spans([len(t or "") for t in texts], PART_CHARS):
        spaced = [" " + t if t else "" for t in texts[first:last]]
        ids_a, ids_b = json_ids(a_path, True, KEPT_A)(spaced), piece_ids(b_path, KEPT_B)([t or "" for t in texts[first:last]])
        same_a, same_b = same_bytes(spaced, ids_a, a_path, byte_level_tokens), same_bytes(spaced, ids_b, b_path, piece_tokens)
        kept += [first + k for k, text in enumerate(spaced) if text and same_a[k] and same_b[k]]
        all_a += ids_a
        all_b += ids_b
    out = {c: np.zeros(len(docs), np.int64) for c in DOC[1:]}
    digests = [""] * len(docs)
    if kept:
        ids_a, ids_b = np.concatenate([all_a[k] for k in kept]), np.concatenate([all_b[k] for k in kept])
        ends_a, ends_b = np.cumsum(long_a[ids_a]), np.cumsum(long_b[ids_b])
        merge = Merge(ends_a, ends_b, piece)
        n_a, n_b = np.array([len(all_a[k]) for k in kept]), np.array([len(all_b[k]) for k in kept])
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        stop_links = np.searchsorted(merge.link_a, stop_a)
        size = max(len(tokens_a), len(tokens_b))
        for place, k in enumerate(kept):
            a, b = slice(stop_a[place] - n_a[place], stop_a[place]), slice(stop_b[place] - n_b[place], stop_b[place])
            digest = hashlib.sha256()
            for part in group_text(ids_a[a].astype(np.int64), ids_b[b].astype(np.int64), merge.group_a[a], merge.group_b[b], size):
                digest.update(part.encode())
            digests[k] = digest.hexdigest()
            out["n_groups"][k] = merge.group_a[a][-1] - merge.group_a[a][0] + 1
        out["n_a"][kept], out["n_b"][kept] = n_a, n_b
        out["n_links"][kept] = np.diff(stop_links, prepend=0)
        pairs = (ids_a[merge.link_a].astype(np.int64) << B_BITS) | ids_b[merge.link_b]
        distinct, links, times = distinct_places(pairs)
    else:
        distinct = times = np.empty(0, np.int64)
        links = np.empty(0, np.int64)
    return {
        "slice": [number],
        "doc_id": [docs],
        **{c: [v] for c, v in out.items()},
        "groups_sha256": [digests],
        "pair": [distinct],
        "times": [times],
        "links": [pa.compress(links.astype(place_type(len(distinct))).tobytes(), "zstd", asbytes=True)],
        "n_pairs": [len(distinct)],
    }


def arrow_types(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def align_slices(
    df: DataFrame,
    a_path: str,
    b_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    slice_chars: int = 2_000_000,
    piece: int = 128,
) -> DataFrame:
    """The alignment by slices of documents (``SLICE``): counts and digests of each document, pairs, links."""

    parsed = StructType.fromDDL(SLICE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() * TASK_SLICES
        docs, texts, chars = [], [], 0
        schema = arrow_types(parsed)

        def done():
            row = slice_of(number, docs, texts, a_path, b_path, piece)
            return pa.RecordBatch.from_arrays([pa.array(row[f.name], f.type) for f in schema], schema=schema)

        for batch in batches:
            for at in range(batch.num_rows):
                text = batch.column(1)[at].as_py()
                if docs and chars + len(text or "") > slice_chars:
                    yield done()
                    number += 1
                    docs, texts, chars = [], [], 0
                docs.append(batch.column(0)[at].as_py())
                texts.append(text)
                chars += len(text or "") + 1
        if docs:
            yield done()

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SLICE)


def pair_counts(slices: DataFrame) -> DataFrame:
    """``pair, count, best`` of the corpus; ``best``: no pair of the same B id is counted more often."""
    each = slices.select(F.explode(F.arrays_zip("pair", "times")).alias("p")).select("p.pair", "p.times")
    counts = each.groupBy("pair").agg(F.sum("times").alias("count"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND((1 << B_BITS) - 1))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_b))


def align(df: DataFrame, a_path: str, b_path: str, **how) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    slices = stored(align_slices(df, a_path, b_path, **how), "token-alignment")
    asked = slices.select("slice", F.posexplode("pair").alias("place", "pair"))
    answered = asked.join(pair_counts(slices), "pair")
    answer = answered.groupBy("slice").agg(F.collect_list(F.struct("place", "count", "best")).alias("answer"))
    # a slice without links asked for nothing
    told = slices.drop("pair", "times").join(answer, "slice", "left")
    parsed = StructType.fromDDL(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_types(parsed)
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(k)[at] for k, n in enumerate(batch.schema.names)}
                n_links = np.array(row["n_links"].values.to_numpy())
                kind = np.dtype(place_type(row["n_pairs"].as_py()))
                n = int(n_links.sum()) * kind.itemsize
                links = np.frombuffer(pa.decompress(row["links"].as_py(), n, "zstd", asbytes=True) if n else b"", kind)
                count, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if len(links):
                    told = row["answer"].values
                    place = told.field("place").to_numpy()
                    count, best = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
                    count[place] = told.field("count").to_numpy()
                    best[place] = told.field("best").to_numpy(zero_copy_only=False)
                stop = np.cumsum(n_links)

                def by_doc(values):
                    upto = np.concatenate([[0], np.cumsum(values[links])])
                    return upto[stop] - upto[stop - n_links]

                columns = {n: row[n].values for n in (*DOC, "groups_sha256")}
                columns |= {"n_best": pa.array(by_doc(best)), "count_sum": pa.array(by_doc(count))}
                yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)

    return told.mapInArrow(run, RESULT)
