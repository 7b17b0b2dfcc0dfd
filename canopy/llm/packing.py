"""Documents packed into sequences of a fixed length by sum-of-squares online packing.

Each task packs the documents of its input partition, so nothing is shuffled.
A document's ids are cut into full windows, which are sequences of their own, and
a rest.  The rest goes into the fill level that leaves the smallest sum of squares
of the counts of part-filled windows: a *level array* holds, for each fill, how
many open windows have it, and putting ``s`` ids onto a window of fill ``h``
changes the sum by ``2 (N[h+s] - N[h]) + 2`` (a new window by ``2 N[s] + 1``, a
window that gets full by ``1 - 2 N[h]``).  The cheapest level wins, ties go to the
fullest.  Even counts at all levels mean that what comes next finds its gap.

Windows still open at the end -- and all of them, whenever there are more than
``open_windows``, which bounds a task's memory -- are filled up: the fullest take
ids from the emptiest, whose pieces are cut.  At most one part-filled window is
left a task; it is cut into sequences whose lengths are powers of two, the lengths
that need no padding.  So only pieces of the last windows are cut, and no sequence
is padded at all.

A sequence's id holds the task's number, so that a task run anew after a lost
executor makes the same sequences and no other task depends on it.

Defined results: a null text counts as empty and has just its end id; a null id
stays null; repeated rows are documents of their own; an empty table gives an empty
table; other columns are ignored.  A very long text is encoded word by word
(``word_ids``); a task holds the ids of one document and of its open windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm.word_ids import json_ids

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Sequences a task can make before ids of two tasks could meet.
TASK_SEQUENCES = 1 << 40


class Piece:
    """A stretch of one document's ids."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc: int | None, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        """Its first ``n`` ids and the others."""
        rest = Piece(self.doc, self.start + n, self.ids[n:], self.total)
        return Piece(self.doc, self.start, self.ids[:n], self.total), rest


def size_of(window: list[Piece]) -> int:
    return sum(len(p.ids) for p in window)


class Packer:
    """Sum-of-squares packing; finished sequences gather in ``done`` as lists of pieces."""

    def __init__(self, window: int, open_windows: int):
        self.window, self.open_windows = window, open_windows
        self.levels = np.zeros(window + 1, np.int64)  # open windows of each fill; none of 0 or of all
        self.at: list[list[list[Piece]]] = [[] for _ in range(window)]  # the open windows of each fill
        self.n_open = 0
        self.done: list[list[Piece]] = []

    def level_for(self, size: int) -> int:
        """The fill whose window takes ``size`` ids at the smallest sum of squares (0: a new window)."""
        last = self.window - size
        change = 2 * (self.levels[size:] - self.levels[: last + 1]) + 2
        change[0] = 2 * self.levels[size] + 1
        if last:
            change[last] = 1 - 2 * self.levels[last]
        change[1:][self.levels[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def put(self, fill: int, pieces: list[Piece]) -> None:
        """An open window of that fill."""
        self.at[fill].append(pieces)
        self.levels[fill] += 1
        self.n_open += 1

    def take(self, fill: int) -> list[Piece]:
        self.levels[fill] -= 1
        self.n_open -= 1
        return self.at[fill].pop()

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        total, whole = len(ids), len(ids) // self.window * self.window
        for k in range(0, whole, self.window):
            self.done.append([Piece(doc, k, ids[k : k + self.window], total)])
        size = total - whole
        if not size:
            return
        level = self.level_for(size)
        window = self.take(level) if level else []
        window.append(Piece(doc, whole, ids[whole:].copy(), total))
        if level + size == self.window:
            self.done.append(window)
        else:
            self.put(level + size, window)
        if self.n_open > self.open_windows:
            left = self.fill_up()
            if left:
                self.put(size_of(left), left)

    def fill_up(self) -> list[Piece]:
        """Close all open windows, the fullest with ids of the emptiest; what is left is less than a window."""
        windows = [w for fill in range(self.window - 1, 0, -1) for w in self.at[fill]]
        self.levels[:] = 0
        self.at, self.n_open = [[] for _ in range(self.window)], 0
        first, last = 0, len(windows) - 1
        while first < last:
            target = windows[first]
            lacking = self.window - size_of(target)
            while lacking and first < last:
                source = windows[last]
                piece = source.pop()
                if len(piece.ids) > lacking:
                    piece, rest = piece.cut(lacking)
                    source.append(rest)
                target.append(piece)
                lacking -= len(piece.ids)
                if not source:
                    last -= 1
            if not lacking:
                self.done.append(target)
                first += 1
        left = windows[first] if first < len(windows) and first <= last else []
        if left and size_of(left) == self.window:
            self.done.append(left)
            left = []
        return left

    def finish(self) -> None:
        """Close everything; what is less than a window goes into sequences of 2^k ids."""
        left = self.fill_up()
        size = size_of(left)
        while size:
            lacking = 1 << (size.bit_length() - 1)
            size -= lacking
            sequence = []
            while lacking:
                piece = left.pop(0)
                if len(piece.ids) > lacking:
                    piece, rest = piece.cut(lacking)
                    left.insert(0, rest)
                sequence.append(piece)
                lacking -= len(piece.ids)
            self.done.append(sequence)


def pack(
    df: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    window: int = 2048,
    open_windows: int = 4096,
    ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, with ``ids`` its ids."""
    if window < 2 or window & (window - 1):
        raise ValueError("window: a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, packer = json_ids(tokenizer_path, kept=1 << 19), Packer(window, open_windows)
        sequence = TaskContext.get().partitionId() * TASK_SEQUENCES

        def finished():
            nonlocal sequence
            out: list[list] = [[] for _ in range(7 + ids)]
            for pieces in packer.done:
                at = 0
                for p in pieces:
                    n, crc = len(p.ids), zlib.crc32(p.ids.astype("<u4").tobytes())
                    row = (p.doc, p.start, n, crc, p.total, sequence, at, *([p.ids.astype("<i4")] if ids else []))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    at += n
                sequence += 1
            packer.done = []
            types = [pa.int64()] * 7 + [pa.list_(pa.int32())] * ids
            arrays = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, [*PIECE.replace(" long", "").split(", "), *["ids"] * ids])

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                rows = batch.slice(at, 128)
                docs = rows.column(0).to_pylist()
                for doc, found in zip(docs, encode([t or "" for t in rows.column(1).to_pylist()]), strict=True):
                    packer.add(doc, np.append(found, np.uint32(end_id)))
                if packer.done:
                    yield finished()
        packer.finish()
        if packer.done:
            yield finished()

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, PIECE + ", ids array<int>" * ids)
