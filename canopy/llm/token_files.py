"""Token ids of a corpus as coded files: written in order of document id, read back, verified.

Documents are dealt out by ranges of their id, so file order is id order.  A
task encodes its documents one after the other, ends each with ``end_id`` and
packs whole documents to segments of about ``segment_ids`` ids
(``context_coder.pack_segment``: blocks coded on their own and checksummed).
A file is one task's Parquet part; each row is a segment with its place in the
order, so that Spark's commit protocol guards the files on any store, a lost
task is written anew, and columns that only say sizes are read without the
payload.

Defined results: a null text counts as empty and has just its end id; null ids
come first; rows of one id follow each other in order of their text; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from canopy.llm.byte_words import byte_words
from canopy.llm.common import arrow_map
from canopy.llm.context_coder import pack_segment, unpack_segment

SEGMENT = "part int, segment int, n_docs int, n_ids long, data binary"


def encode_segments(
    df: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    block_ids: int = 512,
    segment_ids: int = 1 << 22,
) -> DataFrame:
    """``part, segment, n_docs, n_ids, data`` in order of document id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        docs, counts, parts, total = [], [], [], 0

        def segment():
            data = pack_segment(docs, counts, np.concatenate(parts), block_ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([n], pa.int32()), pa.array([len(docs)], pa.int32()), pa.array([total], pa.int64()), pa.array([data], pa.binary())],
                ["part", "segment", "n_docs", "n_ids", "data"],
            )

        encode = byte_words(tokenizer_path, end_id)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                found, sizes = encode(rows.column(1))
                names, ends, a = rows.column(0).to_pylist(), np.cumsum(sizes), 0
                while a < len(names):
                    done = int(ends[a] - sizes[a])
                    b = min(int(np.searchsorted(ends, done + segment_ids - total)) + 1, len(names))
                    docs += names[a:b]
                    counts += sizes[a:b].tolist()
                    parts.append(found[done : ends[b - 1]])
                    total += len(parts[-1])
                    a = b
                    if total >= segment_ids:
                        yield segment()
                        n += 1
                        docs, counts, parts, total = [], [], [], 0
        if docs:
            yield segment()

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, SEGMENT)


def write_token_files(df: DataFrame, tokenizer_path: str, path: str, **how) -> None:
    encode_segments(df, tokenizer_path, **how).write.parquet(path)


def read_token_files(segments: DataFrame, *, ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files, with ``ids`` also its ids.

    Sums of sizes by part, then by segment within a part, give each segment
    its start; only these few numbers go through a window.
    """
    by_part = segments.groupBy("part").agg(F.sum("n_ids").alias("size"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select("part", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("own"))
    starts = starts.join(by_part, "part").select("part", "segment", (F.col("part_start") + F.col("own")).alias("base"))

    def rows(given):
        for part, segment, data in zip(given["part"], given["segment"], given["data"], strict=True):
            docs, counts, values = unpack_segment(data)
            at = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            wide = values.astype("<u4")
            cut = [wide[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            out = {
                "part": [part] * len(docs),
                "segment": [segment] * len(docs),
                "doc_id": docs,
                "offset": at[:-1].tolist(),
                "n_tokens": counts,
                "ids_crc32": [zlib.crc32(c) for c in cut],
            }
            if ids:
                out["ids"] = [c.tolist() for c in cut]
            yield out

    schema = "part int, segment int, doc_id long, offset long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
    docs = arrow_map(segments, ["part", "segment", "data"], rows, schema, slice_rows=1).join(starts, ["part", "segment"])
    return docs.select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids)
