"""Token counts of whole documents by overlap resynchronisation.

Short texts go to the library in batches.  A huge text is encoded in
overlapping chunks, so that memory is bounded by the chunk and not by the
document.  Neighbouring chunks are spliced at a *proven stable common
boundary*: a position where both encodings start a pre-token.  A byte-level
splitter scans left to right and looks ahead but never back, so what follows
a pre-token start depends only on the text to its right; once both scans
start a pre-token at one place, the right chunk's tokens are those of the
whole text.  Two margins make the left chunk's start trustworthy: the
pre-token that begins there ends before the chunk does (its end was decided
by a character the chunk holds), and no special string can be cut by either
chunk's edge next to it.  If the overlap holds no such place, the overlap is
doubled; when it would reach back to the start of the left chunk, both
chunks are encoded as one.  The last resort is the whole text, so the
result never depends on the chunk size.

Splicing needs that kind of splitter: ``byte_level_splice`` reads it off the
tokenizer file.  Other tokenizers encode each text whole.

Defined results: a null text counts as empty (0 bytes, 0 tokens); an empty
table gives an empty table; repeated rows and equal ids give one result row
each; a null id stays null; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import lru_cache
from itertools import pairwise

from pyspark.sql import DataFrame

from canopy.llm.common import arrow_map

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks int, n_widened int"


class Encoded:
    """Tokens of one chunk: ids, byte offsets (one more than ids) and the
    indexes of tokens that start a pre-token."""

    def __init__(self, ids: list[int], offsets: list[int], starts: list[int]):
        self.ids, self.offsets, self.starts = ids, offsets, starts


@lru_cache(maxsize=4)
def load_json(path: str):
    """The tokenizer of a ``.json`` file, kept by each Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def byte_level_splice(path: str) -> tuple[int, dict[int, int]] | None:
    """(longest special string in bytes, bytes of each id), or None when
    chunks of this tokenizer can't be spliced."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = spec.get("pre_tokenizer") or {}
    special = spec.get("added_tokens") or []
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    loose = any(t.get(k) for t in special for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if not plain or loose or spec.get("normalizer") or spec.get("truncation") or spec["model"].get("type") != "BPE":
        return None
    sizes = {i: len(token) for token, i in spec["model"]["vocab"].items()}  # one character stands for one byte
    sizes |= {t["id"]: len(t["content"].encode()) for t in special}
    return max((len(t["content"].encode()) for t in special), default=0), sizes


def encode_chunk(path: str, text: str) -> Encoded:
    encoding = load_json(path).encode(text, add_special_tokens=False)
    _, sizes = byte_level_splice(path)
    ids, words, offsets = encoding.ids, encoding.word_ids, [0]
    for i in ids:
        offsets.append(offsets[-1] + sizes[i])
    starts = [k for k, w in enumerate(words) if k == 0 or w is None or w != words[k - 1]]
    return Encoded(ids, offsets, starts)


def char_start(data: bytes, at: int) -> int:
    """The start of the character that holds byte ``at``."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def stable_starts(chunk: Encoded, base: int, margin: int, whole_start: bool, whole_end: bool) -> dict[int, int]:
    """Trusted pre-token starts of a chunk: byte position in the text -> token index."""
    end = base + chunk.offsets[-1]
    bounds = [*chunk.starts, len(chunk.ids)]
    found = {}
    for k, after in pairwise(bounds):
        at, stop = base + chunk.offsets[k], base + chunk.offsets[after]
        if (whole_end or (stop < end and at + margin < end)) and (whole_start or at >= base + margin):
            found[at] = k
    return found


def spliced_tokens(
    data: bytes, encode: Callable[[str], Encoded], margin: int, chunk_bytes: int, overlap_bytes: int
) -> tuple[list[tuple[int, int]], int, int]:
    """((id, byte offset) of every token, chunks encoded, overlaps widened) of one text."""
    n, margin = len(data), margin + 8
    left_at, left_end = 0, char_start(data, chunk_bytes) if chunk_bytes < n else n
    left, keep_from, out, chunks, widened = encode(data[:left_end].decode()), 0, [], 1, 0
    while left_end < n:
        overlap, splice = overlap_bytes, None
        lefts = stable_starts(left, left_at, margin, left_at == 0, False)
        while splice is None:
            right_at = char_start(data, max(left_end - overlap, left_at))
            right_end = char_start(data, left_end + chunk_bytes) if left_end + chunk_bytes < n else n
            joined = right_at <= left_at + left.offsets[keep_from]
            if joined:  # no common start anywhere: both chunks as one, from the last proven start
                right_at = left_at + left.offsets[keep_from]
            right, chunks = encode(data[right_at:right_end].decode()), chunks + 1
            if joined:
                splice = keep_from, 0
                break
            rights = stable_starts(right, right_at, margin, False, right_end == n)
            common = [p for p in rights if p in lefts and lefts[p] > keep_from]
            if common:
                splice = lefts[min(common)], rights[min(common)]
            else:
                overlap, widened = overlap * 2, widened + 1
        stop, start = splice
        out.extend((left.ids[k], left_at + left.offsets[k]) for k in range(keep_from, stop))
        left, left_at, left_end, keep_from = right, right_at, right_end, start
    out.extend((left.ids[k], left_at + left.offsets[k]) for k in range(keep_from, len(left.ids)))
    return out, chunks, widened


def count_tokens(
    df: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
    chunk_bytes: int = 1 << 16,
    overlap_bytes: int = 1 << 10,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit`` and, for
    documents encoded in chunks, ``n_chunks`` and ``n_widened``.

    ``tokenizer_path`` is a ``.json`` file of the tokenizers library or a
    ``.model`` file of sentencepiece, at the same place on every executor.
    """

    def whole_counts(texts: list[str]) -> list[int]:
        if tokenizer_path.endswith(".model"):
            return [len(x) for x in sentence_pieces(tokenizer_path).encode(texts, num_threads=1)]
        return [len(x.ids) for x in load_json(tokenizer_path).encode_batch_fast(texts, add_special_tokens=False)]

    def rows(given):
        texts = [t or "" for t in given[text_col]]
        data = [t.encode() for t in texts]
        splice = None if tokenizer_path.endswith(".model") else byte_level_splice(tokenizer_path)
        huge = {k for k, b in enumerate(data) if splice and len(b) > chunk_bytes}
        counts, n_chunks, n_widened = [0] * len(texts), [1] * len(texts), [0] * len(texts)
        short = [k for k in range(len(texts)) if k not in huge]
        for k, n in zip(short, whole_counts([texts[k] for k in short]), strict=True):
            counts[k] = n
        for k in huge:
            tokens, n_chunks[k], n_widened[k] = spliced_tokens(
                data[k], lambda t: encode_chunk(tokenizer_path, t), splice[0], chunk_bytes, overlap_bytes
            )
            counts[k] = len(tokens)
        yield {
            "doc_id": given[id_col],
            "n_bytes": [len(b) for b in data],
            "n_tokens": counts,
            "over_limit": [n > limit for n in counts],
            "n_chunks": n_chunks,
            "n_widened": n_widened,
        }

    return arrow_map(df, [id_col, text_col], rows, SCHEMA, slice_rows=128)


@lru_cache(maxsize=4)
def sentence_pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)
