"""Language of a text by the nearest of several centroids per language.

A text becomes a vector of hashed byte n-grams (two and three bytes of the
lower-cased text, every non-letter a space), sub-linear counts times inverse
document frequency, at length 1.  Each language has several centroids,
clustered by spherical k-means from a bounded sample; the prediction is the
language of the centroid of highest cosine.  A text whose distance (1 - cosine)
to its nearest centroid is beyond that centroid's own radius, widened by
``slack``, is marked as rejected.

Document frequencies are counted over all training rows: each task adds up
its rows into one vector of fixed size and Spark sums these.  The sample is
bounded by ``sample_rows`` rows a language (smallest seeded hash of the id)
and is clustered by language in Spark; the driver gets ``clusters`` vectors a
language.

Defined results: a null text or one without a letter is ``und`` with score 0;
if nothing could be learned every text is ``und``; an empty table gives an empty
table; repeated rows give one result row each; ties go to the language first
in code point order; rows with a null language are not learned from; null ids
stay null and are hashed as an empty text; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from canopy.llm.common import arrow_map

LETTER = regex.compile(r"\p{L}")
BITS = 12
SIZE = 1 << BITS
#: Bytes as read: ASCII letters in lower case, all other ASCII a space, the rest as it is.
READ_AS = np.array(
    [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32
)
UNKNOWN = "und"


def bucket(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def gram_counts(texts: list[bytes]) -> np.ndarray:
    """A row of n-gram counts for each text."""
    out = np.zeros((len(texts), SIZE), np.float32)
    for k, text in enumerate(texts):
        b = READ_AS[np.frombuffer(b" " + text + b" ", np.uint8)]
        b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])]  # a run of spaces counts as one
        two = (b[:-1] << np.uint32(8)) | b[1:]
        three = (two[:-1] << np.uint32(8)) | b[2:]
        out[k] = np.bincount(bucket(two ^ np.uint32(0x5BD1E995)), minlength=SIZE)
        out[k] += np.bincount(bucket(three), minlength=SIZE)
    return out


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]  # of each centroid, in code point order
    centroids: np.ndarray
    radius: np.ndarray
    idf: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        names, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        known = [k for k, t in enumerate(texts) if t and LETTER.search(t)]
        if known and len(self.languages):
            x = vectors(gram_counts([texts[k].encode() for k in known]), self.idf)
            cosine = x @ self.centroids.T
            best = cosine.argmax(axis=1)
            for k, c, row in zip(known, best.tolist(), cosine, strict=True):
                names[k] = self.languages[c]
                scores[k] = float(min(max(row[c], 0.0), 1.0))
                rejected[k] = bool(1 - row[c] > self.radius[c])
        return names, scores, rejected


def document_frequencies(df: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """The number of texts and, for each n-gram, of texts that hold it, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(SIZE, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = [t.encode() for t in batch.column(0).slice(at, 256).to_pylist() if t]
                n += len(texts)
                total += (gram_counts(texts) > 0).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1, *range(SIZE)], pa.int32()), pa.array([n, *total.tolist()], pa.int64())], ["gram", "n"]
            )

    sums = df.select(text_col).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = {r.gram: r.n for r in sums.collect()}  # at most SIZE + 1 rows
    return found.get(-1, 0), np.array([found.get(k, 0) for k in range(SIZE)], np.int64)


def spherical_k_means(x: np.ndarray, k: int, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids, and the largest distance of a member to its centroid."""
    rng = np.random.default_rng(seed)
    centres = x[[int(rng.integers(len(x)))]]
    while len(centres) < min(k, len(x)):  # the next seed is the row furthest from those there are
        centres = np.concatenate([centres, x[[int((x @ centres.T).max(axis=1).argmin())]]])
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.stack([x[own == c].sum(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    cosine = x @ centres.T
    own = cosine.argmax(axis=1)
    far = [1 - cosine[own == c, c].min() if (own == c).any() else 0.0 for c in range(len(centres))]
    return centres, np.array(far)


def fit(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = 400,
    clusters: int = 4,
    rounds: int = 12,
    slack: float = 1.25,
    seed: int = 5,
) -> Model:
    """Learn from every row's text for the frequencies, from the sample for the centroids."""
    rows = df.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where("lang is not null and text is not null")
    n, frequency = document_frequencies(rows, "text")
    idf = np.log((1 + n) / (1 + frequency)).astype(np.float32) + np.float32(1)
    order = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(seed))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id", "t"))
    # keys first, so that only the chosen rows' texts move; equal rows count once
    keys = ["lang", "k", "t"]
    keyed = rows.withColumn("k", F.coalesce(F.col("id").cast("string"), F.lit(""))).withColumn("t", F.xxhash64("text"))
    chosen = keyed.select(*keys, "id", order.alias("h")).distinct().withColumn("rank", rank).where(F.col("rank") <= sample_rows)
    sample = keyed.join(F.broadcast(chosen.select(*keys)), keys, "left_semi").dropDuplicates(keys)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        texts = sorted(group["text"])
        centres, far = spherical_k_means(vectors(gram_counts([t.encode() for t in texts]), idf), clusters, rounds, seed)
        return pd.DataFrame(
            {"lang": group["lang"].iloc[0], "centroid": [c.tolist() for c in centres], "radius": (far * slack).tolist()}
        )

    found = sample.select("lang", "text").groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>, radius double")
    centroids = sorted(found.collect(), key=lambda r: (r.lang, r.centroid))
    return Model(
        tuple(r.lang for r in centroids),
        np.array([r.centroid for r in centroids], np.float32).reshape(len(centroids), SIZE),
        np.array([r.radius for r in centroids]),
        idf,
    )


def predict(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` from the text alone, and the columns ``keep`` of ``df`` (of any type)."""
    kept = [df.schema[c] for c in keep]
    held = df.sparkSession.sparkContext.broadcast(model)  # languages x clusters vectors of fixed size

    def rows(given):
        names, scores, rejected = held.value.predict(given[text_col])
        yield {"doc_id": given[id_col], "lang_pred": names, "score": scores, "rejected": rejected, **{c: given[c] for c in keep}}

    extra = "".join(f", {f.name} {f.dataType.simpleString()}" for f in kept)
    schema = f"doc_id long, lang_pred string, score double, rejected boolean{extra}"
    return arrow_map(df, list(dict.fromkeys([id_col, text_col, *keep])), rows, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """The third of the documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
