"""Typed scan of review TSV files.

The format is tab separated, one header line per file, one record per line,
and has *no* quote or escape characters.  Spark's CSV reader defaults to
``quote='"'``, which would swallow tabs inside a stray quote and merge
fields, so the reader turns quoting off explicitly.  ``.gz`` files are
decompressed by Spark transparently; they are not splittable, so each such
file is one scan task (use ``repartition`` only if a later stage needs more
parallelism than the file count -- the tree operators aggregate map-side
first, so they usually do not).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The column layout of the review files, in file order.
REVIEW_COLUMNS = (
    "marketplace",
    "customer_id",
    "review_id",
    "product_id",
    "product_parent",
    "product_title",
    "product_category",
    "star_rating",
    "helpful_votes",
    "total_votes",
    "vine",
    "verified_purchase",
    "review_headline",
    "review_body",
    "review_date",
)

# The eight columns the tree pipeline reads; Catalyst prunes the rest.
PIPELINE_COLUMNS = (
    "marketplace",
    "verified_purchase",
    "star_rating",
    "vine",
    "product_category",
    "review_body",
    "total_votes",
    "helpful_votes",
)

CORRUPT_COLUMN = "_corrupt_record"


def review_schema(with_corrupt: bool = True) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True) for c in REVIEW_COLUMNS]
    if with_corrupt:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType(), True))
    return T.StructType(fields)


def _paths(path: str | Iterable[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_reviews(
    spark: SparkSession,
    path: str | Iterable[str],
    *,
    columns: Iterable[str] | None = PIPELINE_COLUMNS,
    keep_corrupt: bool = False,
    repartition: int | None = None,
) -> DataFrame:
    """Read one or more review files (file, list, glob or directory).

    Columns are taken by the names in the header, wherever they stand; files
    read together must have the same header (Spark checks each file's and
    raises), and a header without a wanted column is an error.  Every column
    is read as a string (no inference pass over the data).  Short or long
    lines are kept in PERMISSIVE mode: missing fields become null and the raw
    line lands in ``_corrupt_record`` when ``keep_corrupt`` is set.
    """
    options = {
        "sep": "\t",
        "header": True,
        "quote": "",
        "escape": "",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT_COLUMN,
        "encoding": "UTF-8",
        "enforceSchema": False,  # each file's header is held against the schema
    }
    # only the first line of a file is looked at for the names
    names = spark.read.options(**options, inferSchema=False).csv(_paths(path)).columns
    wanted = list(columns) if columns is not None else list(REVIEW_COLUMNS)
    missing = [c for c in wanted if c not in names]
    if missing:
        raise ValueError(f"the header has no column {missing}")
    fields = [T.StructField(c, T.StringType(), True) for c in names]
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType(), True))
    df = spark.read.schema(T.StructType(fields)).options(**options).csv(_paths(path))
    if keep_corrupt:
        wanted.append(CORRUPT_COLUMN)
    df = df.select(*wanted)
    if repartition:
        df = df.repartition(repartition)
    return df


def read_review_lines(spark: SparkSession, path: str | Iterable[str]) -> DataFrame:
    """Raw text lines (``value`` column), header lines included."""
    return spark.read.text(_paths(path))
