"""Helpers shared by the text operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from canopy.operators._lineage import checkpoint_dir

#: A word: a longest run without space, tab, line feed, vertical tab, form feed or carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the session's ``spark.checkpoint.dir`` and read it back.

    The table lies in the shared folder, so a lost executor costs only the
    tasks it was running, and the columns are compressed and prunable.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_map(
    df: DataFrame,
    columns: list[str],
    rows: Callable[[dict[str, list]], Iterable[dict[str, list]]],
    schema: str,
    slice_rows: int = 256,
) -> DataFrame:
    """Map ``columns`` of ``df`` in slices of at most ``slice_rows`` rows.

    ``rows`` gets one slice as plain lists by column and yields results as
    lists by column; memory per task is bounded by one slice and its result.
    """
    parsed = StructType.fromDDL(schema)
    names = parsed.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(parsed)
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                given = {c: part.column(i).to_pylist() for i, c in enumerate(columns)}
                for out in rows(given):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[n], type=arrow.field(n).type) for n in names], schema=arrow
                    )

    return df.select(*columns).mapInArrow(run, schema)
