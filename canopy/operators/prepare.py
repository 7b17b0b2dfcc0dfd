"""Preparation: derived target, rating bucket, text length, missing values, row index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canopy.functions.columns import ratio_above, rating_bucket, text_length
from canopy.operators._lineage import durable

# Attribute order (also the tie-break order), target name,
# helpfulness threshold and the token that replaces missing strings.
ATTRIBUTES = ("marketplace", "verified_purchase", "vine", "product_category", "review_body")
LABEL = "is_vote_helpful"
THRESHOLD = 0.5
FILL_TOKEN = "false"


def fill_missing(df: DataFrame, columns: list[str] | None = None, token: str = FILL_TOKEN) -> DataFrame:
    """Replace nulls and NaN the way a boolean ``false`` fill does, per column type.

    Strings get the text ``token`` (default ``'false'``, which then acts as
    an ordinary category), numbers (NaN included) get 0, booleans ``false``.
    Columns of other types are left alone.
    """
    wanted = set(columns) if columns is not None else None
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if wanted is not None and field.name not in wanted:
            out.append(c)
            continue
        dt = field.dataType
        if isinstance(dt, T.StringType):
            out.append(F.coalesce(c, F.lit(token)).alias(field.name))
        elif isinstance(dt, T.BooleanType):
            out.append(F.coalesce(c, F.lit(False)).alias(field.name))
        elif isinstance(dt, (T.FloatType, T.DoubleType)):
            out.append(F.coalesce(F.nanvl(c, F.lit(None).cast(dt)), F.lit(0).cast(dt)).alias(field.name))
        elif isinstance(dt, T.NumericType):
            out.append(F.coalesce(c, F.lit(0).cast(dt)).alias(field.name))
        else:
            out.append(c)
    return df.select(*out)


def prepare_reviews(
    raw: DataFrame,
    *,
    threshold: float = THRESHOLD,
    token: str = FILL_TOKEN,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Raw review columns (all strings) → prepared frame.

    Output: ``keep..., marketplace, verified_purchase, star_rating, vine,
    product_category, body_len (double), is_vote_helpful (boolean)``.
    """
    prepared = raw.select(
        *keep,
        "marketplace",
        "verified_purchase",
        rating_bucket("star_rating").alias("star_rating"),
        "vine",
        "product_category",
        text_length("review_body").alias("body_len"),
        ratio_above("helpful_votes", "total_votes", threshold).alias(LABEL),
    )
    return fill_missing(prepared, ["marketplace", "verified_purchase", "vine", "product_category"], token)


def _free_name(df: DataFrame, stem: str) -> str:
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def row_index(df: DataFrame, order_by: str, name: str = "row_index") -> DataFrame:
    """Consecutive 0-based index in ``order_by`` order (any orderable type), computed distributed.

    A global ``row_number()`` window would pull every row into one task.
    Instead the rows are dealt out by ranges of ``order_by`` and, so that a
    key held by many rows is cut as well, of the other orderable columns; each
    range is sorted and stored with its rows' positions, and the ranges'
    sizes (one number each) give every range its offset.  Only rows equal in
    all orderable columns have to stay together.
    """
    orderable = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
    ties = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name != order_by and isinstance(f.dataType, orderable)]
    keys = [F.col(f"`{order_by}`"), *ties]
    place = _free_name(df, "_place")
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # the id holds the range's number above bit 33 and the row's position in it below
    stored, _ = durable(ordered.withColumn(place, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(place), 33)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    offsets = offsets.toDF(_free_name(df, "_part"), _free_name(df, "_offset"))
    part_name, offset_name = offsets.columns
    position = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    # one row for each range of the shuffle above: as many as it had partitions
    joined = stored.join(F.broadcast(offsets), part == F.col(part_name))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(offset_name) + position).cast("bigint").alias(name))
