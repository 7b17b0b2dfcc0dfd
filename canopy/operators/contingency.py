"""Class counts and attribute/class contingency tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.operators.prepare import FILL_TOKEN, LABEL


def _pos(label: str):
    return F.count_if(F.coalesce(F.col(label), F.lit(False)))


def _neg(label: str):
    """A null label counts as ``false``, like in the prepared frame."""
    return F.count_if(~F.coalesce(F.col(label), F.lit(False)))


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: ``pos``, ``neg``, ``total``."""
    return df.agg(_pos(label).alias("pos"), _neg(label).alias("neg"), F.count(F.lit(1)).alias("total"))


def cells(df: DataFrame, attrs: Sequence[str], label: str = LABEL, token: str = FILL_TOKEN) -> DataFrame:
    """Class counts per distinct combination of the attributes.

    This is the only pass over the rows the tree needs: every node of an
    ID3 tree over categorical attributes is a conjunction of equalities,
    so its class counts are sums of these cells.  Map-side partial
    aggregation makes a hot combination cost one row per task, not one row
    per record.  Attribute values are strings; nulls become ``token``.
    """
    keys = [F.coalesce(F.col(a).cast("string"), F.lit(token)).alias(a) for a in attrs]
    return df.groupBy(*keys).agg(_pos(label).alias("pos"), _neg(label).alias("neg"))


def long_counts(cells_df: DataFrame, attrs: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Cells → ``ids..., attr, value, pos, neg`` summed per attribute value."""
    long = cells_df.unpivot([*ids, "pos", "neg"], list(attrs), "attr", "value")
    return long.groupBy(*ids, "attr", "value").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def attr_value_counts(
    df: DataFrame | None, attrs: Sequence[str], label: str = LABEL, *, cells_df: DataFrame | None = None
) -> DataFrame:
    """``attr, value, helpful_count, not_helpful_count, total`` for every attribute.

    One scan for all attributes: rows are compressed to cells first (or given
    as ``cells_df``), then the cells are unpivoted and summed.
    """
    return long_counts(cells(df, attrs, label) if cells_df is None else cells_df, attrs).select(
        "attr",
        "value",
        F.col("pos").alias("helpful_count"),
        F.col("neg").alias("not_helpful_count"),
        (F.col("pos") + F.col("neg")).alias("total"),
    )


def attr_value_counts_join(
    df: DataFrame | None, attrs: Sequence[str], label: str = LABEL, *, cells_df: DataFrame | None = None
) -> DataFrame:
    """Same result in the literal form: per attribute, positive and negative
    counts grouped separately, full outer joined on the value, gaps filled
    with 0.  Kept for fidelity; ``attr_value_counts`` is the fast path.

    The rows are read once: both sides of every join are aggregated from
    the stored cells (one pass), not from the input.
    """
    from canopy.operators._lineage import durable

    c = durable(cells(df, attrs, label))[0] if cells_df is None else cells_df
    parts = []
    for a in attrs:
        pos = c.where(F.col("pos") > 0).groupBy(a).agg(F.sum("pos").alias("helpful_count"))
        neg = c.where(F.col("neg") > 0).groupBy(a).agg(F.sum("neg").alias("not_helpful_count"))
        joined = pos.join(neg, [a], "full_outer").na.fill(0, ["helpful_count", "not_helpful_count"])
        parts.append(
            joined.select(
                F.lit(a).alias("attr"),
                F.col(a).cast("string").alias("value"),
                "helpful_count",
                "not_helpful_count",
                (F.col("helpful_count") + F.col("not_helpful_count")).alias("total"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def node_counts(cells_df: DataFrame, path: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """One row ``pos, neg, total``: the class counts of the node at ``path``."""
    counts = path_filter(cells_df, path).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("neg")
    )
    return counts.withColumn("total", F.col("pos") + F.col("neg"))


def node_split(cells_df: DataFrame, attr: str, path: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """The children of the node at ``path`` when it is split by ``attr``: ``attr, value, pos, neg``."""
    children = path_filter(cells_df, path).groupBy(F.col(attr).alias("value"))
    counts = children.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return counts.select(F.lit(attr).alias("attr"), "value", "pos", "neg")


def leaf_labels(cells_df: DataFrame, path: Sequence[tuple[str, str]] = (), by: str | None = None) -> DataFrame:
    """The distinct labels found under ``path`` (``label``), or under each child by ``by`` (``parent_value, label``)."""
    inside = path_filter(cells_df, path)
    keys = [F.col(by).alias("parent_value")] if by else []
    per = inside.groupBy(*keys).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    labels = F.array(F.when(F.col("pos") > 0, F.lit(True)), F.when(F.col("neg") > 0, F.lit(False)))
    names = ["parent_value"] if by else []
    return per.select(*names, F.explode(labels).alias("label")).where(F.col("label").isNotNull())


def distinct_values(df: DataFrame, attr: str) -> DataFrame:
    return df.select(attr).distinct()


def path_filter(df: DataFrame, path: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows matching ``a1 = v1 AND a2 = v2 ...``; values are literals, never SQL text."""
    cond = reduce(lambda x, y: x & y, [F.col(a) == F.lit(v) for a, v in path], F.lit(True))
    return df.where(cond)


def domain_violations(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values outside each attribute's declared domain: ``attr, value, n_rows``; a null is outside every domain."""
    attrs = list(domains)
    long = df.select(*[F.col(a).cast("string").alias(a) for a in attrs]).unpivot([], attrs, "attr", "value")
    outside = None
    for a, values in domains.items():
        test = (F.col("attr") == F.lit(a)) & ~F.coalesce(F.col("value").isin(list(values)), F.lit(False))
        outside = test if outside is None else outside | test
    return long.where(outside).groupBy("attr", "value").agg(F.count(F.lit(1)).alias("n_rows"))
