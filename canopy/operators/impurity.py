"""Information gain over long-form class counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopy.functions.columns import entropy

#: A gain is a sum of about as many rounded terms as there are values; each can be off by half of this.
ROUNDING = 2.0**-51


def gain_error(n_values: Column) -> Column:
    """How far apart two computed gains can be that are equal in truth."""
    return (n_values + 4) * F.lit(ROUNDING)


def attr_order(attrs: Sequence[str], attr: str | Column = "attr") -> Column:
    c = F.col(attr) if isinstance(attr, str) else attr
    expr = None
    for i, a in enumerate(attrs):
        expr = F.when(c == F.lit(a), F.lit(i)) if expr is None else expr.when(c == F.lit(a), F.lit(i))
    return expr


def info_gain(counts: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``IG = H(S) − Σ |S_v|/|S| · H(S_v)`` per (group, attr).

    ``counts`` has ``group..., attr, value, pos, neg``.  Every row of the
    parent set has exactly one value per attribute, so the parent's counts
    are the sums over the values: one window over the (aggregated) counts, no join.
    Output: ``group..., attr, info_gain, pos, neg, n_values, zero``; ``zero``
    is an exact integer test: every value has the parent's class ratio.
    """
    t = (F.col("pos") + F.col("neg")).cast("double")
    parent = Window.partitionBy(*group, "attr")
    big = "decimal(38,0)"
    sided = counts.withColumn("_p", F.sum("pos").over(parent)).withColumn("_n", F.sum("neg").over(parent))
    same_ratio = F.col("pos").cast(big) * F.col("_n").cast(big) == F.col("neg").cast(big) * F.col("_p").cast(big)
    agg = sided.groupBy(*group, "attr").agg(
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum(t * entropy("pos", "neg")).alias("_wh"),
        F.count(F.lit(1)).alias("n_values"),
        F.bool_and(same_ratio).alias("zero"),
    )
    total = (F.col("pos") + F.col("neg")).cast("double")
    gain = entropy("pos", "neg") - F.try_divide(F.col("_wh"), total)
    return agg.select(*group, "attr", gain.alias("info_gain"), "pos", "neg", "n_values", "zero")


def best_attribute(gains: DataFrame, attrs: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Arg-max of ``info_gain`` per group.

    An attribute that separates the classes at all (``zero`` false, an exact
    test) comes before any that doesn't; of the others the highest gain wins, and
    gains that rounding could have made differ (``gain_error``) are a tie, which
    goes to the attribute listed first.  Two aggregations, no sort.
    """
    if not group:
        gains = gains.withColumn("_all", F.lit(0))
    by = list(group) or ["_all"]
    whole = Window.partitionBy(*by)
    real = F.when(~F.col("zero"), F.col("info_gain"))
    top = F.col("info_gain") >= F.max(real).over(whole) - gain_error(F.max("n_values").over(whole))
    key = F.struct(
        (~F.col("zero") & F.coalesce(top, F.lit(False))).alias("first"),
        (-attr_order(attrs)).alias("o"),
        F.col("attr").alias("attr"),
        F.col("info_gain").alias("info_gain"),
    )
    best = gains.withColumn("_key", key).groupBy(*by).agg(F.max("_key").alias("b"))
    return best.select(*group, F.col("b.attr").alias("attr"), F.col("b.info_gain").alias("info_gain"))
