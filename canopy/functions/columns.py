"""Scalar column expressions.

All of these are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen and can be pushed through Catalyst like any other
expression.  Inputs may be column names or ``Column`` objects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_above(numerator: ColumnLike, denominator: ColumnLike, threshold: float = 0.5) -> Column:
    """``numerator / denominator > threshold`` as a non-null boolean.

    A zero, null or non-numeric denominator (or numerator) gives ``false``,
    and a ratio exactly equal to the threshold is ``false`` (strict ``>``).
    ``try_cast`` and ``try_divide`` keep this safe under ANSI mode.
    """
    num = col(numerator).try_cast("double")
    den = col(denominator).try_cast("double")
    return F.coalesce(F.try_divide(num, den) > F.lit(float(threshold)), F.lit(False))


def flag_to_boolean(c: ColumnLike, true_token: str = "Y") -> Column:
    """``'Y'`` → true; anything else, including null, → false."""
    return F.coalesce(col(c) == F.lit(true_token), F.lit(False))


def rating_bucket(c: ColumnLike) -> Column:
    """Star rating → ``bad`` / ``regular`` / ``good``.

    Below 2 is ``bad``, exactly 3 is ``regular`` and everything else
    (including 2, 4, 5) is ``good``.  A null or non-numeric rating counts
    as 0 and so is ``bad``.
    """
    r = F.coalesce(col(c).try_cast("bigint"), F.lit(0))
    return F.when(r < 2, F.lit("bad")).when(r == 3, F.lit("regular")).otherwise(F.lit("good"))


def text_length(c: ColumnLike) -> Column:
    """Length of a text in characters as a double; null text → 0."""
    return F.coalesce(F.length(col(c)), F.lit(0)).cast("double")


def hash_bucket(key: ColumnLike, modulus: int = 100) -> Column:
    """Repeatable bucket in ``[0, modulus)`` from the first 32 bits of ``md5(key)``.

    Unlike ``randomSplit`` it depends only on the key, not on partitioning
    or task order, so a lost executor recomputes exactly the same split.
    A null key counts as the empty text, so it has a bucket like any other.
    """
    hexa = F.substring(F.md5(F.coalesce(col(key).cast("string"), F.lit(""))), 1, 8)
    return F.conv(hexa, 16, 10).cast("bigint") % F.lit(modulus)


def squared_error(truth: ColumnLike, predicted: ColumnLike) -> Column:
    """``(truth - predicted)^2`` over booleans mapped to 1 / 0 (null → 0)."""
    t = F.coalesce(col(truth).cast("boolean"), F.lit(False)).cast("int")
    p = F.coalesce(col(predicted).cast("boolean"), F.lit(False)).cast("int")
    return F.pow(t - p, F.lit(2)).cast("double")


def _plogp(c: Column, t: Column) -> Column:
    ratio = c / t
    return F.when(c > 0, -ratio * F.log2(ratio)).otherwise(F.lit(0.0))


def entropy(pos: ColumnLike, neg: ColumnLike) -> Column:
    """Binary entropy ``-Σ (c/t)·log2(c/t)`` of two class counts.

    Zero counts contribute nothing and an empty set has entropy 0 (Spark's
    ``log2(0)`` is null, so the zero case is guarded explicitly).
    """
    p = col(pos).cast("double")
    n = col(neg).cast("double")
    t = p + n
    return F.when(t > 0, _plogp(p, t) + _plogp(n, t)).otherwise(F.lit(0.0))


def value_of(attr_name: ColumnLike, attrs: list[str] | tuple[str, ...]) -> Column:
    """The value of the attribute whose *name* is held in ``attr_name``.

    Expands to ``CASE attr_name WHEN 'a' THEN a WHEN 'b' THEN b ... END``:
    a plain expression, so it stays in codegen.
    """
    name = col(attr_name)
    expr = None
    for a in attrs:
        branch_val = F.col(a).cast("string")
        expr = F.when(name == F.lit(a), branch_val) if expr is None else expr.when(name == F.lit(a), branch_val)
    return expr if expr is not None else F.lit(None).cast("string")


def child_id(parent_id: ColumnLike, attr: ColumnLike, value: ColumnLike) -> Column:
    """Identifier of the child reached from ``parent_id`` along ``attr = value``.

    ``md5(parent || '|' || attr || '=' || value)``: parent ids never contain
    ``'|'`` and attribute names never contain ``'='``, so distinct paths give
    distinct strings; the same formula works in any SQL engine with md5.
    """
    return F.md5(F.concat(col(parent_id), F.lit("|"), col(attr), F.lit("="), col(value)))
