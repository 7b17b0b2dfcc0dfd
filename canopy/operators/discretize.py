"""Quartile cut points and quartile bins of a numeric column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.operators.quantiles import exact_quantiles

# Quartile probabilities and the bin labels, lowest first.
QUARTILES = (0.25, 0.5, 0.75)
BIN_LABELS = ("(0,Q1]", "(Q1,Q2]", "(Q2,Q3]", "Q3")
CUT_NAMES = ("q1", "q2", "q3")


def quartile_cuts(df: DataFrame, value: str = "body_len", by: Sequence[str] = (), weight=None) -> DataFrame:
    """Exact quartiles (``percentile_disc``) per group → ``by..., q1, q2, q3``."""
    return exact_quantiles(df, value, QUARTILES, CUT_NAMES, by=by, weight=weight)


def quartile_cuts_approx(df: DataFrame, value: str = "body_len", relative_error: float = 0.3) -> tuple:
    """Spark's Greenwald-Khanna sketch with the given relative error (compat).

    With error 0.3 the sketch may return the minimum for Q1 and the maximum
    for Q3; exact cuts are the default for that reason.
    """
    return tuple(df.stat.approxQuantile(value, list(QUARTILES), relative_error))


def collect_cuts(cuts: DataFrame) -> tuple:
    """The three cut values of a one-row cuts frame (three numbers)."""
    row = cuts.select(*CUT_NAMES).first()
    return tuple(row) if row is not None else (None, None, None)


def quartile_bin(value: Column, cuts: Sequence[float | None]) -> Column:
    """The quartile bin of a value: ``<=q1``, ``<=q2``, ``<=q3``, else ``Q3``.

    A null or NaN value has no bin (null), which the counting operators fill
    like any other missing attribute.
    """
    q1, q2, q3 = (F.lit(None).cast("double") if q is None else F.lit(float(q)) for q in cuts)
    return (
        F.when(value.isNull() | F.isnan(value), F.lit(None).cast("string"))
        .when(value <= q1, F.lit(BIN_LABELS[0]))
        .when(value <= q2, F.lit(BIN_LABELS[1]))
        .when(value <= q3, F.lit(BIN_LABELS[2]))
        .otherwise(F.lit(BIN_LABELS[3]))
    )


def bin_quartiles(df: DataFrame, cuts: Sequence[float | None], value: str = "body_len", out: str = "review_body") -> DataFrame:
    """``df`` with the quartile bin of ``value`` as column ``out``.

    The cuts are literals in the expression (no join), so the binning is a
    projection inside the scan stage.
    """
    return df.withColumn(out, quartile_bin(F.col(value), cuts))
