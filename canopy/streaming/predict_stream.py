"""Predicting on a Structured Streaming DataFrame.

Prediction is stateless: each micro-batch is walked through the (static,
size-checked, broadcast) node table with stream-static left joins, exactly
as in batch.  ``running_error`` keeps the error count as ordinary
streaming aggregation state (two numbers per group), suitable for
``outputMode('update')`` or ``'complete'``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.functions.columns import squared_error
from canopy.operators.discretize import bin_quartiles
from canopy.operators.predict import predict
from canopy.operators.prepare import ATTRIBUTES, LABEL


def predict_stream(
    stream: DataFrame,
    tree: DataFrame,
    attrs: Sequence[str] = ATTRIBUTES,
    *,
    cuts: Sequence[float] | None = None,
    value: str = "body_len",
    binned: str = "review_body",
) -> DataFrame:
    """Streaming rows → rows plus ``prediction`` (and walk diagnostics).

    If ``cuts`` is given, ``value`` is binned into ``binned`` first, with the
    cuts fixed in advance (a stream has no "whole side" to take quartiles of).
    """
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame; use canopy.predict for batch data")
    rows = bin_quartiles(stream, cuts, value, binned) if cuts is not None else stream
    return predict(rows, tree, attrs)


def running_error(predicted: DataFrame, label: str = LABEL, by: Sequence[str] = ()) -> DataFrame:
    """Running ``n_rows``, ``errors`` and ``mse`` per group of ``by``."""
    err = squared_error(label, "prediction")
    return predicted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(err).alias("errors"),
        F.avg(err).alias("mse"),
    )
