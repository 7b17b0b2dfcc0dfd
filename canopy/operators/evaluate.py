"""Error measures over predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.functions.columns import squared_error
from canopy.operators.prepare import LABEL


def mean_squared_error(predicted: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """One row: ``mse`` (= error rate for a binary target) and ``n_rows``."""
    return predicted.agg(
        F.avg(squared_error(label, prediction)).alias("mse"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def class_report(predicted: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """One row per class: ``class, n_rows, n_predicted, hits, precision, recall, f1``.

    A null label or prediction counts as ``false``; a ratio of nothing is null.
    Four counts, so one row a task is shuffled; both classes are always there.
    """
    truth = F.coalesce(F.col(label), F.lit(False))
    said = F.coalesce(F.col(prediction).cast("string") == "true", F.lit(False))
    counts = predicted.agg(
        F.count_if(truth & said).alias("tp"),
        F.count_if(~truth & said).alias("fp"),
        F.count_if(truth & ~said).alias("fn"),
        F.count_if(~truth & ~said).alias("tn"),
    )
    rows = [
        F.struct(F.lit(name).alias("class"), (F.col(hits) + F.col(missed)).alias("n_rows"), (F.col(hits) + F.col(wrong)).alias("n_predicted"), F.col(hits).alias("hits"))
        for name, hits, missed, wrong in (("true", "tp", "fn", "fp"), ("false", "tn", "fp", "fn"))
    ]
    return counts.select(F.inline(F.array(*rows))).select(
        "*",
        F.try_divide("hits", "n_predicted").alias("precision"),
        F.try_divide("hits", "n_rows").alias("recall"),
        F.try_divide(F.col("hits") * 2, F.col("n_rows") + F.col("n_predicted")).alias("f1"),
    )


def prediction_truth_join(truth: DataFrame, predicted: DataFrame, key: str, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Inner join of ground truth and predictions on a unique ``key``.

    ``predict`` keeps the input columns, so usually no join is needed; this
    is for predictions produced elsewhere.  Both sides are keyed on the
    same column, so Spark shuffles each once (or broadcasts a small side).
    """
    return truth.select(key, label).join(predicted.select(key, prediction), key)
