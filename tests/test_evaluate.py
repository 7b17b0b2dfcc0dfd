"""Evaluation by class against counts by hand."""

import pytest

from canopy.operators.evaluate import class_report

SCHEMA = "is_vote_helpful boolean, prediction string, hits int"


def report(spark, rows):
    return {r["class"]: tuple(r)[1:] for r in class_report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}


def test_counts_and_ratios_with_nulls(spark):
    rows = [(True, "true", 0)] * 3 + [(True, "false", 0), (False, "true", 0), (False, "false", 0)]
    rows += [(None, "false", 0), (None, "true", 0), (True, None, 0)]
    got = report(spark, rows)
    assert got["true"][:3] == (5, 5, 3) and got["false"][:3] == (4, 4, 2)
    assert got["true"][3:] == pytest.approx((0.6, 0.6, 0.6)) and got["false"][3:] == pytest.approx((0.5, 0.5, 0.5))


def test_a_class_without_rows_and_no_rows(spark):
    got = report(spark, [(True, "true", 0)])
    assert got == {"true": (1, 1, 1, 1.0, 1.0, 1.0), "false": (0, 0, 0, None, None, None)}
    assert report(spark, []) == {c: (0, 0, 0, None, None, None) for c in ("true", "false")}
