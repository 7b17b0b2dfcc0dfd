
import pytest
from pyspark.sql import functions as F

from canopy.operators.predict import predict
from canopy.plans.fixtures import fixture_d, fixture_l
from canopy.plans.end_to_end import binned_sides, evaluate, train_tree

from .conftest import SF001, SF01


@pytest.mark.parametrize(
    "fixture,levels,kinds,stuck,mse",
    [
        (fixture_d, [1, 4, 63, 153, 134, 4], {"split": 104, "pure": 189, "zero_gain": 66}, 18, 0.340425532),
        (fixture_l, [1, 4, 18, 77, 262, 596], {"split": 360, "exhausted": 596, "zero_gain": 2}, 0, 0.393088912),
    ],
)
def test_golden(spark, fixture, levels, kinds, stuck, mse):
    s = binned_sides(fixture(spark, SF01))
    tree = train_tree(s)
    got_levels = [r[1] for r in sorted(tree.groupBy("depth").count().collect())]
    assert got_levels == levels
    assert {r[0]: r[1] for r in tree.groupBy("kind").count().collect()} == kinds
    assert round(evaluate(s, tree).first()["mse"], 9) == mse
    p = predict(s.test, tree)
    assert p.where(~F.col("reached_leaf")).count() == stuck
    rowwise = p.agg(F.avg((F.col("prediction") != F.col("is_vote_helpful").cast("string")).cast("double"))).first()[0]
    assert round(rowwise, 9) == mse


def test_entry_smoke(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    df = entry(spark)
    assert df.columns == ["doc_id", "prediction", "matched_depth", "reached_leaf"]
    assert df.count() >= 0
    assert set(oracle_sql()) <= set(queries())


def test_train_cuts_option(spark):
    fx = fixture_d(spark, SF001)
    per_side = binned_sides(fx)
    shared = binned_sides(fx, cuts="train")
    assert shared.test_cuts == shared.train_cuts == per_side.train_cuts
    # test cells with the training cuts cover exactly the test rows
    n_rows = shared.test.count()
    assert shared.test_cells.agg(F.sum(F.col("pos") + F.col("neg"))).first()[0] == n_rows
    binned = {r.review_body for r in shared.test.select("review_body").distinct().collect()}
    assert binned <= {"(0,Q1]", "(Q1,Q2]", "(Q2,Q3]", "Q3"}
