"""Bagged trees against single trees on the same bootstraps, drawn in plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from canopy.operators.forest import DRAWS, bootstrap_cells, forest_votes, grow_forest, poisson_steps, predict_forest
from canopy.operators.predict import predict
from canopy.operators.tree import TREE_COLUMNS, grow_tree

ATTRS = ("a", "b", "c")
SCHEMA = "key string, a string, b string, c string, y boolean"


def drawn(n, seed, hot=0.0):
    """Rows; a share ``hot`` of them has one combination, every 20th value or label is null."""
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        a, b, c = ("x", "u", "k") if draw.random() < hot else (draw.choice("xyz"), draw.choice("uvw"), draw.choice("klm"))
        y = (a == "x" or (a == "y" and b == "u")) != (draw.random() < 0.2)
        rows.append((f"k{k}", None if k % 20 == 7 else a, b, c, None if k % 20 == 13 else y))
    return rows


def weight(key, tree):
    number = int(hashlib.md5(f"{key or ''}|{tree}".encode()).hexdigest()[:8], 16) % DRAWS
    return sum(number >= step for step in poisson_steps())


def test_steps_are_poisson():
    steps = [0, *poisson_steps(), DRAWS]
    for k, (low, high) in enumerate(zip(steps, steps[1:])):
        assert abs((high - low) / DRAWS - math.exp(-1) / math.factorial(k)) < 2e-6


def test_cells_are_weighted_sums(spark):
    rows = drawn(200, 1, hot=0.4) + [(None, "x", "u", "k", True)] * 3
    want = {}
    for key, a, b, c, y in rows:
        for t in range(5):
            w = weight(key, t)
            if w:
                at = want.setdefault((t, a or "false", b, c), [0, 0])
                at[0 if y else 1] += w
    for parts in (1, 7):  # any partitioning gives the same bootstraps
        got = bootstrap_cells(spark.createDataFrame(rows, SCHEMA).repartition(parts), "key", 5, ATTRS, "y").collect()
        assert {(r.tree, r.a, r.b, r.c): [r.pos, r.neg] for r in got} == want


@pytest.mark.parametrize("limit", [None, 0])
def test_each_tree_is_the_tree_of_its_bootstrap(spark, limit):
    rows, test = drawn(150, 2, hot=0.35), [*drawn(60, 3), ("t", "new", "u", "k", True), ("t", "x", "new", None, False)]
    n = 5 if limit is None else 2
    forest = grow_forest(spark.createDataFrame(rows, SCHEMA), "key", n, ATTRS, "y", broadcast_limit=limit)
    assert forest.columns == ["tree", *TREE_COLUMNS]
    df = spark.createDataFrame(test, SCHEMA).withColumn("at", F.monotonically_increasing_id())
    votes = {}
    for t in range(n):
        own = [r for r in rows for _ in range(weight(r[0], t))]
        single = grow_tree(spark.createDataFrame(own, SCHEMA), ATTRS, "y")
        shape = ("rule", "depth", "split_attr", "pos", "neg", "kind", "label")
        assert sorted(map(tuple, forest.where(F.col("tree") == t).select(*shape).collect()), key=str) == sorted(
            map(tuple, single.select(*shape).collect()), key=str
        )
        for r in predict(df, single, ATTRS).collect():
            votes[r["at"]] = votes.get(r["at"], 0) + (r.prediction == "true")
    got = predict_forest(df, forest, ATTRS, broadcast_limit=limit).collect()
    assert {r["at"]: r.votes for r in got} == votes
    assert all(r.n_votes == n and r.prediction == str(2 * r.votes > n).lower() for r in got)


def test_ties_clashing_names_and_trees_without_rows(spark):
    one = spark.createDataFrame([("k", "x", "u", "k", True)], SCHEMA)
    forest = grow_forest(one, "key", 12, ATTRS, "y")
    voting = sum(weight("k", t) > 0 for t in range(12))
    assert 0 < voting < 12 and forest.select("tree").distinct().count() == voting
    clash = one.selectExpr("*", "7 as votes", "8 as n_votes", "'p' as prediction", "1 as _key", "2 as _votes", "3 as tree")
    got = predict_forest(clash, forest, ATTRS).first()
    assert (got.votes, got.n_votes, got.prediction, got._key, got._votes, got.tree) == (voting, voting, "true", 1, 2, 3)
    tie = forest.withColumn("label", F.col("tree") % 2 == 0)
    chosen = [t for t in range(12) if weight("k", t)]
    even, odd = [t for t in chosen if t % 2 == 0], [t for t in chosen if t % 2]
    pair = tie.where(F.col("tree").isin(even[0], odd[0]))
    got = predict_forest(one, pair.withColumn("split_attr", F.lit(None).cast("string")), ATTRS).first()
    assert (got.votes, got.n_votes, got.prediction) == (1, 2, "false")


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    empty = grow_forest(none, "key", 3, ATTRS, "y")
    assert empty.columns == ["tree", *TREE_COLUMNS] and empty.count() == 0
    some = spark.createDataFrame(drawn(30, 4), SCHEMA)
    assert {(r.prediction, r.votes, r.n_votes) for r in predict_forest(some, empty, ATTRS).collect()} == {("false", 0, 0)}
    assert predict_forest(none, grow_forest(some, "key", 3, ATTRS, "y"), ATTRS).collect() == []
    with pytest.raises(ValueError):
        grow_forest(some, "key", 0, ATTRS, "y")
    with pytest.raises(ValueError):
        grow_forest(some.withColumnRenamed("a", "tree"), "key", 3, ("tree", "b"), "y")


def test_more_trees_take_no_more_jobs(spark):
    sc, df = spark.sparkContext, spark.createDataFrame(drawn(400, 5), SCHEMA)

    def jobs(n_trees):
        group = f"forest-{n_trees}"
        sc.setJobGroup(group, group)
        depth = grow_forest(df, "key", n_trees, ATTRS, "y").agg(F.max("depth")).first()[0]
        n = len(sc.statusTracker().getJobIdsForGroup(group))
        sc.setJobGroup("", "")
        return depth, n

    (one_depth, one), (depth, many) = jobs(1), jobs(16)
    assert depth == one_depth == 3 and many <= one + 4


def test_no_nested_loops(spark):
    some = spark.createDataFrame(drawn(80, 6), SCHEMA)
    forest = grow_forest(some, "key", 4, ATTRS, "y")
    plan = forest_votes(some.select(*ATTRS).distinct(), forest, ATTRS)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_key_is_hashed_once_a_tree(spark):
    from canopy.functions.hashing import md5_numbers

    keys = [b"", b"k", "\u00e4\u4e2d".encode(), *[bytes([65 + n % 26]) * n for n in range(48, 70)], b"z" * 300]
    offsets = [0]
    for k in keys:
        offsets.append(offsets[-1] + len(k))
    endings = [f"|{t}".encode() for t in (0, 9, 10, 100, 3)]
    got = md5_numbers(np.array(offsets), np.frombuffer(b"".join(keys), np.uint8), endings)
    for ending, numbers in zip(endings, got):
        assert numbers.tolist() == [int(hashlib.md5(k + ending).hexdigest()[:8], 16) for k in keys]
    # the filter on the weight repeated the hash for each of its steps
    cells = bootstrap_cells(spark.createDataFrame([("k", "x", "u", "k", True)], SCHEMA), "key", 3, ATTRS, "y")
    assert cells._jdf.queryExecution().executedPlan().toString().count("md5(") == 0
