"""Cuts of numeric columns and mixed trees against plain recursion over the rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from canopy.operators.continuous import best_cuts, grow_mixed_tree, number, predict_mixed


def h(p, n):
    return -sum(c / (p + n) * math.log2(c / (p + n)) for c in (p, n) if c)


def clean(v):
    return -math.inf if v is None or math.isnan(v) else v


def counts(rows):
    pos = sum(bool(r[-1]) for r in rows)
    return pos, len(rows) - pos


def gain(rows, groups):
    return h(*counts(rows)) - sum(len(g) / len(rows) * h(*counts(g)) for g in groups)


def separates(rows, groups):
    p, n = counts(rows)
    return any(counts(g)[0] * (p + n) != p * len(g) for g in groups)


def slow_cut(rows, at):
    """(separates, gain, threshold) of the best cut of column ``at``, and whether any cut separates."""
    best = None
    for t in sorted({clean(r[at]) for r in rows})[:-1]:
        groups = [r for r in rows if clean(r[at]) <= t], [r for r in rows if clean(r[at]) > t]
        key = (separates(rows, groups), round(gain(rows, groups), 12), -t)
        best = key if best is None or key > best else best
    return best


def slow_tree(rows, cats, nums, max_depth, min_rows, path=(), used=(), depth=0):
    """{path: (split, threshold, pos, neg, kind)}; a path is its (column, edge) tests."""
    pos, neg = counts(rows)
    options = []
    for place, c in enumerate(cats):
        if c not in used:
            groups = [[r for r in rows if r[c] == v] for v in {r[c] for r in rows}]
            options.append((separates(rows, groups), round(gain(rows, groups), 12), -place, c, None))
    for place, c in enumerate(nums):
        cut = slow_cut(rows, c)
        if cut:
            options.append((*cut[:2], -len(cats) - place, c, -cut[2]))
    best = max(options, default=None, key=lambda o: o[:3])
    kind = "split"
    if not pos or not neg:
        kind = "pure"
    elif depth == max_depth:
        kind = "depth"
    elif pos + neg < min_rows:
        kind = "small"
    elif best is None or not best[0]:
        kind = "zero_gain"
    if kind != "split":
        return {path: (None, None, pos, neg, kind)}
    _, _, _, column, threshold = best
    out = {path: (column, threshold, pos, neg, kind)}
    edges = {}
    for r in rows:
        edge = r[column] if threshold is None else "<=" if clean(r[column]) <= threshold else ">"
        edges.setdefault(edge, []).append(r)
    for edge, own in edges.items():
        out |= slow_tree(own, cats, nums, max_depth, min_rows, (*path, (column, edge)), used + (column,) * (threshold is None), depth + 1)
    return out


def drawn(n, seed):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        x = draw.choice([None, math.nan, 1.0, 2.0, draw.gauss(0, 2), draw.gauss(0, 2), draw.gauss(0, 2)])
        y, c = float(draw.randint(0, 5)), draw.choice("abc")
        rows.append((c, draw.choice("uv"), x, y, draw.random() < (0.8 if clean(x) > 0.5 and c != "a" else 0.3)))
    return rows


SCHEMA = "c string, d string, x double, y double, label boolean"


@pytest.mark.parametrize("parts", [1, 7])
def test_best_cut_of_each_group_and_over_many_tasks(spark, parts):
    rows = drawn(300, parts) + [("z", "u", 1.0, 1.0, True)] * 3 + [("k", "u", 5.0, 2.0, True), ("k", "u", 6.0, 2.0, True)]
    df = spark.createDataFrame(rows, SCHEMA).groupBy("c", "x", "y")
    cells = df.agg(F.count_if("label").alias("pos"), F.count_if(~F.col("label")).alias("neg"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = {(r.c, r.attr): r for r in best_cuts(cells, ["x", "y"], ["c"]).collect()}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    wanted = {}
    for c in {r[0] for r in rows}:
        for name, at in (("x", 2), ("y", 3)):
            best = slow_cut([r for r in rows if r[0] == c], at)
            if best:
                wanted[c, name] = best
    assert {k: (not r.zero, -r.threshold) for k, r in found.items()} == {k: (w[0], w[2]) for k, w in wanted.items()}
    assert {k: r.gain for k, r in found.items()} == pytest.approx({k: w[1] for k, w in wanted.items()}, abs=1e-11)
    assert ("z", "x") not in found and found["k", "x"].zero
    r = found["a", "x"]
    own = [x for x in rows if x[0] == "a"]
    assert (r.left_pos, r.left_neg) == counts([x for x in own if clean(x[2]) <= r.threshold]) and (r.pos, r.neg) == counts(own)


@pytest.mark.parametrize("max_depth,min_rows", [(3, 2), (6, 30)])
def test_tree_and_prediction_against_recursion(spark, max_depth, min_rows):
    rows = drawn(250, 9)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    tree = grow_mixed_tree(df, ["c", "d"], ["x", "y"], "label", max_depth=max_depth, min_rows=min_rows)
    nodes = {r.node_id: r for r in tree.collect()}

    def path(r):
        return () if r.parent_id is None else (*path(nodes[r.parent_id]), (r.edge_attr, r.edge_value))

    at = {"c": 0, "d": 1, "x": 2, "y": 3}
    found = {tuple((at[a], e) for a, e in path(r)): (at.get(r.split_attr), r.threshold, r.pos, r.neg, r.kind) for r in nodes.values()}
    wanted = slow_tree(rows, [0, 1], [2, 3], max_depth, min_rows)
    assert found == wanted

    new = [*rows[:40], ("unseen", "u", 1.0, 1.0, True), (None, None, None, None, None)]
    asked = spark.createDataFrame([(k, *r) for k, r in enumerate(new)], f"k int, {SCHEMA}").withColumn("leaf_id", F.lit(0))
    got = {r.k: r for r in predict_mixed(asked, tree, ["c", "d"], ["x", "y"]).collect()}
    for k, r in enumerate(new):
        here = ()
        while wanted[here][0] is not None:
            column, threshold = wanted[here][:2]
            value = r[column] if threshold is not None or r[column] is not None else "false"
            edge = value if threshold is None else "<=" if clean(value) <= threshold else ">"
            if (*here, (column, edge)) not in wanted:
                break
            here = (*here, (column, edge))
        assert got[k].matched_depth == len(here)
        assert got[k].prediction == ("true" if wanted[here][2] > wanted[here][3] else "false")


def test_edges_of_the_input(spark):
    empty = grow_mixed_tree(spark.createDataFrame([], SCHEMA), ["c"], ["x"], "label").collect()
    assert [(r.kind, r.pos, r.neg) for r in empty] == [("pure", 0, 0)]
    alike = spark.createDataFrame([("a", "u", 1.0, 1.0, k % 2 == 0) for k in range(4)], SCHEMA)
    assert [r.kind for r in grow_mixed_tree(alike, ["c"], ["x"], "label").collect()] == ["zero_gain"]
    only = grow_mixed_tree(alike.withColumn("x", F.when(F.col("label"), F.lit(None)).otherwise(F.col("x"))), [], ["x"], "label").collect()
    assert sorted((r.kind, r.threshold, r.pos, r.neg) for r in only if r.kind == "pure") == [("pure", None, 0, 2), ("pure", None, 2, 0)]
    assert [r.threshold for r in only if r.kind == "split"] == [-math.inf]
    with pytest.raises(ValueError):
        grow_mixed_tree(alike, ["c"], ["c"], "label")
    assert [r[0] for r in spark.createDataFrame([(None,), (math.nan,), (2.0,)], "v double").select(number("v")).collect()] == [-math.inf, -math.inf, 2.0]


def test_products_are_compared_exactly(spark):
    from canopy.operators.continuous import PRODUCT_ROOT, _equal_products

    near, far = PRODUCT_ROOT, 1 << 61
    rows = [(2, 6, 3, 4, 6), (2, 6, 3, 5, 6), (near, near, near, near, near), (near, near, near, near - 1, near)]
    rows += [(near + 1, near + 1, near + 1, near + 1, near + 1), (far, far, far, far, far), (far, far - 1, far - 1, far - 1, far), (0, far, 0, 7, far)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint, d bigint, most bigint")
    got = df.select(_equal_products(F.col("a"), F.col("b"), F.col("c"), F.col("d"), F.col("most")).alias("same")).collect()
    assert [r.same for r in got] == [a * b == c * d for a, b, c, d, _ in rows]


def test_no_decimal_is_made_for_each_cut(spark):
    """Gains were rounded through a decimal for every distinct value."""
    cells = spark.createDataFrame([("n", 1.0, 1, 2), ("n", 2.0, 3, 0)], "node_id string, v double, pos bigint, neg bigint")
    plan = best_cuts(cells, ["v"], ["node_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan and "floor(" in plan.lower()
