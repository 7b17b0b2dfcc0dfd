"""Reduced-error pruning against a plain recursion over the tree."""

import random

import pytest

from canopy.operators.prune import prune, reached
from canopy.operators.tree import grow_tree

ATTRS = ("a", "b", "c")
SCHEMA = "a string, b string, c string, label boolean"


def drawn(n, seed, noise):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c = draw.choice("xyz"), draw.choice("uvw"), draw.choice("klm")
        rows.append((a, b, c, (a == "x" or (a == "y" and b == "u")) != (draw.random() < noise)))
    return rows


def slow_prune(nodes, rows):
    """(kept node -> whether it was cut, errors of the root) by recursion."""
    children = {}
    for r in nodes.values():
        children.setdefault(r.parent_id, {})[r.edge_value] = r.node_id

    def fold(node_id, own):
        node = nodes[node_id]
        as_leaf = sum(r[-1] != node.label for r in own)
        if node.split_attr is None:
            return as_leaf, {node_id: False}
        at, subtree, kept = ATTRS.index(node.split_attr), 0, {node_id: False}
        mine = children.get(node_id, {})
        for value, child in mine.items():
            errors, below = fold(child, [r for r in own if r[at] == value])
            subtree += errors
            kept |= below
        subtree += sum(r[-1] != node.label for r in own if r[at] not in mine)
        return (as_leaf, {node_id: True}) if as_leaf <= subtree else (subtree, kept)

    return fold("root", rows)


@pytest.mark.parametrize("noise", [0.0, 0.25])
@pytest.mark.parametrize("limit", [None, 0])
def test_against_recursion(spark, noise, limit):
    train, test = drawn(150, 1, noise), [*drawn(120, 2, noise), ("new", "u", "k", True), ("x", "new", "k", False)]
    tree = grow_tree(spark.createDataFrame(train, SCHEMA), ATTRS, "label")
    df = spark.createDataFrame([(*r[:3], int(r[3]), int(not r[3])) for r in test], "a string, b string, c string, pos long, neg long")
    nodes = {r.node_id: r for r in tree.collect()}
    pruned = {r.node_id: r for r in prune(tree, df, ATTRS, broadcast_limit=limit).collect()}
    errors, kept = slow_prune(nodes, test)
    assert {i: r.kind == "pruned" for i, r in pruned.items()} == kept
    assert pruned["root"].errors == errors
    assert all((r.split_attr is None) == (r.kind != "split") for r in pruned.values())
    assert pruned["root"].reach_pos + pruned["root"].reach_neg == len(test)
    assert all((r.pos, r.neg, r.label) == (nodes[i].pos, nodes[i].neg, nodes[i].label) for i, r in pruned.items())


def test_no_pruning_rows_leave_a_leaf(spark):
    tree = grow_tree(spark.createDataFrame(drawn(60, 3, 0.1), SCHEMA), ATTRS, "label")
    none = spark.createDataFrame([], "a string, b string, c string, pos long, neg long")
    assert reached(none, tree, ATTRS).collect() == []
    rows = prune(tree, none, ATTRS).collect()
    assert [(r.node_id, r.kind, r.errors) for r in rows] == [("root", "pruned", 0)]
