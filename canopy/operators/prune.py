"""Reduced-error pruning: a bottom-up fold over the node table.

Rows kept aside (as class counts per combination of attributes) walk the tree, which
gives each node the pruning rows that reach it.  From the deepest level up, a node's
subtree makes the errors of its children's (already pruned) subtrees and of the rows
that stop at it because no child has their value; as a leaf it would make the
errors of its own label.  Where a leaf does no worse, the node becomes one
(``kind = 'pruned'``) and everything below goes.  A level is one join of children's
sums to their parents, so there are as many steps as levels, however many nodes.

The pruned tree never makes more errors on the pruning rows than the tree did.  A node no
pruning row reaches makes no error either way and becomes a leaf.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.functions.columns import child_id, value_of
from canopy.operators._lineage import broadcast_bytes, durable, release
from canopy.operators.prepare import ATTRIBUTES, FILL_TOKEN
from canopy.operators.tree import NODE_BYTES, ROOT_ID, TREE_COLUMNS


def reached(cells: DataFrame, tree: DataFrame, attrs: Sequence[str] = ATTRIBUTES, *, broadcast_limit: int | None = None, token: str = FILL_TOKEN) -> DataFrame:
    """``node_id, reach_pos, reach_neg``: class counts of ``cells`` (attrs..., pos, neg) at every node they pass."""
    attrs = list(attrs)
    size, deepest = tree.agg(F.sum(F.octet_length("node_id") + F.lit(NODE_BYTES)), F.max("depth")).first()
    limit = broadcast_bytes(cells.sparkSession, broadcast_limit)
    lookup = tree.select(F.col("node_id").alias("_node"), "split_attr")
    if (size or 0) <= limit:
        lookup = F.broadcast(lookup)
    filled = [F.coalesce(F.col(a).cast("string"), F.lit(token)).alias(a) for a in attrs]
    root = tree.where(F.col("node_id") == ROOT_ID).select("split_attr").first()
    here = cells.select(*filled, "pos", "neg", F.lit(ROOT_ID).alias("_node"), F.lit(root[0] if root else None).cast("string").alias("split_attr"))
    passed = [here.select("_node", "pos", "neg")]
    for _ in range(deepest or 0):
        child = child_id(F.col("_node"), F.col("split_attr"), value_of(F.col("split_attr"), attrs))
        going = here.where(F.col("split_attr").isNotNull()).select(*attrs, "pos", "neg", child.alias("_to"))
        here = going.join(lookup, F.col("_to") == F.col("_node")).select(*attrs, "pos", "neg", "_node", "split_attr")
        passed.append(here.select("_node", "pos", "neg"))
    met = reduce(DataFrame.unionAll, passed).groupBy("_node")
    return met.agg(F.sum("pos").alias("reach_pos"), F.sum("neg").alias("reach_neg")).withColumnRenamed("_node", "node_id")


def prune(tree: DataFrame, cells: DataFrame, attrs: Sequence[str] = ATTRIBUTES, **how) -> DataFrame:
    """The node table (``TREE_COLUMNS``) pruned on ``cells`` (attrs..., pos, neg), with each node's
    ``reach_pos, reach_neg`` and ``errors``, those of its subtree on the pruning rows."""
    zero = F.lit(0).cast("bigint")
    counts = [F.coalesce(F.col(c), zero).alias(c) for c in ("reach_pos", "reach_neg")]
    nodes, _ = durable(tree.join(reached(cells, tree, attrs, **how), "node_id", "left").select(*TREE_COLUMNS, *counts))
    deepest = nodes.agg(F.max("depth")).first()[0]

    def wrong(pos, neg):
        return F.when(F.col("label"), neg).otherwise(pos)

    levels: dict[int, DataFrame] = {}
    for depth in range(deepest, -1, -1):
        level = nodes.where(F.col("depth") == depth)
        if depth == deepest:
            below = level.select("*", zero.alias("_e"), zero.alias("_p"), zero.alias("_n"))
        else:
            sums = levels[depth + 1].groupBy(F.col("parent_id").alias("node_id")).agg(
                F.sum("errors").alias("_e"), F.sum("reach_pos").alias("_p"), F.sum("reach_neg").alias("_n")
            )
            below = level.join(sums, "node_id", "left").na.fill(0, ["_e", "_p", "_n"])
        as_leaf = wrong(F.col("reach_pos"), F.col("reach_neg"))
        stopped = wrong(F.col("reach_pos") - F.col("_p"), F.col("reach_neg") - F.col("_n"))
        subtree = F.when(F.col("split_attr").isNotNull(), F.col("_e") + stopped).otherwise(as_leaf)
        decided = below.withColumn("errors", F.least(as_leaf, subtree)).withColumn(
            "_cut", F.col("split_attr").isNotNull() & (as_leaf <= subtree)
        )
        levels[depth], _ = durable(decided.drop("_e", "_p", "_n"))
    # from the root down: what hangs below a pruned node goes
    kept = [levels[0]]
    for depth in range(1, deepest + 1):
        parents = kept[-1].where(~F.col("_cut") & F.col("split_attr").isNotNull()).select(F.col("node_id").alias("_parent"))
        kept.append(levels[depth].join(parents, F.col("parent_id") == F.col("_parent"), "left_semi"))
    all_kept = reduce(DataFrame.unionByName, kept)
    cut = F.col("_cut")
    changed = {
        "split_attr": F.when(~cut, F.col("split_attr")),
        "gain": F.when(~cut, F.col("gain")),
        "kind": F.when(cut, F.lit("pruned")).otherwise(F.col("kind")),
    }
    out = all_kept.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in TREE_COLUMNS], "reach_pos", "reach_neg", "errors")
    pruned, _ = durable(out)
    release(nodes, *levels.values())
    return pruned
