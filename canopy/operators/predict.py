"""Applying a node table to rows.

Each row starts at the root; one round per tree level looks the row's
current node up in the tree (a broadcast hash join when the tree's size --
measured in bytes -- is under the session's broadcast limit, so the
rounds run inside one map-only stage) and computes the id of the child its
own attribute value leads to.  A row whose value was never seen under that
node simply finds no match in the next round and keeps the majority label
of the deepest node it reached; no row loops or is dropped.

A tree too large to broadcast would turn every round into a shuffle of all
rows.  For batch input the walk then runs over the rows' distinct attribute
combinations instead (a partially aggregated, usually tiny table), and the
rows are joined back to their combination's result once -- broadcast if the
bytes of the combinations fit, otherwise one shuffle join whose hot keys AQE
splits.  Streaming input always walks directly (stateless stream-static joins).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.functions.columns import child_id, value_of
from canopy.operators._lineage import broadcast_bytes, durable
from canopy.operators.prepare import ATTRIBUTES, FILL_TOKEN
from canopy.operators.tree import ROOT_ID


def predict(
    df: DataFrame,
    tree: DataFrame,
    attrs: Sequence[str] = ATTRIBUTES,
    *,
    prediction: str = "prediction",
    broadcast_limit: int | None = None,
    token: str = FILL_TOKEN,
    strategy: str = "auto",
) -> DataFrame:
    """``df`` plus ``prediction`` ('true'/'false'), ``leaf_id``,
    ``matched_depth`` and ``reached_leaf`` (false when an unseen value
    stopped the walk at an inner node).  Columns of ``df`` with one of these
    four names are replaced; other names are free to use.

    ``strategy``: ``'walk'`` (rows walk the tree), ``'combos'`` (distinct
    attribute combinations walk it, rows join back) or ``'auto'`` (walk when
    the tree can be broadcast or the input is a stream, else combos).
    """
    attrs = list(attrs)
    spark = df.sparkSession
    outputs = {prediction.lower(), "leaf_id", "matched_depth", "reached_leaf"}
    if outputs & {a.lower() for a in attrs}:
        raise ValueError("an attribute has the name of an output column")
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in outputs])
    small = tree.select("node_id", "split_attr", "label", "depth")
    # size (for the broadcast check), depth and the root row, in one small job
    stats = small.agg(
        F.sum(F.octet_length("node_id") + F.coalesce(F.octet_length("split_attr"), F.lit(0)) + F.lit(64)).alias("bytes"),
        F.max("depth").alias("d"),
        F.max(F.when(F.col("node_id") == F.lit(ROOT_ID), F.struct("split_attr", "label"))).alias("root"),
    ).first()
    size, max_depth, root = stats["bytes"], stats["d"], stats["root"]
    if root is None:  # empty tree: nothing learned, predict the default class
        return df.select(
            "*",
            F.lit("false").alias(prediction),
            F.lit(None).cast("string").alias("leaf_id"),
            F.lit(None).cast("int").alias("matched_depth"),
            F.lit(False).alias("reached_leaf"),
        )
    limit = broadcast_bytes(spark, broadcast_limit)
    state = _free_name(df, "_walk")
    lookup = small.select(F.struct("node_id", "split_attr", "label", "depth").alias(_free_name(df, "_tree")))
    if size <= limit:
        lookup = F.broadcast(lookup)
    if strategy == "auto":
        strategy = "walk" if (size <= limit or df.isStreaming) else "combos"
    if strategy == "combos":
        return _predict_by_combinations(df, lookup, root, max_depth, attrs, prediction, limit, token, state)
    return _walk(df, lookup, root, max_depth, attrs, prediction, token, state)


def _free_name(df: DataFrame, stem: str) -> str:
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def _predict_by_combinations(df, lookup, root, max_depth, attrs, prediction, limit, token, state) -> DataFrame:
    key = _free_name(df, "_key")
    combination = F.struct(*[F.coalesce(F.col(a).cast("string"), F.lit(token)).alias(a) for a in attrs])
    keyed = df.withColumn(key, combination)
    combos, _ = durable(keyed.select(f"{key}.*").distinct())
    width = sum((F.octet_length(a) for a in attrs), F.lit(96))
    size = combos.agg(F.sum(width)).first()[0] or 0
    walked = _walk(combos, lookup, root, max_depth, attrs, prediction, token, state)
    outputs = [prediction, "leaf_id", "matched_depth", "reached_leaf"]
    walked = walked.select(F.struct(*attrs).alias(key), F.struct(*outputs).alias(state))
    if size <= limit:
        walked = F.broadcast(walked)
    joined = keyed.join(walked, key)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"{state}.{c}").alias(c) for c in outputs])


def _walk(df, lookup, root, max_depth, attrs, prediction, token, state) -> DataFrame:
    # The root is the same for every row, so it is applied as literals; the
    # walk's joins then always key on a per-row child id (an equi-join, never
    # a nested loop on a constant).  The state of the walk is one struct under a
    # name the input doesn't have.
    node = lookup.columns[0]
    root_split = root["split_attr"]
    first = (
        child_id(F.lit(ROOT_ID), F.lit(root_split), F.coalesce(value_of(F.lit(root_split), attrs), F.lit(token)))
        if root_split is not None
        else F.lit(None).cast("string")
    )
    keep = [F.col(f"`{c}`") for c in df.columns]

    def at(cur, node_id, split, label, depth):
        return F.struct(
            cur.alias("cur"), node_id.alias("node"), split.alias("split"), label.alias("label"), depth.alias("depth")
        ).alias(state)

    out = df.select(
        *keep,
        at(first, F.lit(ROOT_ID), F.lit(root_split).cast("string"), F.lit(root["label"]).cast("boolean"), F.lit(0)),
    )
    for _ in range(max_depth or 0):
        old, new = F.col(state), F.col(node)
        hit = new["node_id"].isNotNull()
        step = out.join(lookup, old["cur"] == new["node_id"], "left")
        value = F.coalesce(value_of(new["split_attr"], attrs), F.lit(token))
        out = step.select(
            *keep,
            at(
                F.when(hit & new["split_attr"].isNotNull(), child_id(old["cur"], new["split_attr"], value)),
                F.when(hit, new["node_id"]).otherwise(old["node"]),
                F.when(hit, new["split_attr"]).otherwise(old["split"]),
                F.when(hit, new["label"]).otherwise(old["label"]),
                F.when(hit, new["depth"]).otherwise(old["depth"]),
            ),
        )
    end = F.col(state)
    return out.select(
        *keep,
        F.when(F.coalesce(end["label"], F.lit(False)), F.lit("true")).otherwise(F.lit("false")).alias(prediction),
        end["node"].alias("leaf_id"),
        end["depth"].alias("matched_depth"),
        end["split"].isNull().alias("reached_leaf"),
    )
