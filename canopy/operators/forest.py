"""Bagged trees: each tree learns from its own bootstrap of the rows.

How often a row counts in a tree is drawn from ``md5(key|tree)`` as a Poisson
number of mean 1, the limit of drawing as many rows as there are with
replacement.  It depends on nothing but the key and the tree's number, so any
partitioning and any lost executor give the same forest.

* **One pass over the rows.**  Rows are summed into weighted cells per (tree,
  attributes): a task hashes the keys of a chunk of rows for all trees at once and
  sums the chunk by combination, and the map-side combine leaves at most one row per
  tree and combination in a task, however many rows there are.
* **One level loop for all trees.**  Roots are ``'root#<tree>'``, so the ids of
  all nodes differ and ``tree.grow_levels`` grows every tree at once: no more
  jobs a level than for one tree.
* **Votes by combination.**  Equal attributes get equal votes, so the distinct
  combinations of the rows walk the trees and the rows are joined back once.

Defined results: a null key counts as the empty text, and rows of one key count
equally often in a tree; a tree that drew no row has no node and no vote; a value
unseen under a node votes for that node's majority; equally many votes for both
classes, or none, predict false; columns of the input with the names of the
outputs are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.functions.columns import child_id, value_of
from canopy.functions.hashing import md5_numbers
from canopy.operators._lineage import broadcast_bytes, durable
from canopy.operators.predict import _free_name
from canopy.operators.prepare import ATTRIBUTES, FILL_TOKEN, LABEL
from canopy.operators.tree import ROOT_ID, TREE_COLUMNS, _empty_root, grow_levels

N_TREES = 16
#: Weights are drawn in millionths.
DRAWS = 1_000_000
#: A task sums its rows in chunks of about so many rows, or bytes.
CHUNK_ROWS, CHUNK_BYTES = 200_000, 32 << 20


def poisson_steps(draws: int = DRAWS) -> list[int]:
    """A draw below ``draws`` has the weight of the number of steps it reaches: Poisson of mean 1."""
    steps, chance, below = [], math.exp(-1), 0.0
    while True:
        below += chance
        step = math.floor(below * draws)
        if steps and step == steps[-1]:
            return steps
        steps.append(step)
        chance /= len(steps)


def bootstrap_cells(
    rows: DataFrame,
    key: str,
    n_trees: int = N_TREES,
    attrs: Sequence[str] = ATTRIBUTES,
    label: str = LABEL,
    token: str = FILL_TOKEN,
) -> DataFrame:
    """``tree, attrs..., pos, neg``: weighted class counts of each tree's bootstrap."""
    if n_trees < 1:
        raise ValueError("a forest has at least one tree")
    own = [F.coalesce(F.col(a).cast("string"), F.lit(token)).alias(f"a{i}") for i, a in enumerate(attrs)]
    truth = F.coalesce(F.col(label).cast("boolean"), F.lit(False))
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    narrow = rows.select(text.alias("key"), truth.alias("truth"), *own)
    columns = [f"a{i}" for i in range(len(attrs))]
    chunked = ", ".join(["pos array<bigint>", "neg array<bigint>", *[f"{c} string" for c in columns]])
    summed = narrow.mapInArrow(_chunk_sums(n_trees), chunked)
    # under names of their own, so that no attribute can clash with them
    each = F.posexplode(F.arrays_zip("pos", "neg")).alias("tree", "_counts")
    dealt = summed.select(F.struct(*columns).alias("_attrs"), each)
    counted = dealt.where("_counts.pos > 0 or _counts.neg > 0").groupBy("tree", "_attrs")
    sums = counted.agg(F.sum("_counts.pos").alias("pos"), F.sum("_counts.neg").alias("neg"))
    return sums.select("tree", *[F.col(f"_attrs.a{i}").alias(a) for i, a in enumerate(attrs)], "pos", "neg")


def _chunk_sums(n_trees: int):
    """Batches of ``key, truth, attrs...`` to one row a chunk and combination: its weights in each tree by class."""

    def sums(table: pa.Table) -> pa.RecordBatch:
        key = pa.compute.cast(table["key"], pa.large_binary()).combine_chunks()
        offsets = np.frombuffer(key.buffers()[1], np.int64)[key.offset : key.offset + len(key) + 1]
        data = np.frombuffer(key.buffers()[2] or b"", np.uint8)
        drawn = md5_numbers(offsets, data, [f"|{t}".encode() for t in range(n_trees)])
        combo, first = np.zeros(len(key), np.int64), np.zeros(1, np.int64)
        for name in table.schema.names[2:]:
            coded = table[name].combine_chunks().dictionary_encode()
            combo = combo * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False)
            # numbered anew by each column, so the product stays small
            _, first, combo = np.unique(combo, return_index=True, return_inverse=True)
        truth = table["truth"].combine_chunks().to_numpy(zero_copy_only=False)
        steps, n = np.array(poisson_steps()), len(first)
        counts = np.empty((2 * n, n_trees), np.int64)
        for tree, number in enumerate(drawn):
            weight = np.searchsorted(steps, number % DRAWS, side="right")
            counts[:, tree] = np.bincount(combo + n * ~truth, weight, 2 * n)
        ends = pa.array(np.arange(n + 1, dtype=np.int32) * n_trees)
        lists = [pa.ListArray.from_arrays(ends, pa.array(part.ravel())) for part in (counts[:n], counts[n:])]
        kept = table.select(table.schema.names[2:]).take(pa.array(first)).combine_chunks()
        values = [c.combine_chunks() for c in kept.columns]
        return pa.RecordBatch.from_arrays([*lists, *values], names=["pos", "neg", *kept.schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in batches:
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= CHUNK_ROWS or size >= CHUNK_BYTES:
                yield sums(pa.Table.from_batches(held))
                held, rows, size = [], 0, 0
        if rows:
            yield sums(pa.Table.from_batches(held))

    return run


def grow_forest(
    train: DataFrame,
    key: str,
    n_trees: int = N_TREES,
    attrs: Sequence[str] = ATTRIBUTES,
    label: str = LABEL,
    *,
    force_root: bool = True,
    broadcast_limit: int | None = None,
    token: str = FILL_TOKEN,
) -> DataFrame:
    """The node table of ``n_trees`` trees: ``tree`` and the columns of ``grow_tree``, counts weighted."""
    attrs = list(attrs)
    bad = [a for a in attrs if "=" in a or "|" in a or a.lower() in ("tree", "pos", "neg")]
    if bad or len({a.lower() for a in attrs}) != len(attrs):
        raise ValueError(f"attribute names must be distinct, not tree, pos or neg, and contain no '=' or '|': {bad or attrs}")
    drawn = bootstrap_cells(train, key, n_trees, attrs, label, token)
    start = drawn.withColumn("node_id", F.concat(F.lit(f"{ROOT_ID}#"), F.col("tree").cast("string")))
    forest = grow_levels(start, attrs, force_root=force_root, broadcast_limit=broadcast_limit, keep=["tree"])
    if forest is None:
        none = _empty_root(train.sparkSession).where("false")
        return none.select(F.lit(0).alias("tree"), *TREE_COLUMNS)
    return forest


def forest_votes(
    combos: DataFrame, forest: DataFrame, attrs: Sequence[str] = ATTRIBUTES, broadcast_limit: int | None = None
) -> DataFrame:
    """``attrs..., votes, n_votes`` of distinct attribute combinations: trees that say true, and trees that vote."""
    attrs = list(attrs)
    size, depth = forest.agg(
        F.sum(F.octet_length("node_id") + F.coalesce(F.octet_length("split_attr"), F.lit(0)) + F.lit(64)), F.max("depth")
    ).first()
    roots = forest.where("depth = 0").select("node_id", "split_attr", "label").collect()  # one row a tree
    if not roots:
        return combos.select(*attrs, F.lit(0).cast("bigint").alias("votes"), F.lit(0).cast("bigint").alias("n_votes"))
    below = forest.where("depth > 0").select(
        F.col("node_id").alias("_node"), F.col("split_attr").alias("_next"), F.col("label").alias("_label")
    )
    if size <= broadcast_bytes(combos.sparkSession, broadcast_limit):
        below = F.broadcast(below)
    state = [
        F.struct(F.lit(r.node_id).alias("cur"), F.lit(r.split_attr).cast("string").alias("split"), F.lit(r.label).alias("label"))
        for r in roots
    ]
    out = combos.select(*attrs, F.explode(F.array(*state)).alias("_walk"))
    for _ in range(depth):
        at = F.col("_walk")
        # null where the walk has ended: it meets nothing and keeps its label
        out = out.withColumn("_to", child_id(at["cur"], at["split"], value_of(at["split"], attrs)))
        met = out.join(below, F.col("_to") == F.col("_node"), "left")
        out = met.select(
            *attrs,
            F.struct(
                F.col("_to").alias("cur"), F.col("_next").alias("split"), F.coalesce(F.col("_label"), at["label"]).alias("label")
            ).alias("_walk"),
        )
    said = F.col("_walk.label")
    return out.groupBy(*attrs).agg(F.count_if(said).alias("votes"), F.count(said).alias("n_votes"))


def predict_forest(
    df: DataFrame,
    forest: DataFrame,
    attrs: Sequence[str] = ATTRIBUTES,
    *,
    prediction: str = "prediction",
    broadcast_limit: int | None = None,
    token: str = FILL_TOKEN,
) -> DataFrame:
    """``df`` (batch) plus ``prediction`` ('true'/'false'), ``votes`` for true and ``n_votes``."""
    attrs = list(attrs)
    outputs = [prediction, "votes", "n_votes"]
    if {o.lower() for o in outputs} & {a.lower() for a in attrs}:
        raise ValueError("an attribute has the name of an output column")
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in {o.lower() for o in outputs}])
    key, found = _free_name(df, "_key"), _free_name(df, "_votes")
    keyed = df.withColumn(key, F.struct(*[F.coalesce(F.col(a).cast("string"), F.lit(token)).alias(a) for a in attrs]))
    combos, _ = durable(keyed.select(f"{key}.*").distinct())
    voted, _ = durable(forest_votes(combos, forest, attrs, broadcast_limit))
    size = voted.agg(F.sum(sum((F.octet_length(a) for a in attrs), F.lit(96)))).first()[0] or 0
    voted = voted.select(F.struct(*attrs).alias(key), F.struct("votes", "n_votes").alias(found))
    if size <= broadcast_bytes(df.sparkSession, broadcast_limit):
        voted = F.broadcast(voted)
    most = F.col(found)["votes"] * 2 > F.col(found)["n_votes"]
    return keyed.join(voted, key).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.when(most, F.lit("true")).otherwise(F.lit("false")).alias(prediction),
        F.col(found)["votes"].alias("votes"),
        F.col(found)["n_votes"].alias("n_votes"),
    )
