"""Trees that cut numeric columns where they separate the classes best.

``best_cuts`` finds, for each group (node) and numeric column, the threshold ``t`` whose
halves ``v <= t`` and ``v > t`` have the highest information gain, over *all*
distinct values.  Class counts per distinct value are dealt out by ranges of
(group, column, value), so one group that owns all rows is cut over many tasks;
each task's contiguous part is summed, the few part sums are added up, and a running
sum inside a part on top of that gives every cut's left counts.  No group is ever
sorted in one task.

``grow_mixed_tree`` grows a tree level by level, all nodes of a level at once, over
categorical columns (one child a value, used once on a path) and numeric ones (two
children, used as often as they help).  A column that separates the classes at all
(exact integer test) comes before one that doesn't, then the gain to 12 decimals
decides, then the order in which columns are listed; equal cuts: the least threshold.

Defined results: a null or NaN value is missing and sorts before all others, so it goes
with the low side (threshold ``-Infinity`` cuts off just the missing ones); a null
category becomes ``token``; a null label counts as false.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canopy.functions.columns import child_id, entropy, value_of
from canopy.operators._lineage import broadcast_bytes, durable, release
from canopy.operators.contingency import cells as build_cells
from canopy.operators.prepare import FILL_TOKEN, LABEL
from canopy.operators.tree import NODE_BYTES, ROOT_ID

LOW, HIGH = "<=", ">"
GAIN_DIGITS = 12
BIG = "decimal(38,0)"
#: Products of numbers up to this one fit 64 bits.
PRODUCT_ROOT = 3_037_000_499

MIXED_COLUMNS = (
    "node_id", "parent_id", "depth", "edge_attr", "edge_value", "split_attr", "threshold", "gain", "pos", "neg", "kind", "label",
)


def number(c: str):
    """A numeric column as double; null and NaN as what sorts before all numbers."""
    v = F.col(c).cast("double")
    return F.when(v.isNull() | F.isnan(v), F.lit(float("-inf"))).otherwise(v)


def _gain(left_pos, left_neg, pos, neg):
    right_pos, right_neg = pos - left_pos, neg - left_neg
    left, right = (left_pos + left_neg).cast("double"), (right_pos + right_neg).cast("double")
    below = left * entropy(left_pos, left_neg) + right * entropy(right_pos, right_neg)
    return entropy(pos, neg) - F.try_divide(below, (pos + neg).cast("double"))


def _equal_products(a, b, c, d, most):
    """Whether ``a * b == c * d``, exactly; none of the four is above ``most``."""
    small = F.when(most <= PRODUCT_ROOT, a * b == c * d)
    return small.otherwise(a.cast(BIG) * b.cast(BIG) == c.cast(BIG) * d.cast(BIG))


def best_cuts(cells: DataFrame, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by..., attr, threshold, gain, left_pos, left_neg, pos, neg, n_values, zero`` from rows of ``by..., values..., pos, neg``.

    A column with one distinct value in a group has no cut and no row.
    """
    by = list(by)
    numbers = cells.select(*by, *[number(v).alias(v) for v in values], "pos", "neg")
    long = numbers.unpivot([*by, "pos", "neg"], list(values), "attr", "_v").groupBy(*by, "attr", "_v")
    long = long.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    order = [*by, "attr", "_v"]
    # the part is stored with the row: a later read may cut the files differently
    ranged, _ = durable(long.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    key = [*by, "attr"]
    parts = ranged.groupBy(*key, "_part").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"), F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(*key)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *key,
        "_part",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before{c}") for c in ("_p", "_n")],
        *[F.sum(c).over(whole).alias(f"_all{c}") for c in ("_p", "_n", "_c")],
    )
    inside = Window.partitionBy(*key, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = ranged.join(parts, [*key, "_part"]).select(
        *key,
        "_v",
        (F.col("_before_p") + F.sum("pos").over(inside)).alias("left_pos"),
        (F.col("_before_n") + F.sum("neg").over(inside)).alias("left_neg"),
        F.col("_all_p").alias("pos"),
        F.col("_all_n").alias("neg"),
        F.col("_all_c").alias("n_values"),
    )
    left, total = F.col("left_pos") + F.col("left_neg"), F.col("pos") + F.col("neg")
    cuts = run.where(left < total)  # the greatest value leaves nothing above
    same = _equal_products(F.col("left_pos"), total, F.col("pos"), left, total)
    gain = _gain(F.col("left_pos"), F.col("left_neg"), F.col("pos"), F.col("neg"))
    cuts = cuts.withColumn("gain", gain).withColumn("_same", same)
    # units of the last digit: what round() orders by, without a decimal a row
    units = F.floor(F.col("gain") * 10.0**GAIN_DIGITS + 0.5)
    first = F.struct((~F.col("_same")).alias("a"), units.alias("b"), (-F.col("_v")).alias("c"))
    best = cuts.groupBy(*key).agg(
        F.max_by(F.struct(F.col("_v").alias("threshold"), "gain", "left_pos", "left_neg", "pos", "neg", "n_values"), first).alias("best"),
        F.bool_and("_same").alias("zero"),
    )
    return best.select(*key, "best.*", "zero")


def _category_gains(cells: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """``node_id, attr, gain, zero`` of the categories not used on the node's path."""
    long = cells.unpivot(["node_id", "used", "pos", "neg"], list(attrs), "attr", "value")
    long = long.where(~F.array_contains("used", F.col("attr"))).groupBy("node_id", "attr", "value")
    counts = long.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counts = counts.withColumn("_h", (F.col("pos") + F.col("neg")).cast("double") * entropy("pos", "neg"))
    whole = Window.partitionBy("node_id", "attr")
    total = F.sum(F.col("pos") + F.col("neg")).over(whole)
    same = F.col("pos").cast(BIG) * total.cast(BIG) == F.sum("pos").over(whole).cast(BIG) * (F.col("pos") + F.col("neg")).cast(BIG)
    agg = counts.withColumn("_same", same).groupBy("node_id", "attr").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("_h").alias("_h"), F.bool_and("_same").alias("zero")
    )
    gain = entropy("pos", "neg") - F.try_divide(F.col("_h"), (F.col("pos") + F.col("neg")).cast("double"))
    return agg.select("node_id", "attr", F.lit(None).cast("double").alias("threshold"), gain.alias("gain"), "zero")


def grow_mixed_tree(
    train: DataFrame,
    attrs: Sequence[str],
    values: Sequence[str],
    label: str = LABEL,
    *,
    max_depth: int = 8,
    min_rows: int = 2,
    broadcast_limit: int | None = None,
    token: str = FILL_TOKEN,
) -> DataFrame:
    """The node table (``MIXED_COLUMNS``) over categories ``attrs`` and numbers ``values``.

    ``edge_value`` is the category that leads to a node, or ``<=`` / ``>`` for the low and the high
    side of its parent's ``threshold``.  Leaves: ``pure``, ``depth`` (``max_depth`` tests on the path),
    ``small`` (fewer than ``min_rows`` rows), ``zero_gain`` (nothing separates the classes).
    """
    attrs, values = list(attrs), list(values)
    names = attrs + values
    if not names or len(set(names)) != len(names) or any("=" in a or "|" in a for a in names):
        raise ValueError("column names must be distinct and contain no '=' or '|', and there must be one")
    spark, limit = train.sparkSession, broadcast_bytes(train.sparkSession, broadcast_limit)
    numbered = train.select(*attrs, *[number(v).alias(v) for v in values], label)
    grouped = numbered.groupBy(*[F.coalesce(F.col(a).cast("string"), F.lit(token)).alias(a) for a in attrs], *values)
    truth = F.coalesce(F.col(label), F.lit(False))
    cells = grouped.agg(F.count_if(truth).alias("pos"), F.count_if(~truth).alias("neg")) if values else build_cells(train, attrs, label, token)
    none = F.lit(None).cast("string")
    open_cells, n = durable(
        cells.select(
            F.lit(ROOT_ID).alias("node_id"), none.alias("parent_id"), none.alias("edge_attr"), none.alias("edge_value"),
            F.array().cast(T.ArrayType(T.StringType())).alias("used"), *names, "pos", "neg",
        ),
        count=True,
    )
    if not n:
        release(open_cells)
        empty = spark.range(1).select(
            F.lit(ROOT_ID).alias("node_id"), none.alias("parent_id"), F.lit(0).alias("depth"), none.alias("edge_attr"),
            none.alias("edge_value"), none.alias("split_attr"), F.lit(None).cast("double").alias("threshold"),
            F.lit(None).cast("double").alias("gain"), F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("neg"),
            F.lit("pure").alias("kind"), F.lit(False).alias("label"),
        )
        return durable(empty)[0]
    levels: list[DataFrame] = []
    for depth in range(max_depth + 1):
        seen = Observation()
        splits = F.col("kind") == "split"
        level = _level(open_cells, attrs, values, names, depth, max_depth, min_rows)
        level, _ = durable(level.observe(seen, F.count(F.when(splits, F.lit(1))).alias("splits")))
        levels.append(level)
        if not seen.get["splits"]:
            break
        moves = level.where(splits).select("node_id", "split_attr", "threshold")
        if seen.get["splits"] * (NODE_BYTES + max(map(len, names))) <= limit:
            moves = F.broadcast(moves)
        moved, _ = durable(_moved(open_cells.join(moves, "node_id"), attrs, values))
        release(open_cells)
        open_cells = moved
    tree, _ = durable(reduce(DataFrame.unionByName, levels))
    release(open_cells, *levels)
    return tree


def _edge(attrs: Sequence[str], values: Sequence[str]):
    """The value of the split column of a row: its category, or the side of the threshold it is on."""
    which = None
    for v in values:
        side = F.when(number(v) <= F.col("threshold"), F.lit(LOW)).otherwise(F.lit(HIGH))
        which = F.when(F.col("split_attr") == v, side) if which is None else which.when(F.col("split_attr") == v, side)
    category = value_of(F.col("split_attr"), attrs)
    return category if which is None else which.otherwise(category)


def _moved(joined: DataFrame, attrs: Sequence[str], values: Sequence[str]) -> DataFrame:
    own = joined.withColumn("_edge", _edge(attrs, values))
    used = F.when(F.col("split_attr").isin(*attrs), F.array_append("used", F.col("split_attr"))) if attrs else F.col("used")
    return own.select(
        child_id(F.col("node_id"), F.col("split_attr"), F.col("_edge")).alias("node_id"),
        F.col("node_id").alias("parent_id"),
        F.col("split_attr").alias("edge_attr"),
        F.col("_edge").alias("edge_value"),
        F.coalesce(used, F.col("used")).alias("used"),
        *attrs,
        *values,
        "pos",
        "neg",
    )


def _level(cells, attrs, values, names, depth, max_depth, min_rows) -> DataFrame:
    """The nodes of one level, decided (``MIXED_COLUMNS``)."""
    node = ["node_id", "parent_id", "edge_attr", "edge_value"]
    nodes = cells.groupBy(*node).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    if depth == max_depth:
        best = None
    else:
        options = [_category_gains(cells, attrs)] if attrs else []
        if values:
            options.append(best_cuts(cells, values, ["node_id"]).select("node_id", "attr", "threshold", "gain", "zero"))
        place = F.array_position(F.array(*map(F.lit, names)), F.col("attr"))
        first = F.struct((~F.col("zero")).alias("a"), F.round("gain", GAIN_DIGITS).alias("b"), (-place).alias("c"))
        all_options = reduce(DataFrame.unionByName, options)
        best = all_options.groupBy("node_id").agg(F.max_by(F.struct("attr", "threshold", "gain", "zero"), first).alias("best"))
    none = F.lit(None).cast("struct<attr:string,threshold:double,gain:double,zero:boolean>").alias("best")
    nodes = nodes.join(best, "node_id", "left") if best is not None else nodes.select("*", none)
    kind = (
        F.when((F.col("pos") == 0) | (F.col("neg") == 0), F.lit("pure"))
        .when(F.lit(depth == max_depth), F.lit("depth"))
        .when(F.col("pos") + F.col("neg") < min_rows, F.lit("small"))
        .when(F.coalesce(F.col("best.zero"), F.lit(True)), F.lit("zero_gain"))
        .otherwise(F.lit("split"))
    )
    nodes = nodes.withColumn("kind", kind)
    splits = F.col("kind") == "split"
    return nodes.select(
        "node_id", "parent_id", F.lit(depth).alias("depth"), "edge_attr", "edge_value",
        F.when(splits, F.col("best.attr")).alias("split_attr"),
        F.when(splits, F.col("best.threshold")).alias("threshold"),
        F.when(splits, F.col("best.gain")).alias("gain"),
        "pos", "neg", "kind", (F.col("pos") > F.col("neg")).alias("label"),
    )


def predict_mixed(
    df: DataFrame,
    tree: DataFrame,
    attrs: Sequence[str],
    values: Sequence[str],
    *,
    prediction: str = "prediction",
    broadcast_limit: int | None = None,
    token: str = FILL_TOKEN,
) -> DataFrame:
    """``df`` plus ``prediction`` ('true'/'false'), ``leaf_id`` and ``matched_depth``; an unseen category stops
    at the node that asked for it.  Columns of ``df`` with these names are replaced."""
    size, deepest = tree.agg(F.sum(F.octet_length("node_id") + F.lit(NODE_BYTES)), F.max("depth")).first()
    added = {prediction, "leaf_id", "matched_depth"}
    kept = [c for c in df.columns if c.lower() not in {a.lower() for a in added}]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")
    tests = [F.coalesce(F.col(a).cast("string"), F.lit(token)).alias(a) for a in attrs]
    out = df.select(row, *tests, *[number(v).alias(v) for v in values])
    names = [*attrs, *values]
    renamed = {n: f"_x{k}" for k, n in enumerate(names)}
    out = out.withColumnsRenamed(renamed).select("*", F.lit(ROOT_ID).alias("_cur"), F.lit(None).cast("struct<leaf_id:string,label:boolean,depth:int>").alias("_at"))
    lookup = tree.select(F.col("node_id").alias("_node"), "split_attr", "threshold", "label", "depth")
    if (size or 0) <= broadcast_bytes(df.sparkSession, broadcast_limit):
        lookup = F.broadcast(lookup)
    for level in range((deepest or 0) + 1):
        if level == 0:  # every row is at the root: its node by a literal key would be a nested loop
            root = tree.where(F.col("node_id") == ROOT_ID).select("split_attr", "threshold", "label", "depth").first()
            literals = [F.lit(root[c]).cast(t).alias(c) for c, t in (("split_attr", "string"), ("threshold", "double"), ("label", "boolean"), ("depth", "int"))]
            step = out.select("*", F.lit(ROOT_ID).alias("_node"), *literals)
        else:
            step = out.join(lookup, F.col("_cur") == F.col("_node"), "left")
        met = F.col("_node").isNotNull()
        choice = F.lit(None).cast("string")
        for k, n in enumerate(names):
            value = F.col(f"_x{k}")
            if k >= len(attrs):
                value = F.when(value <= F.col("threshold"), F.lit(LOW)).otherwise(F.lit(HIGH))
            choice = F.when(F.col("split_attr") == n, value).otherwise(choice)
        child = F.when(met & F.col("split_attr").isNotNull(), child_id(F.col("_node"), F.col("split_attr"), choice))
        now = F.struct(F.col("_node").alias("leaf_id"), F.col("label").alias("label"), F.col("depth").alias("depth"))
        out = step.select("_row", *renamed.values(), child.alias("_cur"), F.when(met, now).otherwise(F.col("_at")).alias("_at"))
    return out.select(
        "_row.*",
        F.when(F.col("_at.label"), F.lit("true")).otherwise(F.lit("false")).alias(prediction),
        F.col("_at.leaf_id").alias("leaf_id"),
        F.col("_at.depth").alias("matched_depth"),
    )
