"""Level-wise ID3 over categorical attributes.

The training rows are read once, into *cells*: class counts per distinct
combination of the attributes.  Each node of the tree is a conjunction of
``attr = value`` tests, so its counts -- and the counts of every candidate
split -- are sums over the cells it contains.  The tree then grows one level
per round, all nodes of a level at once, from the cells keyed by their node:

* cells unpivoted to ``(node, attr, value)`` and summed: the candidate children
  for attributes not yet used on the node's path, and the one value of each used;
* one aggregation per node: for each attribute the information gain, an exact
  test of "gain is zero" (all children have one class ratio, compared as
  fractions in lowest terms), then the arg-max gain among the attributes that
  separate at all, ties to the earlier attribute; the node's kind (split / pure
  / exhausted / zero_gain), majority label and path -- stored, with the number
  of children counted on the way;
* the cells of split nodes keyed anew by their child -- stored.

That is two stored tables and about five small Spark jobs a level, however many
nodes it has, and at most ``len(attrs) + 1`` levels.  Each level plans against
stored data, and cells are released when the next level's are there.  The
decisions are broadcast to the cells only when their size -- known exactly -- is
under the session's broadcast limit; otherwise they are joined like any table,
and AQE handles a node that owns most of the cells.

Node ids: the root is ``'root'``; a child is ``md5(parent || '|' || attr ||
'=' || value)`` (see ``functions.columns.child_id``), so prediction can
compute the id of the next node from the row itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canopy.functions.columns import child_id, entropy, value_of
from canopy.operators._lineage import broadcast_bytes, durable, release
from canopy.operators.contingency import cells as build_cells
from canopy.operators.impurity import gain_error
from canopy.operators.prepare import ATTRIBUTES, FILL_TOKEN, LABEL

ROOT_ID = "root"
KINDS = ("split", "pure", "exhausted", "zero_gain")

TREE_COLUMNS = (
    "node_id",
    "parent_id",
    "depth",
    "edge_attr",
    "edge_value",
    "rule",
    "split_attr",
    "gain",
    "pos",
    "neg",
    "kind",
    "label",
)


def _maybe_broadcast(df: DataFrame, size: int, limit: int) -> DataFrame:
    return F.broadcast(df) if size <= limit else df


#: Bytes of a decision (node id, attribute name beside its text, row) when it is broadcast.
NODE_BYTES = 128


def _lowest_terms(part, whole):
    """The fraction part / whole with its greatest common divisor taken out (null for 0 / 0)."""
    # Euclid's algorithm; its steps are bounded by the logarithm of the larger number
    steps = F.sequence(F.lit(1), (F.log2(whole + 2) * 1.5 + 2).cast("int"))
    start = F.struct(whole.cast("bigint").alias("a"), part.cast("bigint").alias("b"))

    def step(s, _):
        return F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), F.try_mod(s["a"], s["b"]).alias("b")))

    divisor = F.aggregate(steps, start, step)["a"].cast("decimal(20,0)")
    # quotients of decimals are exact here, beyond 2^53 as well
    exact = [(x.cast("decimal(20,0)") / divisor).cast("decimal(20,0)") for x in (part, whole)]
    return F.when(whole > 0, F.struct(exact[0].alias("part"), exact[1].alias("whole")))


def grow_tree(
    train: DataFrame | None,
    attrs: Sequence[str] = ATTRIBUTES,
    label: str = LABEL,
    *,
    cells: DataFrame | None = None,
    force_root: bool = True,
    broadcast_limit: int | None = None,
    token: str = FILL_TOKEN,
) -> DataFrame:
    """Grow the tree; return the flat node table (``TREE_COLUMNS``).

    ``train`` holds the attribute columns and a boolean ``label``; or pass
    precomputed ``cells`` (attrs..., pos, neg).  The root is always split
    when ``force_root`` (as long as an attribute is available), even if it
    is pure or no attribute has any gain.  Leaves: ``pure`` (one class
    only), ``exhausted`` (every attribute used on the path), ``zero_gain``
    (no attribute separates the classes at all).  ``label`` of every node
    is its majority class, ties to ``false``.
    """
    attrs = list(attrs)
    bad = [a for a in attrs if "=" in a or "|" in a]
    if bad or len(set(attrs)) != len(attrs):
        # node ids hash "parent|attr=value"; these characters would make two paths collide
        raise ValueError(f"attribute names must be distinct and contain no '=' or '|': {bad or attrs}")
    if cells is None:
        if train is None:
            raise ValueError("give train or cells")
        cells = build_cells(train, attrs, label, token)

    start = cells.select(
        F.lit(ROOT_ID).alias("node_id"),
        *[F.coalesce(F.col(a).cast("string"), F.lit(token)).alias(a) for a in attrs],
        "pos",
        "neg",
    )
    tree = grow_levels(start, attrs, force_root=force_root, broadcast_limit=broadcast_limit)
    # no training rows: a single empty root leaf
    return durable(_empty_root(cells.sparkSession))[0] if tree is None else tree


def grow_levels(
    start: DataFrame, attrs: Sequence[str], *, force_root: bool, broadcast_limit: int | None = None, keep: Sequence[str] = ()
) -> DataFrame | None:
    """The level loop: node table of the trees whose root ids and cells ``start`` holds (None without cells).

    ``start`` has ``node_id, keep..., attrs..., pos, neg``.  Ids of nodes below different
    roots differ, so any number of trees grows in one loop; ``keep`` are columns that
    depend on the root alone and are added to the node table.
    """
    attrs, keep = list(attrs), list(keep)
    limit = broadcast_bytes(start.sparkSession, broadcast_limit)
    widest = max(map(len, attrs), default=0)

    # Ids are stored as columns of the written cells: a literal id would be
    # constant-folded and turn the re-keying join into a nested loop.
    open_cells, n_cells = durable(
        start.select(
            "node_id",
            F.lit(None).cast("string").alias("parent_id"),
            F.array().cast(T.ArrayType(T.StringType())).alias("used"),
            *keep,
            *attrs,
            "pos",
            "neg",
        ),
        count=True,
    )
    if not n_cells:
        release(open_cells)
        return None

    levels: list[DataFrame] = []
    while True:
        seen = Observation()
        splitting = F.col("kind") == "split"
        # the number of children is counted while the level is written
        decided = _decided(open_cells, attrs, force_root, keep).observe(
            seen,
            F.coalesce(F.sum(F.when(splitting, F.col("n_children"))), F.lit(0)).alias("children"),
            F.count(F.when(splitting, F.lit(1))).alias("splits"),
        )
        decided, _ = durable(decided)
        levels.append(decided)
        if not seen.get["children"]:
            break
        moves = decided.where(splitting).select("node_id", "split_attr")
        moves = _maybe_broadcast(moves, seen.get["splits"] * (NODE_BYTES + widest), limit)
        picked = value_of(F.col("split_attr"), attrs)
        moved, _ = durable(
            open_cells.join(moves, "node_id").select(
                child_id(F.col("node_id"), F.col("split_attr"), picked).alias("node_id"),
                F.col("node_id").alias("parent_id"),
                F.array_append(F.col("used"), F.col("split_attr")).alias("used"),
                *keep,
                *attrs,
                "pos",
                "neg",
            )
        )
        release(open_cells)
        open_cells = moved

    tree, _ = durable(reduce(DataFrame.unionByName, [level.select(*keep, *TREE_COLUMNS) for level in levels]))
    release(open_cells, *levels)
    return tree


def _empty_root(spark) -> DataFrame:
    return spark.range(1).select(
        F.lit(ROOT_ID).alias("node_id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.lit(0).alias("depth"),
        F.lit(None).cast("string").alias("edge_attr"),
        F.lit(None).cast("string").alias("edge_value"),
        F.lit("").alias("rule"),
        F.lit(None).cast("string").alias("split_attr"),
        F.lit(None).cast("double").alias("gain"),
        F.lit(0).cast("bigint").alias("pos"),
        F.lit(0).cast("bigint").alias("neg"),
        F.lit("pure").alias("kind"),
        F.lit(False).alias("label"),
    )


def _decided(open_cells: DataFrame, attrs: Sequence[str], force_root: bool, keep: Sequence[str] = ()) -> DataFrame:
    """The nodes of a level (``TREE_COLUMNS`` and ``n_children``) from its cells."""
    node = ["node_id", "parent_id", "used", *keep]
    counts = open_cells.unpivot([*node, "pos", "neg"], list(attrs), "attr", "value").groupBy(*node, "attr", "value")
    counts = counts.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    whole = F.col("pos") + F.col("neg")
    counts = counts.withColumn("ratio", _lowest_terms(F.col("pos"), whole))
    # The attribute list is small and fixed, so its sums are conditional
    # aggregates: partial aggregation still collapses a node that owns
    # everything to one row per task, and the arg-max is row-wise.
    per_attr = [F.sum(F.when(F.col("attr") == attrs[0], F.col(c))).cast("bigint").alias(c) for c in ("pos", "neg")]
    for i, a in enumerate(attrs):
        on = F.col("attr") == F.lit(a)
        ratio = F.when(on, F.col("ratio"))
        per_attr += [
            F.sum(F.when(on, whole.cast("double") * entropy("pos", "neg"))).alias(f"_wh{i}"),
            (F.min(ratio) == F.max(ratio)).alias(f"_z{i}"),
            F.count(F.when(on, F.lit(1))).alias(f"_n{i}"),
            F.max(F.when(on, F.col("value"))).alias(f"_v{i}"),
        ]
    per_node = counts.groupBy(*node).agg(*per_attr)

    total = (F.col("pos") + F.col("neg")).cast("double")
    free = [~F.array_contains("used", a) for a in attrs]
    gains = [entropy("pos", "neg") - F.try_divide(F.col(f"_wh{i}"), total) for i in range(len(attrs))]
    # an attribute that separates the classes at all (exact test) before any that doesn't;
    # of those the highest gain, and of gains equal but for rounding the attribute listed first
    zero = [F.coalesce(F.col(f"_z{i}"), F.lit(True)) for i in range(len(attrs))]
    real = [F.when(free[i] & ~zero[i], g) for i, g in enumerate(gains)]
    highest = F.greatest(*real) if len(real) > 1 else real[0]
    values = [F.when(free[i], F.col(f"_n{i}")).otherwise(0) for i in range(len(attrs))]
    slack = gain_error(F.greatest(*values) if len(values) > 1 else values[0])

    def option(i):
        return F.struct(
            F.lit(attrs[i]).alias("attr"), gains[i].alias("gain"), zero[i].alias("zero"), F.col(f"_n{i}").alias("n_values")
        )

    separating = [F.when(g >= highest - slack, option(i)) for i, g in enumerate(real)]
    any_left = [F.when(free[i], option(i)) for i in range(len(attrs))]

    def own_value(attr):  # the node's one value of an attribute on its path
        out = F
        for i, a in enumerate(attrs):
            out = out.when(attr == F.lit(a), F.col(f"_v{i}"))
        return out

    nodes = per_node.withColumn("best", F.coalesce(*separating, *any_left))
    depth = F.size("used")
    edge = F.when(depth > 0, F.element_at("used", -1))
    kind = (
        F.when((depth == 0) & F.lit(force_root) & F.col("best").isNotNull(), F.lit("split"))
        .when((F.col("pos") == 0) | (F.col("neg") == 0), F.lit("pure"))
        .when(F.col("best").isNull(), F.lit("exhausted"))
        .when(F.col("best.zero"), F.lit("zero_gain"))
        .otherwise(F.lit("split"))
    )
    nodes = nodes.withColumn("kind", kind)
    splits = F.col("kind") == "split"
    return nodes.select(
        *keep,
        "node_id",
        "parent_id",
        depth.alias("depth"),
        edge.alias("edge_attr"),
        own_value(edge).alias("edge_value"),
        F.array_join(F.transform("used", lambda u: F.concat(u, F.lit("="), own_value(u))), " AND ").alias("rule"),
        F.when(splits, F.col("best.attr")).alias("split_attr"),
        F.when(splits, F.col("best.gain")).alias("gain"),
        "pos",
        "neg",
        "kind",
        (F.col("pos") > F.col("neg")).alias("label"),
        F.when(splits, F.col("best.n_values")).alias("n_children"),
    )


def tree_rules(tree: DataFrame) -> DataFrame:
    """Leaves as rules: ``rule`` (path text), ``label``, ``pos``, ``neg``, ``kind``."""
    return tree.where(F.col("split_attr").isNull()).select("rule", "label", "pos", "neg", "kind", "depth")
