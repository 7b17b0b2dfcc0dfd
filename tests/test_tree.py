from pyspark.sql import functions as F

from canopy.operators.contingency import attr_value_counts, attr_value_counts_join, cells, class_counts
from canopy.operators.impurity import best_attribute, info_gain
from canopy.operators.contingency import long_counts
from canopy.operators.predict import predict
from canopy.operators.tree import grow_tree, tree_rules

# Quinlan (1986), "Induction of decision trees", table 1.
WEATHER = """sunny hot high weak n
sunny hot high strong n
overcast hot high weak y
rain mild high weak y
rain cool normal weak y
rain cool normal strong n
overcast cool normal strong y
sunny mild high weak n
sunny cool normal weak y
rain mild normal weak y
sunny mild normal strong y
overcast mild high strong y
overcast hot normal weak y
rain mild high strong n"""
W_ATTRS = ["outlook", "temperature", "humidity", "wind"]


def weather(spark):
    rows = [tuple(line.split()[:4]) + (line.split()[4] == "y",) for line in WEATHER.splitlines()]
    return spark.createDataFrame(rows, "outlook string, temperature string, humidity string, wind string, play boolean")


def test_weather_gains(spark):
    df = weather(spark)
    g = {r.attr: r.info_gain for r in info_gain(long_counts(cells(df, W_ATTRS, "play"), W_ATTRS)).collect()}
    assert round(g["outlook"], 3) == 0.247
    assert round(g["humidity"], 3) == 0.152
    assert round(g["wind"], 3) == 0.048
    assert round(g["temperature"], 3) == 0.029
    best = best_attribute(info_gain(long_counts(cells(df, W_ATTRS, "play"), W_ATTRS)), W_ATTRS).first()
    assert best.attr == "outlook"


def test_weather_tree_exact(spark):
    tree = grow_tree(weather(spark), W_ATTRS, "play")
    rules = {(r.rule, r.label, r.pos, r.neg) for r in tree_rules(tree).collect()}
    assert rules == {
        ("outlook=overcast", True, 4, 0),
        ("outlook=sunny AND humidity=high", False, 0, 3),
        ("outlook=sunny AND humidity=normal", True, 2, 0),
        ("outlook=rain AND wind=strong", False, 0, 2),
        ("outlook=rain AND wind=weak", True, 3, 0),
    }
    inner = {(r.rule, r.split_attr) for r in tree.where("split_attr IS NOT NULL").collect()}
    assert inner == {("", "outlook"), ("outlook=sunny", "humidity"), ("outlook=rain", "wind")}


def test_invariants_and_training_predictions(spark):
    df = weather(spark)
    tree = grow_tree(df, W_ATTRS, "play")
    nodes = {r.node_id: r for r in tree.collect()}
    for n in nodes.values():
        kids = [k for k in nodes.values() if k.parent_id == n.node_id]
        if kids:
            assert sum(k.pos for k in kids) == n.pos and sum(k.neg for k in kids) == n.neg
    leaves = [n for n in nodes.values() if n.split_attr is None]
    assert sum(n.pos + n.neg for n in leaves) == 14
    p = predict(df, tree, W_ATTRS)
    assert p.where(F.col("prediction") != F.when(F.col("play"), "true").otherwise("false")).count() == 0
    assert p.where(~F.col("reached_leaf")).count() == 0


def test_grow_from_rows_equals_from_cells_and_partitioning(spark):
    df = weather(spark)
    a = sorted(map(tuple, grow_tree(df, W_ATTRS, "play").collect()))
    b = sorted(map(tuple, grow_tree(None, W_ATTRS, "play", cells=cells(df, W_ATTRS, "play")).collect()))
    c = sorted(map(tuple, grow_tree(df.repartition(5), W_ATTRS, "play", broadcast_limit=0).collect()))
    assert a == b == c


def test_unseen_value_falls_back_to_deepest_majority(spark):
    tree = grow_tree(weather(spark), W_ATTRS, "play")
    rows = spark.createDataFrame(
        [("fog", "hot", "high", "weak"), ("sunny", "hot", "extreme", "weak"), ("rain", None, "high", "calm")],
        "outlook string, temperature string, humidity string, wind string",
    )
    got = {r.outlook: r for r in predict(rows, tree, W_ATTRS).collect()}
    assert got["fog"].matched_depth == 0 and got["fog"].prediction == "true"  # root majority 9:5
    assert got["sunny"].matched_depth == 1 and got["sunny"].prediction == "false" and not got["sunny"].reached_leaf
    assert got["rain"].matched_depth == 1 and got["rain"].prediction == "true"  # rain node 3:2


def brute_id3(rows, attrs):
    """Plain recursive ID3 over Python rows: the semantics the Spark plan must reproduce.

    Root always split (if an attribute exists); then pure → exhausted →
    zero gain (exact: every child has the parent's class ratio) → split on
    the best gain, ties to the attribute listed first.  Label = majority,
    tie → false.  Returns {rule: (split_attr, kind, label, pos, neg)}.
    """
    import math

    def h(p, n):
        t = p + n
        return -sum(c / t * math.log2(c / t) for c in (p, n) if c) if t else 0.0

    out = {}

    def node(subset, used, rule, depth):
        p = sum(1 for r in subset if r[-1])
        n = len(subset) - p
        free = [a for a in attrs if a not in used]
        best, best_g, zero = None, None, True
        for a in free:
            i = attrs.index(a)
            groups = {}
            for r in subset:
                groups.setdefault(r[i], []).append(r[-1])
            g = h(p, n) - sum(len(v) / len(subset) * h(sum(v), len(v) - sum(v)) for v in groups.values())
            z = all(sum(v) * n == (len(v) - sum(v)) * p for v in groups.values())
            if best is None or round(g, 12) > round(best_g, 12):
                best, best_g, zero = a, g, z
        if depth == 0 and best is not None:
            kind = "split"
        elif p == 0 or n == 0:
            kind = "pure"
        elif best is None:
            kind = "exhausted"
        elif zero:
            kind = "zero_gain"
        else:
            kind = "split"
        out[rule] = (best if kind == "split" else None, kind, p > n, p, n)
        if kind == "split":
            i = attrs.index(best)
            for v in sorted({r[i] for r in subset}):
                cond = f"{best}={v}"
                node([r for r in subset if r[i] == v], used | {best}, cond if not rule else f"{rule} AND {cond}", depth + 1)

    node(rows, frozenset(), "", 0)
    return out


def test_tree_equals_brute_force_on_random_tables(spark):
    import random

    for seed in range(6):
        rnd = random.Random(seed)
        attrs = ["a", "b", "c", "d"][: rnd.randint(1, 4)]
        card = [rnd.randint(1, 4) for _ in attrs]
        rows = []
        for _ in range(rnd.randint(1, 80)):
            vals = tuple(f"v{rnd.randrange(k)}" for k in card)
            rows.append(vals + (rnd.random() < (0.8 if vals[0] == "v0" else 0.4),))
        schema = ", ".join(f"{a} string" for a in attrs) + ", y boolean"
        df = spark.createDataFrame(rows, schema)
        got = {r.rule: (r.split_attr, r.kind, r.label, r.pos, r.neg) for r in grow_tree(df, attrs, "y").collect()}
        assert got == brute_id3(rows, attrs), seed


def test_leaf_kinds(spark):
    # z: no attribute separates the classes (zero gain), majority tie → false
    # (gain a = 0.292 > gain b = 0.061 at the root)
    rows = [("x", "1", True)] * 3 + [("z", "1", True), ("z", "2", True), ("z", "1", False), ("z", "2", False)]
    t = {r.rule: r for r in grow_tree(spark.createDataFrame(rows, "a string, b string, y boolean"), ["a", "b"], "y").collect()}
    assert t[""].split_attr == "a"
    assert t["a=x"].kind == "pure" and t["a=x"].label is True
    assert t["a=z"].kind == "zero_gain" and t["a=z"].label is False
    # exhausted: every attribute used on the path, both classes left
    df2 = spark.createDataFrame([("1", "1", True), ("1", "1", False), ("1", "2", True), ("2", "1", False)], "a string, b string, y boolean")
    t2 = {r.rule: r for r in grow_tree(df2, ["a", "b"], "y").collect()}
    assert t2["a=1 AND b=1"].kind == "exhausted"


def test_root_pure_is_still_split_and_empty_input(spark):
    df = spark.createDataFrame([("u", "1", True), ("v", "2", True)], "a string, b string, y boolean")
    t = {r.rule: r for r in grow_tree(df, ["a", "b"], "y").collect()}
    assert t[""].kind == "split" and t["a=u"].kind == "pure"
    t0 = grow_tree(df.where("false"), ["a", "b"], "y").collect()
    assert len(t0) == 1 and t0[0].kind == "pure" and t0[0].pos == 0
    p = predict(df, grow_tree(df.where("false"), ["a", "b"], "y"), ["a", "b"]).collect()
    assert {r.prediction for r in p} == {"false"}


def test_quotes_and_separators_in_values(spark):
    rows = [("it's", "a=b/c", True), ("it's", "x", False), ("o'k", "a=b/c", False)]
    df = spark.createDataFrame(rows, "a string, b string, y boolean")
    tree = grow_tree(df, ["a", "b"], "y")
    p = predict(df, tree, ["a", "b"]).collect()
    assert all((r.prediction == "true") == r.y for r in p)


def test_literal_join_counts_equal_fast_counts(spark):
    df = weather(spark)
    a = sorted(map(tuple, attr_value_counts(df, W_ATTRS, "play").collect()))
    b = sorted(map(tuple, attr_value_counts_join(df, W_ATTRS, "play").collect()))
    assert a == b
    assert tuple(class_counts(df, "play").first()) == (9, 5, 14)


def test_save_and_load_tree_round_trip(spark, tmp_path):
    from canopy.sources.trees import load_tree, save_tree

    df = weather(spark)
    tree = grow_tree(df, W_ATTRS, "play")
    save_tree(tree, str(tmp_path / "tree"))
    loaded = load_tree(spark, str(tmp_path / "tree"))
    assert sorted(map(tuple, loaded.collect())) == sorted(map(tuple, tree.collect()))
    a = sorted((r.outlook, r.humidity, r.wind, r.temperature, r.prediction) for r in predict(df, tree, W_ATTRS).collect())
    b = sorted((r.outlook, r.humidity, r.wind, r.temperature, r.prediction) for r in predict(df, loaded, W_ATTRS).collect())
    assert a == b


def test_hot_combination_with_shuffled_joins(spark):
    # one attribute combination holds a third of the rows; force every node
    # table through shuffled joins (no broadcast) and compare with brute force
    import random

    rnd = random.Random(11)
    rows = []
    for i in range(600):
        if i % 3 == 0:
            rows.append(("hot", "h", "h", rnd.random() < 0.7))
        else:
            vals = (f"a{rnd.randrange(4)}", f"b{rnd.randrange(3)}", f"c{rnd.randrange(5)}")
            rows.append(vals + (rnd.random() < (0.9 if vals[1] == "b0" else 0.3),))
    df = spark.createDataFrame(rows, "a string, b string, c string, y boolean").repartition(6)
    got = {r.rule: (r.split_attr, r.kind, r.label, r.pos, r.neg) for r in grow_tree(df, ["a", "b", "c"], "y", broadcast_limit=0).collect()}
    assert got == brute_id3(rows, ["a", "b", "c"])


def test_predict_with_shuffled_joins_equals_broadcast(spark):
    import random

    rnd = random.Random(3)
    rows = [(f"a{rnd.randrange(3)}", f"b{rnd.randrange(4)}", rnd.random() < 0.5) for _ in range(300)]
    df = spark.createDataFrame(rows, "a string, b string, y boolean")
    tree = grow_tree(df, ["a", "b"], "y")
    test = spark.createDataFrame(rows + [("a9", "b0", True), ("a0", "b9", False)], df.schema).repartition(4)
    cols = ["a", "b", "y", "prediction", "leaf_id", "matched_depth", "reached_leaf"]
    fast = sorted(map(tuple, predict(test, tree, ["a", "b"]).select(*cols).collect()), key=str)
    slow_df = predict(test, tree, ["a", "b"], broadcast_limit=0)
    slow = sorted(map(tuple, slow_df.select(*cols).collect()), key=str)
    assert fast == slow  # (AQE may still broadcast the tree from its measured size; results must not change)
    for kw in ({"strategy": "combos"}, {"strategy": "combos", "broadcast_limit": 0}):
        combos = sorted(map(tuple, predict(test, tree, ["a", "b"], **kw).select(*cols).collect()), key=str)
        assert combos == fast, kw
    # a too-large tree switches to the combinations route on its own
    auto = predict(test, tree, ["a", "b"], broadcast_limit=0)
    assert sorted(map(tuple, auto.select(*cols).collect()), key=str) == fast


def test_force_root_option(spark):
    df = spark.createDataFrame([("u", "1", True), ("v", "2", True)], "a string, b string, y boolean")
    closed = grow_tree(df, ["a", "b"], "y", force_root=False).collect()
    assert len(closed) == 1 and closed[0].kind == "pure" and closed[0].label is True


def test_nulls_in_every_attribute_are_the_false_category(spark):
    rows = [(None, None, True), (None, None, True), ("x", "1", False), ("x", None, False), (None, "1", True)]
    df = spark.createDataFrame(rows, "a string, b string, y boolean")
    tree = grow_tree(df, ["a", "b"], "y")
    by_rule = {r.rule: r for r in tree.collect()}
    assert "a=false" in by_rule and by_rule["a=false"].pos == 3
    filled = grow_tree(df.na.fill("false"), ["a", "b"], "y")
    assert sorted(map(tuple, tree.collect())) == sorted(map(tuple, filled.collect()))
    p = {(r.a, r.b): r.prediction for r in predict(df, tree, ["a", "b"]).collect()}
    assert p[(None, None)] == "true" and p[("x", "1")] == "false"


def test_attribute_names_are_validated(spark):
    import pytest

    df = spark.createDataFrame([("x", True)], "`a=b` string, y boolean")
    with pytest.raises(ValueError):
        grow_tree(df, ["a=b"], "y")


def test_a_tiny_gain_beats_no_gain_at_any_size(spark):
    # a is exactly useless; b separates the classes by one record in ten million
    n = 10_000_000
    cells_ = [("x", "u", n, n), ("x", "v", n, n), ("y", "u", n + 1, n), ("y", "v", n - 1, n)]
    for scale in (1, 10**6):
        rows = [(a, b, p * scale, q * scale) for a, b, p, q in cells_]
        df = spark.createDataFrame(rows, "a string, b string, pos long, neg long")
        for force_root in (True, False):
            tree = {r.rule: r for r in grow_tree(None, ["a", "b"], cells=df, force_root=force_root).collect()}
            assert tree[""].split_attr == "b" and tree[""].kind == "split"
        from canopy.operators.contingency import long_counts
        from canopy.operators.impurity import best_attribute, info_gain

        gains = info_gain(long_counts(df, ["a", "b"]))
        assert best_attribute(gains, ["a", "b"]).first()["attr"] == "b"
    flat = spark.createDataFrame([("x", "u", n, n), ("y", "v", n, n)], "a string, b string, pos long, neg long")
    only = grow_tree(None, ["a", "b"], cells=flat, force_root=False).collect()
    assert [(r.kind, r.split_attr) for r in only] == [("zero_gain", None)]


def test_equal_gains_go_to_the_first_attribute(spark):
    rows = [("x", "1", 7, 3), ("y", "2", 1, 9), ("z", "3", 4, 4)]
    df = spark.createDataFrame(rows, "a string, b string, pos long, neg long")
    for attrs in (["a", "b"], ["b", "a"]):
        assert [r.split_attr for r in grow_tree(None, attrs, cells=df).collect() if r.depth == 0] == [attrs[0]]


def test_predict_leaves_other_names_alone(spark):
    df = spark.createDataFrame([("x", True, "l", 1), ("y", False, "m", 2)], "a string, y boolean, _label string, _walk int")
    tree = grow_tree(df, ["a"], "y")
    for strategy in ("walk", "combos"):
        once = predict(df, tree, ["a"], strategy=strategy)
        twice = predict(once, tree, ["a"], strategy=strategy)
        assert twice.columns == once.columns and sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))
        assert {r["_label"]: r.prediction for r in once.collect()} == {"l": "true", "m": "false"}


def test_wide_values_are_never_broadcast_past_the_limit(spark):
    import contextlib
    import io

    rows = [(str(k) * 10_000, f"b{k % 7}", k % 3 == 0) for k in range(60)]
    df = spark.createDataFrame(rows, "a string, b string, y boolean")
    tree = grow_tree(df, ["a", "b"], "y", broadcast_limit=100_000)
    assert tree.count() >= 60
    out = predict(df, tree, ["a", "b"], broadcast_limit=2_000)
    text = io.StringIO()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with contextlib.redirect_stdout(text):
            out.explain()
        assert "BroadcastHashJoin" not in text.getvalue()
        assert sorted(r.prediction for r in out.collect()) == sorted(r.prediction for r in predict(df, tree, ["a", "b"]).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_public_node_operators(spark):
    from canopy.operators.contingency import leaf_labels, node_counts, node_split

    rows = [("x", "1", 2, 0), ("x", "2", 1, 3), ("y", "1", 0, 5)]
    df = spark.createDataFrame(rows, "a string, b string, pos long, neg long")
    assert sorted(map(tuple, node_split(df, "b", [("a", "x")]).collect())) == [("b", "1", 2, 0), ("b", "2", 1, 3)]
    assert [r.label for r in leaf_labels(df, [("a", "y")]).collect()] == [False]
    assert sorted(map(tuple, leaf_labels(df, by="a").collect())) == [("x", False), ("x", True), ("y", False)]
    assert tuple(node_counts(df, [("a", "x")]).first()) == (3, 3, 6) and tuple(node_counts(df, [("a", "q")]).first()) == (0, 0, 0)
    assert leaf_labels(df, [("a", "q")]).collect() == []


def test_loop_tables_are_released(spark, tmp_path):
    import os

    from canopy.operators import _lineage

    made = []
    real = _lineage.durable
    import canopy.operators.tree as t

    def spy(df, count=False):
        out = real(df, count)
        made.append(out[0]._canopy_path.removeprefix("file:"))
        return out

    t.durable = spy
    try:
        tree = grow_tree(spark.createDataFrame([("x", "1", True), ("x", "2", False), ("y", "1", True)], "a string, b string, y boolean"), ["a", "b"], "y")
    finally:
        t.durable = real
    assert [p for p in made if os.path.exists(p)] == [tree._canopy_path.removeprefix("file:")]
