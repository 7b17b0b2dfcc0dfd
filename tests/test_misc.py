from pyspark.sql import functions as F

from canopy.operators.contingency import cells, path_filter
from canopy.operators.prepare import fill_missing
from canopy.operators.sampling import random_split, split_train_test, with_side


def test_keyed_split_is_stable_and_complete(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("key"))
    train, test = split_train_test(df, "key")
    n_train, n_test = train.count(), test.count()
    assert n_train + n_test == 20000 and 0.67 < n_train / 20000 < 0.73
    # same split under a different partitioning
    train2, _ = split_train_test(df.repartition(13), "key")
    assert sorted(r.key for r in train.collect()) == sorted(r.key for r in train2.collect())
    sides = {r.side: r["count"] for r in with_side(df, "key").groupBy("side").count().collect()}
    assert sides == {"train": n_train, "test": n_test}


def test_random_split_compat(spark):
    a, b = random_split(spark.range(10000))
    assert a.count() + b.count() == 10000 and 0.65 < a.count() / 10000 < 0.75


def test_fill_missing_by_type(spark):
    df = spark.createDataFrame([(None, None, None)], "a string, b double, c boolean")
    assert tuple(fill_missing(df).first()) == ("false", 0.0, False)


def test_sql_users_can_query_cells_through_a_view(spark):
    df = spark.createDataFrame([("x", "1", True), ("x", "1", False), ("y", "2", True)], "a string, b string, y boolean")
    cells(df, ["a", "b"], "y").createOrReplaceTempView("canopy_cells")
    got = spark.sql("SELECT a, sum(pos) AS p, sum(neg) AS n FROM canopy_cells GROUP BY a ORDER BY a").collect()
    assert [tuple(r) for r in got] == [("x", 1, 1), ("y", 1, 0)]
    # values with quotes are literals, never SQL text
    assert path_filter(df.union(spark.createDataFrame([("o'k", "1", True)], df.schema)), [("a", "o'k")]).count() == 1


def test_results_do_not_depend_on_ansi_mode(spark):
    from canopy.functions.columns import ratio_above, rating_bucket
    from canopy.operators.tree import grow_tree

    rows = [("3", "4", "5"), ("1", "0", "x"), (None, "2", None), ("2", "y", "3"), ("5", "3", "2")]
    df = spark.createDataFrame(rows, "h string, t string, r string")
    exprs = [ratio_above("h", "t").alias("y"), rating_bucket("r").alias("b")]
    tree_in = df.select(*exprs)

    def run():
        return sorted(map(tuple, df.select(*exprs).collect())), sorted(map(tuple, grow_tree(tree_in, ["b"], "y").collect()))

    before = run()
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        after = run()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert before == after


def test_domain_distinct_and_path_operators(spark):
    from canopy.operators.contingency import distinct_values, domain_violations

    df = spark.createDataFrame(
        [("US", "Y", True), ("UK", "N", False), ("XX", "Y", True), ("US", None, False)], "m string, v string, y boolean"
    )
    bad = {(r.attr, r.value): r.n_rows for r in domain_violations(df, {"m": ["US", "UK"], "v": ["Y", "N"]}).collect()}
    assert bad == {("m", "XX"): 1, ("v", None): 1}
    assert sorted(r.m for r in distinct_values(df, "m").collect()) == ["UK", "US", "XX"]
    assert path_filter(df, [("m", "US"), ("v", "Y")]).count() == 1
    assert path_filter(df, []).count() == 4


def test_null_keys_and_labels_are_lost_nowhere(spark):
    import random

    from canopy.plans.end_to_end import binned_sides, evaluate, train_tree
    from canopy.operators.predict import predict
    from canopy.operators.prepare import ATTRIBUTES

    rnd = random.Random(3)
    rows = [
        (None if i % 5 == 0 else f"k{i}", *(rnd.choice(["a", "b", None]) for _ in range(4)), rnd.choice([float(i), None]), rnd.choice([True, False, None]))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "key string, marketplace string, verified_purchase string, vine string, product_category string, body_len double, is_vote_helpful boolean")
    train, test = split_train_test(df, "key")
    assert train.count() + test.count() == 400
    s = binned_sides(df)
    n_test = predict(s.test, tree := train_tree(s)).count()
    assert evaluate(s, tree).first()["n_rows"] == n_test == test.count()
    assert s.train_cells.agg(F.sum(F.col("pos") + F.col("neg"))).first()[0] == train.count()
    assert tree.where("pos + neg = 0").count() == 0
    assert set(ATTRIBUTES) >= {r.edge_attr for r in tree.collect() if r.edge_attr}


def test_null_labels_count_as_false(spark):
    from canopy.operators.contingency import class_counts
    from canopy.operators.tree import grow_tree

    rows = [("p", True), ("p", False), ("p", True), ("q", None), ("q", None)]
    df = spark.createDataFrame(rows, "a string, y boolean")
    assert tuple(class_counts(df, "y").first()) == (2, 3, 5)
    nodes = {r.rule: (r.pos, r.neg) for r in grow_tree(df, ["a"], "y").collect()}
    assert nodes == {"": (2, 3), "a=p": (2, 1), "a=q": (0, 2)}


def test_fill_missing_replaces_nan(spark):
    df = spark.createDataFrame([(float("nan"), None, 3)], "a double, b float, c long")
    assert tuple(fill_missing(df).first()) == (0.0, 0.0, 3)
