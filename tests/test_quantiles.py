import random

import pytest
from pyspark.sql import functions as F

from canopy.operators.discretize import BIN_LABELS, bin_quartiles, quartile_cuts, quartile_cuts_approx
from canopy.operators.prepare import row_index
from canopy.operators.quantiles import exact_quantiles


def disc(values, p):
    """percentile_disc: the value at 1-based rank ceil(p·n)."""
    import math

    s = sorted(values)
    k = max(math.ceil(p * len(s)), 1)
    return s[k - 1]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_quantiles_match_percentile_disc(spark, seed):
    rnd = random.Random(seed)
    n = rnd.randint(1, 3000)
    hot = rnd.random() * 100
    vals = [hot if rnd.random() < 0.35 else float(rnd.randint(0, 500)) for _ in range(n)]  # a third on one value
    rows = [(rnd.choice("ab"), v) for v in vals]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.1, 0.25, 0.5, 0.75, 0.99]
    got = {r["g"]: [r[f"q{i}"] for i in range(len(probs))] for r in exact_quantiles(df, "v", probs, by=["g"], ranges=8, range_rows=20).collect()}
    for g in "ab":
        vs = [v for gg, v in rows if gg == g]
        if vs:
            assert got[g] == [disc(vs, p) for p in probs]
    # agrees with Spark's own percentile_disc too
    spark_disc = df.groupBy("g").agg(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY v)").alias(f"q{i}") for i, p in enumerate(probs)])
    for r in spark_disc.collect():
        assert got[r["g"]] == [r[f"q{i}"] for i in range(len(probs))]


def test_exact_quantiles_weighted_and_ungrouped(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (5.0, 4), (None, 9)], "v double, w long")
    r = exact_quantiles(df, "v", [0.25, 0.5, 0.75], weight="w").first()
    flat = [1.0] * 3 + [2.0] + [5.0] * 4
    assert list(r) == [disc(flat, p) for p in (0.25, 0.5, 0.75)]


def test_bins_and_cuts(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("body_len"))
    cuts = tuple(quartile_cuts(df).first())
    assert cuts == (250.0, 500.0, 750.0)
    binned = bin_quartiles(df, cuts).groupBy("review_body").count()
    assert {r[0]: r[1] for r in binned.collect()} == {BIN_LABELS[0]: 250, BIN_LABELS[1]: 250, BIN_LABELS[2]: 250, BIN_LABELS[3]: 250}


def test_approx_quartiles_with_large_error_return_extremes(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("body_len"))
    q1, q2, q3 = quartile_cuts_approx(df, "body_len", 0.3)
    assert (q1, q3) == (1.0, 1000.0)
    assert 200 <= q2 <= 800


def test_row_index_is_consecutive(spark):
    rnd = random.Random(7)
    keys = rnd.sample(range(10**9), 5000)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    got = sorted((r.row_index, r.k) for r in row_index(df, "k").collect())
    assert [i for i, _ in got] == list(range(5000))
    assert [k for _, k in got] == sorted(keys)


def test_exact_quantiles_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(
        st.lists(st.tuples(st.integers(-50, 50), st.integers(1, 5)), min_size=1, max_size=60),
        st.lists(st.floats(0.01, 1.0), min_size=1, max_size=4),
        st.integers(2, 9),
    )
    def check(pairs, probs, buckets):
        df = spark.createDataFrame([(float(v), w) for v, w in pairs], "v double, w long")
        got = list(exact_quantiles(df, "v", probs, weight="w", ranges=buckets, range_rows=3).first())
        flat = [float(v) for v, w in pairs for _ in range(w)]
        assert got == [disc(flat, p) for p in probs]

    check()


def test_bucket_lookup_tree_equals_filter_form(spark):
    from canopy.operators.quantiles import bucket_of

    rnd = random.Random(9)
    bounds = sorted(rnd.choice([1.0, 2.0, 2.0, 5.5, 7.0, 7.0, 7.0, 10.0]) for _ in range(13))
    vals = [0.0, 1.0, 2.0, 2.5, 7.0, 7.0001, 10.0, 11.0, float("nan")] + [rnd.uniform(-1, 12) for _ in range(200)]
    df = spark.createDataFrame([(v, bounds) for v in vals], "v double, b array<double>")
    arr = F.array(*[F.lit(b) for b in bounds])
    slow = F.size(F.filter(arr, lambda b: b < F.col("v")))
    got = df.select(
        bucket_of(F.col("v"), bounds).alias("lit"), bucket_of(F.col("v"), F.col("b"), len(bounds)).alias("col"), slow.alias("ref")
    ).collect()
    assert all(r.lit == r.ref == r.col for r in got)


def test_quantiles_narrow_down_without_limits(spark):
    rnd = random.Random(3)
    vals = [rnd.gauss(0, 1) for _ in range(4000)] + [0.5] * 3000 + [None, float("nan")]
    df = spark.createDataFrame([(v, None) for v in vals], "v double, g string")
    probs = [0.01, 0.25, 0.5, 0.7, 0.999, 1.0]
    want = [disc(vals[:7000], p) for p in probs]
    # two ranges a round and at most one row to sort: every answer is narrowed down to its own value
    assert list(exact_quantiles(df, "v", probs, ranges=2, range_rows=1).first()) == want
    assert list(exact_quantiles(df, "v", probs, ranges=16, range_rows=50).first()) == want
    # a null group is a group
    assert list(exact_quantiles(df, "v", probs, by=["g"], ranges=16, range_rows=50).first()) == [None, *want]
    assert exact_quantiles(df.where("v > 99 and not isnan(v)"), "v", probs).collect() == []


def test_null_and_nan_values_have_no_bin(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (5.0,)], "body_len double")
    got = [r.review_body for r in bin_quartiles(df, (1.0, 2.0, 3.0)).collect()]
    assert got == [None, None, BIN_LABELS[3]]


def test_row_index_of_text_date_and_hot_keys(spark):
    import datetime

    rnd = random.Random(5)
    n = 6000
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(10**6)}", datetime.date(2000, 1, 1) + datetime.timedelta(rnd.randrange(3000)), i) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, d date, _place long").repartition(5)
    for key in ("k", "d"):
        got = sorted((r.row_index, r[key]) for r in row_index(df, key).collect())
        assert [i for i, _ in got] == list(range(n)) and [k for _, k in got] == sorted(r[0 if key == "k" else 1] for r in rows)
    spread = df.repartitionByRange(8, "k", "d", "_place").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in spread) < 0.3 * n  # the hot key is cut by the other columns


def test_buckets_by_binary_search(spark):
    from canopy.operators.quantiles import _with_bucket, bucket_of

    values = [-5.0, 0.0, 1.0, 1.5, 2.0, 7.0, 7.5, 9.0, 1e9]
    for bounds in ([1.0], [0.0, 1.0], [1.0, 1.0, 2.0, 7.0, 9.0], [float(b) for b in range(7)]):
        df = spark.createDataFrame([(v, bounds) for v in values], "v double, b array<double>")
        got = _with_bucket(df, "v", "b", len(bounds), "k").select("k", bucket_of(F.col("v"), bounds).alias("want")).collect()
        assert [r.k for r in got] == [r.want for r in got] == [sum(b < v for b in bounds) for v in values]


def test_the_lines_are_shuffled_once(spark):
    """Whatever is too large to broadcast: the lines join last, as they are."""
    from canopy.plans.fixtures import fixture_l
    from tests.conftest import SF001

    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixture_l(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert "l_orderkey" in joins[0] and not any("l_orderkey" in j for j in joins[1:])
