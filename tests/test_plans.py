"""Plan shape: no nested-loop or cartesian joins anywhere, pushdown and pruning at the scans."""

import contextlib
import io

import pytest

from canopy.operators import _lineage

from .conftest import SF001

BAD = ("BroadcastNestedLoopJoin", "CartesianProduct")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture()
def recorded(monkeypatch):
    """Record the plan of every frame the level loops store."""
    seen = []
    real = _lineage.durable

    def spy(df, count=False):
        seen.append(plan_text(df))
        return real(df, count)

    import canopy.operators.predict as r
    import canopy.operators.prepare as i
    import canopy.operators.quantiles as q
    import canopy.operators.tree as t
    import canopy.plans.end_to_end as p

    for mod in (_lineage, q, t, p, r, i):
        monkeypatch.setattr(mod, "durable", spy)
    return seen


def test_no_cross_joins_in_any_query(spark, recorded):
    from canopy.plans.queries import QUERIES

    for name, fn in QUERIES.items():
        text = plan_text(fn(spark, SF001))
        assert not any(b in text for b in BAD), name
    assert recorded, "level loops were exercised"
    for text in recorded:
        assert not any(b in text for b in BAD), text[:2000]


def scans(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_scan_pruning_and_pushdown(spark):
    from canopy.plans.queries import q_class_counts, q_path_filter, q_text_length

    # only the two columns the length needs are read from documents
    text = scans(q_text_length(spark, SF001))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text and "ReadSchema: struct<doc_id:bigint>" in text
    assert text.count("ReadSchema") == 2  # documents, and the key of labels
    # the path's equality on o_orderstatus and r_name reaches the scans of orders and region
    text = scans(q_path_filter(spark, SF001))
    assert "EqualTo(o_orderstatus,F)" in text and "EqualTo(r_name,ASIA)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in text
    # counting classes reads no column of customer but its keys, and nothing of the value that is binned
    text = scans(q_class_counts(spark, SF001))
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in text and "l_extendedprice" not in text


def test_lean_queries_start_few_jobs(spark):
    from canopy.plans.queries import q_class_counts, q_distinct_values

    sc = spark.sparkContext
    for fn, tables in ((q_class_counts, 5), (q_distinct_values, 2)):
        sc.setJobGroup(fn.__name__, fn.__name__)
        fn(spark, SF001)
        # before the result is asked for, only the tables' schemas are read
        assert len(sc.statusTracker().getJobIdsForGroup(fn.__name__)) <= tables
        sc.setJobGroup("", "")


def test_tree_jobs_depend_on_levels_not_nodes(spark):
    import random

    from canopy.operators.tree import grow_tree

    sc = spark.sparkContext

    def jobs_for(card, seed):
        rnd = random.Random(seed)
        rows = [tuple(f"v{rnd.randrange(card)}" for _ in range(3)) + (rnd.random() < 0.5,) for _ in range(3000)]
        df = spark.createDataFrame(rows, "a string, b string, c string, y boolean")
        group = f"jobs-{card}"
        sc.setJobGroup(group, group)
        tree = grow_tree(df, ["a", "b", "c"], "y")
        n_nodes = tree.count()
        depth = tree.agg({"depth": "max"}).first()[0]
        n_jobs = len(sc.statusTracker().getJobIdsForGroup(group))
        sc.setJobGroup("", "")
        return n_nodes, depth, n_jobs

    small = jobs_for(2, 1)
    large = jobs_for(9, 2)
    assert small[1] == large[1] == 3  # same number of levels
    assert large[0] > 20 * small[0]  # far more nodes
    assert abs(large[2] - small[2]) <= 4  # about the same number of jobs
