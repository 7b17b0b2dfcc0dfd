import math

import numpy as np
import pytest

from canopy.llm import nn_descent
from canopy.llm.nn_descent import centres, homes, nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, step, k=20):
    x = {}
    for i, v, *_ in rows:
        if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            x[i] = np.array(np.array(v, np.float32), np.float64)
    dims = [len(v) for v in x.values()]
    x = {i: v for i, v in x.items() if len(v) == max(set(dims), key=lambda d: (dims.count(d), -d))}
    out = {}
    for q in x:
        if q % step == 0:
            near = sorted(((-float((x[q] * x[i]).sum()), i) for i in x if i != q))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def recall(got, want):
    hits = total = 0
    for q, near in want.items():
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        hits += len({r.vec_id for r in mine} & {i for i, _ in near})
        total += len(near)
    return hits / total


@pytest.mark.parametrize("scaled", [False, True])
def test_recall_and_exact_scores(spark, scaled):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if scaled:
        x *= rng.uniform(0.2, 3, (1500, 1))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x.astype(np.float32))]
    rows += [(5000 + i, rows[7][1], 0) for i in range(60)]  # a hot vector
    df = spark.createDataFrame(rows, SCHEMA)
    got = nearest(df, lambda i: i % 50 == 0, degree=12, leaf=64, beam=80, width=32, entries=64, starts=8).collect()
    want = brute(rows, 50)
    assert recall(got, want) >= 0.9
    value = {i: np.array(np.array(v, np.float32), np.float64) for i, v, _ in rows}
    assert all(abs(r.score - float((value[r.query_id] * value[r.vec_id]).sum())) < 1e-12 for r in got)


def unit(rng, n, dims):
    x = rng.standard_normal((n, dims))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vector_rows(x):
    return [(i, v.tolist(), 0) for i, v in enumerate(x.astype(np.float32))]


@pytest.mark.parametrize("longest", [30, 1000])
def test_one_long_vector_takes_nothing_from_the_others(spark, longest):
    x = unit(np.random.default_rng(6), 2000, 24)
    x[77] *= longest
    rows = vector_rows(x)
    got = nearest(spark.createDataFrame(rows, SCHEMA), lambda i: i % 50 == 0, entries=64, starts=8).collect()
    assert recall(got, brute(rows, 50)) >= 0.97


def test_near_copies_are_told_apart(spark):
    rng = np.random.default_rng(7)
    x = unit(rng, 2000, 24)
    x[1000:] = x[1000] + 0.001 * rng.standard_normal((1000, 24))
    rows = vector_rows(x)
    got = nearest(spark.createDataFrame(rows, SCHEMA), lambda i: i % 50 == 0).collect()
    assert recall(got, brute(rows, 50)) >= 0.95


def test_closed_groups_that_no_entry_point_lies_in(spark):
    rng = np.random.default_rng(8)
    x = np.repeat(unit(rng, 50, 24), 40, axis=0) + 0.02 * rng.standard_normal((2000, 24))
    rows = vector_rows(x)
    got = nearest(spark.createDataFrame(rows, SCHEMA), lambda i: i % 50 == 0, degree=12, leaf=64, beam=80, entries=16, starts=8).collect()
    assert recall(got, brute(rows, 50)) >= 0.95


def test_search_goes_on_until_nothing_is_open(spark):
    rows = vector_rows(unit(np.random.default_rng(9), 600, 24))
    got = nearest(spark.createDataFrame(rows, SCHEMA), lambda i: i % 50 == 0, degree=6, leaf=64, beam=60, width=6, entries=4, starts=4).collect()
    assert recall(got, brute(rows, 50)) >= 0.9


def test_edges(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]), (40, [math.nan, 1.0]), (8, [math.inf, 1.0]), (60, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (80, [-1.0, 0.5]), (80, [-1.0, 0.5])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).selectExpr("*", "1 as query_id", "2 as rank")
    got = {q: [(r.vec_id, r.score) for r in sorted((r for r in nearest(df, lambda i: i % 20 == 0).collect() if r.query_id == q), key=lambda r: r.rank)] for q in (0, 20, 40, 60, 80)}
    want = brute([(i, v) for i, v in rows], 20)
    assert got[40] == got[60] == [] and {q: v for q, v in got.items() if v} == want
    assert want[0][:2] == [(3, 1.0), (20, 1.0)]
    assert nearest(spark.createDataFrame([], SCHEMA), lambda i: i % 20 == 0).collect() == []
    one = spark.createDataFrame([(20, [1.0, 2.0], 0)], SCHEMA)
    assert nearest(one, lambda i: i % 20 == 0).collect() == []


def test_cells_hold_every_vertex_once_and_large_ones_are_cut(spark):
    x = unit(np.random.default_rng(10), 900, 8)
    x[:600] = x[0] + 0.01 * x[:600]  # one cell owns most vertices
    nodes = spark.createDataFrame([(i, bytearray(v.astype("<f4").tobytes())) for i, v in enumerate(x)], "id long, point binary")
    means = centres(x[-300:], 4)
    rows = homes(nodes, means, "<f4", 100).collect()
    assert sorted(r.id for r in rows) == list(range(900))
    cell = np.argmax(x.astype("<f4") @ means.T - (means * means).sum(axis=1) / 2, axis=1)
    assert all(r.block % 4 == cell[r.id] for r in rows)
    size = {b: sum(r.block == b for r in rows) for b in {r.block for r in rows}}
    assert max(size.values()) < 200 and len(size) >= 9


def test_later_rounds_look_at_more_of_a_beam(spark, monkeypatch):
    rounds, stored = [], nn_descent.stored
    monkeypatch.setattr(nn_descent, "stored", lambda df, name: (rounds.append(name), stored(df, name))[1])
    rows = vector_rows(unit(np.random.default_rng(9), 600, 24))
    got = nearest(spark.createDataFrame(rows, SCHEMA), lambda i: i % 50 == 0, degree=6, leaf=64, beam=60, width=6, entries=600, starts=4).collect()
    assert recall(got, brute(rows, 50)) >= 0.9
    assert 2 <= rounds.count("ann-beams") <= 10  # of 60 places 6 a round: more than 10
