"""Hard negatives against a plain search through all rows; the curve and the bounds by themselves."""

import math
import random
from itertools import pairwise, product

import numpy as np
import pytest

from canopy.llm.hard_negatives import bounds, hilbert_keys, mine

SCHEMA = "vec_id long, embedding array<float>, label int, position string"


def plain(rows, positives=5, negatives=3, low=50, high=95):
    used = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            used.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    found = []

    def first(anchor, keep):
        scored = [(sum(a * b for a, b in zip(anchor[1], v, strict=False)), i) for i, v, label in used if i != anchor[0] and keep(label)]
        return sorted(scored, key=lambda x: (-x[0], x[1] is None, x[1] or 0))

    for anchor in used:
        if anchor[0] is None or anchor[0] % 50:
            continue
        others = first(anchor, lambda label: label != anchor[2])
        for p, positive in first(anchor, lambda label: label == anchor[2])[:positives]:
            near = [(n, i) for n, i in others if low * p <= 100 * n <= high * p][:negatives]
            found += [(anchor[0], positive, r + 1, i, p, n) for r, (n, i) in enumerate(near)]
    return sorted(found, key=str)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in mine(df, lambda i: i % 50 == 0, **how).collect()), key=str)


def drawn(n, dims=6, labels=3, scale=1.0, seed=1, copies=0.3):
    draw = random.Random(seed)
    centre = [draw.gauss(0, scale) for _ in range(dims)]
    rows = []
    for i in range(n):
        near = [float(np.float32(c + draw.gauss(0, scale / 2))) for c in centre]
        rows.append((i, centre if draw.random() < copies else near, draw.randrange(labels)))
    return rows


def test_curve_visits_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 1)):
        cells = np.array(list(product(range(1 << bits), repeat=dims)))
        order = sorted(range(len(cells)), key=lambda k: hilbert_keys(cells, bits)[k])
        assert all(np.abs(cells[a] - cells[b]).sum() == 1 for a, b in pairwise(order))


def test_bounds_hold():
    draw = np.random.default_rng(0)
    vectors = draw.integers(-50, 50, (40, 7)).astype(float)
    asks = draw.integers(-50, 50, (9, 7)).astype(float)
    least, greatest = bounds(asks, vectors.min(axis=0)[None], vectors.max(axis=0)[None])
    scores = asks @ vectors.T
    assert (scores >= least).all() and (scores <= greatest).all()


@pytest.mark.parametrize(
    "how",
    [{}, {"block_rows": 7, "batch_rows": 2, "group_blocks": 3}, {"block_rows": 50, "bits": 5, "low": 0, "high": 100, "positives": 2, "negatives": 9}],
)
def test_against_plain_search(spark, how):
    rows = drawn(400)
    asked = {k: how[k] for k in ("low", "high", "positives", "negatives") if k in how}
    wanted = plain(rows, **asked)
    assert len(wanted) > 40
    assert mined(spark, rows, **how) == wanted


def test_rows_that_take_no_part_and_odd_ones(spark):
    rows = drawn(300, dims=4, seed=3)
    rows[5:5] = [(50, rows[0][1], None), (51, None, 1), (52, [1.0, None, 2.0, 0.5], 1), (100, [float("nan")] * 4, 1), (53, [float("inf"), 0.0, 0.0, 0.0], 1)]
    rows += [(None, [1.0, 0.5, 1.0, 0.25], 0), (None, [1.0, 0.5, 1.0, 0.25], 1), (150, [2.0, 1.0], 1), (400, [], 1), (150, rows[0][1], 0), (7, rows[0][1], 2)]
    assert mined(spark, rows, block_rows=32) == plain(rows)


def test_beyond_double_precision(spark):
    rows = drawn(120, dims=3, scale=1e5, seed=4, copies=0)
    assert mined(spark, rows) == plain(rows)
    rows[3] = (3, [1e30, 0.0, 0.0], 1)
    with pytest.raises(ValueError, match="64 bits"):
        mined(spark, rows)


def test_empty_and_lonely(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]) == plain([(0, [], 1), (1, [], 1), (2, [], 2)]) == [(0, 1, 1, 2, 0, 0)]
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
