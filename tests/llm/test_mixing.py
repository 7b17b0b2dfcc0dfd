import random

import duckdb
import pytest

from canopy.llm import mixing as M
from canopy.llm.oracle import MIXING


def highest_quotients(votes, seats):
    won = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda k: (votes[k] / (2 * won[k] + 1), -k))
        won[best] += 1
    return won


@pytest.mark.parametrize("seed", range(3))
def test_apportion_equals_handing_out_seat_by_seat(spark, seed):
    rng = random.Random(seed)
    groups = {g: [rng.choice([0, 1, 1, 2, 7, rng.randint(1, 10_000)]) for _ in range(rng.randint(1, 30))] for g in "abc"}
    seats = {g: rng.randint(0, 200) for g in groups}
    rows = [(g, k, v, seats[g], sum(vs)) for g, vs in groups.items() for k, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "g string, k int, v long, seats int, total long")
    out = M.apportion(df, ["g"], "k", "v", "seats", "total", "won").collect()
    for g, vs in groups.items():
        got = [r.won for r in sorted((r for r in out if r.g == g), key=lambda r: r.k)]
        assert got == (highest_quotients(vs, seats[g]) if sum(vs) else [0] * len(vs))


def water_fill(sizes, weights, cap):
    target, stopped = [0.0] * len(sizes), set()
    while True:
        rest = sum(sizes) - sum(cap * sizes[k] for k in stopped)
        open_weight = sum(w for k, w in enumerate(weights) if k not in stopped)
        target = [cap * s if k in stopped else weights[k] * rest / open_weight for k, s in enumerate(sizes)]
        above = {k for k, t in enumerate(target) if k not in stopped and t > cap * sizes[k] + 1e-9}
        if not above:
            return target
        stopped |= above


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_takes(spark, docs, seed):
    rng = random.Random(seed)
    names = ["b", "a", None, "é", "z", "B"][: rng.randint(1, 6)]
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 3, rng.randint(1, 80)])), "en", names[min(int(rng.expovariate(1)), len(names) - 1)]) for i in range(300)]
    df = docs(rows)
    out = M.shares(df, shard_rows=40).join(df.select("doc_id", "source"), "doc_id").collect()
    assert sorted(r.size for r in out) == sorted(len(r[1].split()) for r in rows)
    order = sorted({r.source for r in out}, key=lambda s: (s is None, s or ""))
    size = {s: sum(r.size for r in out if r.source == s) for s in order}
    want = water_fill([size[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 3)
    for s, t in zip(order, want, strict=True):
        own = [r for r in out if r.source == s]
        assert all(abs(r.target - t) < 1e-6 and r.source_size == size[s] for r in own)
        shards = len(own) / 40 + 1
        assert abs(sum(r.taken for r in own) - t) <= 3 * 4 * shards + 4  # the last block of a shard may be short
    assert all(0 <= r.taken <= 3 * r.size for r in out)
    assert sorted(out) == sorted(M.shares(df.repartition(5), shard_rows=40).join(df.select("doc_id", "source"), "doc_id").collect())


def test_sql_on_odd_rows(spark, docs, tmp_path):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "x y z", "en", None), (3, "x y z", "en", None), (None, "w " * 9, "en", "b"), (5, "q " * 20000, "en", "c")]
    docs(rows).write.parquet(f"{tmp_path}/d")
    want = duckdb.sql(MIXING.replace("FROM documents", f"FROM '{tmp_path}/d/*.parquet'")).fetchall()
    got = M.shares(docs(rows).selectExpr("*", "1 as size", "2 as key", "'r' as row"))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.select("doc_id", "size", "source_size", "target", "taken").collect())
    assert M.shares(docs([])).collect() == []
    assert {r.taken for r in M.shares(docs([(1, None, "en", "a")])).collect()} == {0}


def test_mixed_repeats_rows(docs):
    rows = [(i, "w " * 50, "en", "abc"[min(i // 5, 2)]) for i in range(200)]
    df = docs(rows).selectExpr("*", "'k' as key", "0 as size")
    out = M.mixed(df)
    assert out.columns == df.columns
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    t = {r.doc_id: r for r in M.shares(df).collect()}
    assert abs(n["a"] - 15) <= 1 and abs(n["b"] - 15) <= 1 and abs(sum(n.values()) - 200) <= 2 and t[0].target == 750.0


def test_mixed_loses_no_source(docs):
    rows = [(0, "w " * 40000, "en", "z"), *((i, "w " * 50, "en", "ab"[i % 2]) for i in range(1, 801))]
    taken = {r.doc_id: r.taken for r in M.shares(docs(rows)).collect()}
    assert 0 < taken[0] < 20000  # less than half of the one document of its source
    kept = [r.doc_id for r in M.mixed(docs(rows)).collect()]
    assert kept.count(0) == 1
    assert sorted(set(kept) - {0}) == sorted(i for i, t in taken.items() if i and t >= 25)


def test_no_python_in_the_plan(docs):
    df = M.shares(docs([(1, "a b", "en", "s")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

