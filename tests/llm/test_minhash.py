import random

import duckdb
import numpy as np
import pytest

from canopy.llm import minhash as H
from canopy.llm.components import components
from canopy.llm.oracle import MINHASH


def test_components(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100 + rng.randint(0, 40), 100 + rng.randint(0, 40)) for _ in range(35)] + [(500, k) for k in range(501, 560)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        common = rng.integers(0, 2**63, 2000, dtype=np.uint64)
        k = int(2000 / share - 2000) // 2
        a, b = (np.concatenate([common, rng.integers(0, 2**63, k, dtype=np.uint64)]) for _ in range(2))
        x, y = (H.signature(np.unique(s), 512, 9) for s in (a, b))
        assert abs((x == y).mean() - share) < 0.06
    one = np.array([7], np.uint64)
    assert (H.signature(one, 64, 9) == H.signature(one, 64, 9)).all()


def sets(text, k):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").split(" ") if w]
    if 0 < len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, percent):
    s = {i: sets(t, k) for i, t in rows}
    ids = sorted(s)
    best = {i: i for i in ids}
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b])]
    while True:
        new = dict(best)
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == best:
            return {(i, len(s[i]), best[i], best[i] == i) for i in ids}
        best = new


@pytest.mark.parametrize("seed,k", [(1, 2), (2, 5)])
def test_equals_brute_force_on_groups_of_copies(docs, seed, k):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, ident = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        for _ in range(rng.choice([1, 2, 15])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5, 12])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((ident, " ".join(w.upper() if rng.random() < 0.1 else w for w in copy)))
            ident += 1
    rng.shuffle(rows)
    got = {tuple(r)[:4] for r in H.near_duplicates(docs(rows), shingle_words=k).collect()}
    assert got == brute(rows, k, 80)


def test_edges_and_sql(docs, tmp_path):
    long = " ".join(f"x{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, "a"), (4, "A "), (5, "a b c d e f g"), (5, "a b c d e f g"), (None, "a"), (8, long), (9, long + " end"), (10, " \n"), (11, "Éa é"), (12, "éa é")]
    df = docs(rows).selectExpr("*", "1 as n", "2 as bands", "3 as s1")
    out = H.near_duplicates(df, shingle_words=2).collect()
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out if r.doc_id is not None)
    assert len(out) == 12 and [(r.n_shingles, r.component_id, r.kept) for r in out if r.doc_id is None] == [(1, None, True)]
    assert got == [(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False), (5, 6, 5, True), (5, 6, 5, True), (8, 29999, 8, True), (9, 30000, 8, False), (10, 0, 10, True), (11, 1, 11, True), (12, 1, 12, True)]
    assert H.near_duplicates(docs([])).collect() == []
    kept = H.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 5, 8, 10, 11, 12]
    single = [r for r in dict(rows).items() if r[0] is not None and r[0] < 8]
    docs(single).write.parquet(f"{tmp_path}/d")
    want = duckdb.sql(MINHASH.replace("FROM documents", f"FROM '{tmp_path}/d/*.parquet'")).fetchall()
    assert sorted(want) == sorted({g for g in got if g[0] < 8})


def test_an_id_with_several_texts(docs):
    rng = random.Random(11)
    one, two, three = (" ".join(rng.choice("abcdefghij") + str(rng.randrange(900)) for _ in range(60)) for _ in range(3))
    rows = [(1, one), (1, two), (2, one + " x"), (3, two + " y"), (5, three), (5, one + " z"), (4, three + " w"), (6, "own words"), (6, "")]
    for order in (rows, rows[::-1]):
        got = [(r.doc_id, r.component_id, r.kept) for r in H.near_duplicates(docs(order)).collect()]
        assert sorted(got) == [
            (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 1, False), (5, 4, False), (6, 6, True), (6, 6, True),
        ]
    kept = H.drop_near_duplicates(docs(rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, one), (1, two), (4, three + " w"), (6, "own words"), (6, "")])
    # the second text of 7 leads a group of its own and stays, its first one is a copy
    mixed = [(1, one), (7, one + " x"), (7, two), (8, two + " y")]
    assert sorted((r.doc_id, r.text) for r in H.drop_near_duplicates(docs(mixed)).collect()) == [(1, one), (7, two)]
