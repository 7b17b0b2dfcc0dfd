import hashlib
import random
import re

import duckdb
import pytest

from canopy.llm import lz_dedup as L
from canopy.llm.oracle import LZ_DEDUP

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    first = {}
    words = {i: W.findall(t or "") for i, t in rows if i is not None}
    for i in sorted(words):
        for s in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][s : s + window]), (i, s))
    out = []
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (i, s):
                gone |= set(range(s, s + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(docs, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(rng.choice([2, 3, 500]))]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(15, 60))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p))
            words += rng.choice([p, p[:cut], p[cut:], [rng.choice(vocabulary) for _ in range(rng.randint(1, 40))]])
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    rng.shuffle(rows)
    df = docs(rows).repartition(5)
    got = sorted(tuple(r)[:4] for r in L.remove_repeats(df).collect())
    assert got == brute(rows)
    # slices and Arrow batches of any size give the same
    if seed:
        return
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert sorted(tuple(r)[:4] for r in L.remove_repeats(df).collect()) == got
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_factors_point_to_equal_earlier_words(docs):
    base = [f"a{k}" for k in range(100)]
    rows = [(1, " ".join(base)), (2, "x " + " ".join(base[10:70]) + " y"), (3, " ".join(base[:50] + ["z"] + base[50:]))]
    out = {r.doc_id: r for r in L.remove_repeats(docs(rows), text=True).collect()}
    text = {i: t.split() for i, t in rows}
    for i, r in out.items():
        for f in r.factors:
            assert f.words >= 20 and text[f.ref_doc][f.ref_start : f.ref_start + f.words] == text[i][f.start : f.start + f.words]
            assert (f.ref_doc, f.ref_start) < (i, f.start)
    assert out[2].kept == "x y" and out[2].n_removed == 60 and out[3].kept == "z" and out[1].n_removed == 0


def test_edges_and_sql(docs, tmp_path):
    long = " ".join(f"v{k % 7000}" for k in range(30000))
    line = "same line again and again of just ten words here ok\n"
    rows = [(1, None), (2, ""), (3, "a b"), (4, line * 500), (5, long), (6, " ".join(map(str, range(20)))), (7, " ".join(map(str, range(20)))), (8, " ".join(map(str, range(19)))), (9, "é " * 40)]
    df = docs([*rows, (None, long), (7, rows[6][1])]).selectExpr("*", "1 as doc", "2 as factors")
    out = L.remove_repeats(df).collect()
    got = sorted(tuple(r)[:4] for r in out if r.doc_id is not None)
    assert len(out) == 11 and sorted(set(got)) == brute(rows) and got.count(got[6]) == 2
    assert [(r.n_words, r.n_removed) for r in out if r.doc_id is None] == [(30000, 0)]
    assert L.remove_repeats(docs([])).collect() == []
    docs(rows).write.parquet(f"{tmp_path}/d")
    want = duckdb.sql(LZ_DEDUP.replace("FROM documents", f"FROM '{tmp_path}/d/*.parquet'")).fetchall()
    assert sorted(want) == brute(rows)
