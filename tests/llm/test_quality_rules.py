import random
import re

import numpy as np
import pytest

from canopy.llm import quality_rules as Q
from canopy.llm.common import documents

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = W.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if W.search(x)]
    return (
        len(words),
        sum(len(w) for w in words),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered),
    )


@pytest.mark.parametrize("seed", range(20))
def test_counts_equal_brute_force(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["a", "b", "c ", " ", "\n", "\n\n", "# ", "é ", "\t", " ", "x|"]) for _ in range(150))
    assert Q.statistics_of(text)[:5] == brute(text)


def test_covering_learns_planted_rules_and_only_those():
    rng = np.random.default_rng(3)
    table = {f: rng.random(4000) for f in Q.FEATURES}
    bad = (table["upper_share"] > 0.8) | ((table["symbols_per_word"] > 0.7) & (table["digit_share"] <= 0.4))
    rules = Q.cover_rules(table, bad, max_rules=12, max_conditions=4, min_precision=0.9, min_cover=8, seed=1)
    got = np.zeros(4000, bool)
    for r in rules:
        got |= Q.covers(r, table)
    assert (got == bad).mean() > 0.99 and len(rules) <= 4
    noise = rng.random(4000) < 0.3
    assert Q.cover_rules(table, noise, max_rules=12, max_conditions=4, min_precision=0.9, min_cover=8, seed=1) == []


def test_rules_on_the_tables_catch_junk_and_keep_clean_documents(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = Q.judge(documents(spark, d), labels, max_labelled=1500).join(labels, "doc_id").select("quality", "kept", "base_failed").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.995 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_expression_is_ordered():
    a = (Q.Condition("upper_share", True, 0.5),)
    b = (Q.Condition("digit_share", False, 0.1), Q.Condition("upper_share", False, 0.9))
    table = {"upper_share": np.array([0.6, 0.2, 0.2]), "digit_share": np.array([0.0, 0.0, 0.3])}
    assert [Q.covers(r, table).tolist() for r in (a, b)] == [[True, False, False], [True, True, False]]


def test_edges(spark, docs):
    good = " ".join(f"word{i}" for i in range(60))
    df = docs([(1, None), (2, ""), (3, good), (3, good), (None, good), (4, "x y " * 50000)]).selectExpr("*", "1 as n_words", "'a' as _x")
    labels = spark.createDataFrame([(3, None), (None, 0)], "doc_id long, quality int")
    rows = sorted(((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in Q.judge(df, labels).collect()))
    assert rows == [(0, 60, False, True), (1, 0, True, False), (2, 0, True, False), (3, 60, False, True), (3, 60, False, True), (4, 100000, True, False)]
    kept = Q.keep_good(df, labels)
    assert kept.columns == df.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 3]
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.judge(docs([]), none).collect() == []
