import random
import re

import pytest
from pyspark.sql import functions as F

from canopy.llm import deobfuscate as D

SLOW = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute(text):
    out = []
    for kind, pattern in SLOW.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and D.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda x: (x[1], D.KINDS.index(x[0])))


@pytest.mark.parametrize("seed", range(40))
def test_base_spans_equal_the_plain_patterns(seed):
    rng = random.Random(seed)
    parts = ["a", "b.c", "@", ".", "+", "-", " ", "1", "255", "256.1", "4111 1111 1111 1111", "4111111111111111", "(0)", "x@y.z", "٣", "é", "%", "1.2.3.4", "\n"]
    for _ in range(60):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert D.detect(text) == brute(text)
        spans = D.all_spans(text)
        assert [s[:3] for s in spans if s[3]] == brute(text)
        assert all(0 <= s < e <= len(text) for _, s, e, _ in spans)


CASES = [
    ("mail bob [at] mail [dot] com.", "email", "bob [at] mail [dot] com"),
    ("mail bob at mail dot com now", "email", "bob at mail dot com"),
    ("x user(at)ex.org y", "email", "user(at)ex.org"),
    ("x user@ex{dot}org y", "email", "user@ex{dot}org"),
    ("x ｂob＠mail.com y", "email", "ｂob＠mail.com"),
    ("x bоb@mail.com y", "email", "bоb@mail.com"),
    ("call plus one five five five one two three four five six seven ok", "phone", "plus one five five five one two three four five six seven"),
    ("ip one nine two dot one six eight dot one dot two y", "ip", "one nine two dot one six eight dot one dot two"),
    ("four one one one 1111 1111 1111 it is", "card", "four one one one 1111 1111 1111"),
    ("+٤٤ 20 7946 0958 é", "phone", "+٤٤ 20 7946 0958"),
    ("１９２.168.1.1", "ip", "１９２.168.1.1"),
]


@pytest.mark.parametrize("text,kind,want", CASES)
def test_disguises_map_back_to_the_source(text, kind, want):
    assert (kind, want) in [(k, text[s:e]) for k, s, e, base in D.all_spans(text) if not base]
    assert want not in D.replaced(text) and f"<{kind.upper()}>" in D.replaced(text)


def test_clean_prose_has_no_spans():
    for text in (
        "We met at home at two, the one dot on the map. One or two of them (at least three) agreed.",
        "Version 2 point 1, pages 10-20, in 1999–2004 at noon; look at example.com",
        "Née à Paris, elle a vu l’été – und die Größe…",
    ):
        assert D.all_spans(text) == [] and D.replaced(text) == text


def test_linear_on_long_runs():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 150_000, "one " * 60_000, "[at] " * 50_000):
        D.all_spans(text)


def test_operator_edges(docs):
    long = "word " * 30000 + "a@b.co"
    df = docs([(1, None), (2, ""), (3, "a@b.co"), (3, "a@b.co"), (None, "+1 555 123 4567"), (4, long)]).selectExpr("*", "'x' as spans")
    rows = D.find(df).select("doc_id", D.span_list(F.col("spans")).alias("s")).collect()
    got = sorted((r.doc_id or 0, r.s) for r in rows)
    assert got == [(0, "phone:0:15"), (1, ""), (2, ""), (3, "email:0:6"), (3, "email:0:6"), (4, "email:150000:150006")]
    assert D.find(docs([])).collect() == []
    out = D.redact(df)
    assert out.columns == df.columns and {r.doc_id: r.text for r in out.collect()}[3] == "<EMAIL>"
    assert {r.doc_id: r.text for r in out.collect()}[1] is None
