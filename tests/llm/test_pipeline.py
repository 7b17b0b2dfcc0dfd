import base64
import hashlib
from collections import Counter

import public_tokenizers as P
import tiktoken

import corpus_pipeline as C
from canopy.llm import deobfuscate, mixing, quality_rules
from canopy.llm.common import documents
from tests.llm.test_minhash import brute as brute_components

D = "/root/testdata/sf0.01"


def library():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_each_stage_equals_its_brute_force_version(spark, tmp_path):
    docs = documents(spark, D)
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, D)
        if k < len(C.STAGES) - 1:
            assert out.columns == columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    seen["end"] = docs.collect()

    labels = spark.read.parquet(f"{D}/labels.parquet")
    first = {r.doc_id: r for r in seen["quality_rules"]}
    rules = quality_rules.learn_rules(documents(spark, D), labels)
    good = set()
    for r in first.values():
        s = dict(zip(quality_rules.COUNTS, quality_rules.statistics_of(r.text), strict=True))
        value = {f: s[a] / s[b] if s[b] else 0.0 for f, (a, b) in quality_rules.FEATURES.items()}
        bad = any(all((value[c.feature] > c.threshold) == c.above for c in rule) for rule in rules)
        if s["n_words"] >= 50 and 100 * s["n_repeat_words"] <= 50 * s["n_words"] and not bad:
            good.add(r.doc_id)
    assert {r.doc_id for r in seen["near_duplicates"]} == good and 0.5 < len(good) / len(first) < 1
    kept = {i for i, _, _, k in brute_components([(i, first[i].text.replace("\n", " ")) for i in good], 5, 80) if k}
    assert {r.doc_id for r in seen["personal_data"]} == kept < good
    clean = {i: deobfuscate.replaced(first[i].text) for i in kept}
    assert {r.doc_id: r.text for r in seen["source_mix"]} == clean and clean != {i: first[i].text for i in kept}
    assert all(r.n_chars == len(r.text) for r in seen["source_mix"])
    taken = mixing.shares(spark.createDataFrame(seen["source_mix"])).collect()
    times = Counter({r.doc_id: int(r.taken / r.size + 0.5) for r in taken})
    assert Counter(r.doc_id for r in seen["byte_bpe"]) == +times
    coder = library()
    assert len(seen["end"]) == len(seen["byte_bpe"])
    for r in seen["end"]:
        ids = coder.encode_ordinary(clean[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(clean[r.doc_id].encode()).hexdigest()


def test_run_applies_the_stages_to_odd_rows(spark, docs, tmp_path):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, good, "en", None), (3, good, "en", None), (None, good + " x", "en", "a"), (4, good + " a@b.co", "en", "a")]
    docs(rows).selectExpr("*", "1 as size", "2 as n_words").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = C.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {3, None} and len(got) >= 1
    docs([]).write.parquet(f"{tmp_path}/e/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/e/labels.parquet")
    assert C.run(spark, f"{tmp_path}/e").collect() == []
