import zlib

from pyspark.sql import functions as F

from canopy.llm.common import documents
from canopy.llm.language_id import Model, fit, held_out, predict


def test_accuracy_on_held_out_documents(spark):
    docs = documents(spark, "/root/testdata/sf0.1")
    model = fit(docs.where(~held_out()))
    rows = predict(docs.where(held_out()), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) < 0.05 * len(rows)
    again = fit(docs.where(~held_out()).repartition(7))
    assert again.languages == model.languages and abs(again.centroids - model.centroids).max() < 1e-5


def test_nothing_is_learned_from_held_out_rows_or_their_columns(spark, docs):
    base = [(i, "the cat and the dog " * 5 if i % 2 else "der hund und die katze " * 5, "en" if i % 2 else "de") for i in range(40)]
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert held == [r.doc_id for r in docs(base).where(held_out()).orderBy("doc_id").collect()]
    changed = [(i, t, "xx") if i in held else (i, t, lang) for i, t, lang in base]
    a, b = (fit(docs(x).where(~held_out())) for x in (base, changed))
    assert a.languages == b.languages and (a.centroids == b.centroids).all()


def test_against_a_plain_version(docs):
    """Counts, weights and cosines by dictionaries; the centroids are the model's."""
    import math
    from collections import Counter

    import numpy as np

    from canopy.llm import language_id

    rows = [(i, f"the cat {i} and the dog" if i % 2 else f"der hund {i} und die katze", "en" if i % 2 else "de") for i in range(30)]
    model = fit(docs(rows))
    texts = ["the dog and a katze", "die katze", "word"]
    grams = language_id.gram_counts([t.encode() for t in texts])
    x = language_id.vectors(grams, model.idf)
    dense = np.asarray(x.todense()) if hasattr(x, "todense") else np.asarray(x)
    assert np.allclose((dense * dense).sum(axis=1), 1, atol=1e-5)
    cosines = dense @ np.asarray(model.centroids).T
    got = {r.doc_id: r for r in predict(docs([(i, t) for i, t in enumerate(texts)]), model).collect()}
    for i in range(len(texts)):
        best = int(np.argmax([math.fsum(a * b for a, b in zip(dense[i], c, strict=True)) for c in np.asarray(model.centroids)]))
        assert np.isclose(cosines[i].max(), cosines[i][best], atol=1e-5)
        assert got[i].lang_pred == model.languages[best]
    assert Counter(r.lang_pred for r in got.values())["en"] >= 1


def test_repeated_rows_count_once_and_the_sample_is_bounded(docs):
    rows = [(1, "the cat and the dog", "en")] * 50 + [(1, f"other text {k}", "en") for k in range(5)]
    once = rows[:1] + rows[50:]
    a, b = fit(docs(rows), sample_rows=3), fit(docs(rows), sample_rows=3)
    assert (a.centroids == b.centroids).all()
    assert len(fit(docs(once), sample_rows=6).languages) == fit(docs(rows), sample_rows=6).languages.__len__()


def test_edges(docs):
    rows = [(i, "the cat and the dog saw it", "en") for i in range(5)] + [(9, "le chat et le chien sont ici", "fr"), (10, "x", None)]
    model = fit(docs(rows))
    assert set(model.languages) == {"en", "fr"}
    df = docs([(1, None), (2, ""), (3, "12 34 !"), (4, "the dog"), (4, "the dog"), (None, "le chien"), (5, "the cat " * 50000), (6, "漢字かな")])
    df = df.selectExpr("*", "'z' as lang_pred", "1 as score")
    got = {(r.doc_id, r.lang_pred) for r in predict(df, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "fr"), (5, "en")} <= got
    assert predict(df, model).count() == 8
    far = [r for r in predict(df, model).collect() if r.doc_id == 6][0]
    assert far.rejected and far.lang_pred in ("en", "fr")
    empty = fit(docs([]))
    assert isinstance(empty, Model) and not empty.languages
    assert {r.lang_pred for r in predict(df, empty).collect()} == {"und"}
    assert predict(docs([]), model).collect() == []
