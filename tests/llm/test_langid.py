"""Language mixture: held-out accuracy, what it learns from, odd rows."""

import zlib

import numpy as np

from trendengine.llm import langid as g

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, language string"


def test_held_out_accuracy_and_rows(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = g.query(spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out and docs[r.doc_id].lang]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in test)
    assert len(test) > 100 and right >= 0.97 * len(test)


def test_counts_are_those_of_all_training_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    langs, likely = g.train(docs)
    counts = {name: np.full(g.BUCKETS, 0.5) for name in langs}
    for r in docs.collect():
        if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            at, n = g.trigrams(r.text)
            counts[r.lang][at] += n
    for k, name in enumerate(langs):
        assert np.allclose(likely[:, k], counts[name] / counts[name].sum(), rtol=1e-5)


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = docs.withColumn("lang", g.F.when(g.held_out(), "zz").otherwise(g.F.col("lang")))
    assert g.train(other)[0] == g.train(docs)[0]
    assert np.array_equal(g.train(other)[1], g.train(docs)[1])


def test_mixture_finds_both_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = g.train(docs)
    text = {lang: " ".join(r.text for r in docs.where(f"lang = '{lang}'").limit(8).collect())[:6000] for lang in ("de", "es")}
    found = g.infer(text["de"] + " " + text["es"][:3000], *model)
    shares = dict(found["shares"])
    assert found["lang"] == "de" and {"de", "es"} <= set(shares) and 0.5 < shares["de"] < 0.8
    assert set(dict(g.infer(text["es"], *model)["shares"])) == {"es"}


def test_odd_rows(spark):
    train = [(i, t, lang, "s", "x") for i in range(40) for t, lang in (("the thing then there", "en"), ("ñandú señor mañana", "es"))]
    odd = [(None, "the thing", "en", None, None), (1000, None, "en", "s", "x"), (1001, "", None, "s", "x"), (1002, "123 !?", "en", "s", "x"),
           (1003, "señor " * 50_000, None, None, None), (1003, "señor " * 50_000, None, None, None)]
    docs = spark.createDataFrame(train + odd, SCHEMA)
    out = g.drop_unidentified(spark, docs)
    assert out.columns == docs.columns and out.count() == len(train) + 3
    none = docs.where("lang = 'zz'")
    assert g.drop_unidentified(spark, none).count() == 0
    unlabelled = docs.withColumn("lang", g.F.lit(None).cast("string"))
    assert {r.language_.lang for r in g.identify(spark, unlabelled, g.train(unlabelled), "language_").collect()} == {"und"}


def test_any_number_of_labels(spark, monkeypatch):
    """Counts in place of a full matrix predict the same; thousands of dirty labels are no error."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    langs, full = g.train(docs)
    monkeypatch.setattr(g, "MODEL_BYTES", len(langs) * 4 * g.BUCKETS - 1)
    names, counts = g.train(docs)
    assert names == langs and isinstance(counts, g.Counts)
    for r in docs.limit(100).collect():
        one, other = g.infer(r.text, langs, full), g.infer(r.text, langs, counts)
        assert one["lang"] == other["lang"] and abs(one["score"] - other["score"]) < 1e-3
    dirty = spark.createDataFrame([(i, f"{w} {w}{i}", f"label {i}") for i, w in enumerate(["word", "other"] * 3000)], "doc_id long, text string, lang string")
    monkeypatch.undo()
    names, model = g.train(dirty)
    assert len(names) > 4096 and g.infer("word word0", names, model)["lang"] in names


def plain_mixture(text, langs, likelihoods):
    """EM and the penalised choice, one trigram and language at a time."""
    import math

    at, counts = g.trigrams(text)
    rows = [(float(c), [float(x) for x in likelihoods[b]]) for b, c in zip(at, counts)]
    n = sum(c for c, _ in rows)

    def em(cols, shares):
        for _ in range(g.ROUNDS):
            after = [0.0] * len(cols)
            for c, p in rows:
                total = sum(s * p[k] for s, k in zip(shares, cols))
                for i, k in enumerate(cols):
                    after[i] += shares[i] * p[k] * c / total / n
            moved, shares = max(abs(a - b) for a, b in zip(after, shares)), after
            if moved < 1e-3:
                break
        return shares, sum(c * math.log(sum(s * p[k] for s, k in zip(shares, cols))) for c, p in rows)

    shares, _ = em(range(len(langs)), [1 / len(langs)] * len(langs))
    order, best, chosen = sorted(range(len(langs)), key=lambda k: -shares[k]), -math.inf, None
    for k in range(1, len(langs) + 1):
        start = [max(shares[i], 1e-6) for i in order[:k]]
        part, fit = em(order[:k], [s / sum(start) for s in start])
        fit -= g.PENALTY * math.log(n + 1) * k
        if fit <= best:
            break
        best, chosen = fit, dict(zip(order[:k], part))
    top = min(chosen, key=lambda i: (-chosen[i], i))
    return langs[top], chosen[top]


def test_query_is_the_plain_mixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = g.train(docs)
    found = {r.doc_id: r for r in g.query(spark, "/root/testdata/sf0.001").collect()}
    for r in docs.collect():
        if not any(c.isalpha() for c in r.text or ""):
            assert found[r.doc_id].lang_pred == "und"
            continue
        lang, score = plain_mixture(r.text, *model)
        assert found[r.doc_id].lang_pred == lang and abs(found[r.doc_id].score - score) < 1e-6
