"""The corpus pipeline against the same steps done plainly, and what the entry registers."""

import importlib
import re
import sys

import corpus_pipeline
import sentencepiece

import __spark_entry__ as entry
from tests.llm.test_decontaminate import plain as plain_passages
from tests.llm.test_simhash import plain_components, plain_fingerprint
from trendengine.llm import langid, registry, secret_scan, sentencepiece_fst

SF = "/root/testdata/sf0.001"


def plain_run(rows, bench, model):
    """doc_id to (text, lang, source, n_chars, ids) of what stays."""
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    rows = [r for r in rows if langid.infer(r["text"], *model)["lang"] != "und"]
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows}
    ids = sorted(fps)
    root = plain_components(ids, [(a, b) for a in ids for b in ids if b < a and (fps[a] ^ fps[b]).bit_count() <= 2])
    rows = [r for r in rows if root[r["doc_id"]] == r["doc_id"]]
    rows = [r for r in rows if not plain_passages(r["text"], bench)[3]]
    out = {}
    for r in rows:
        spans = [s for part in secret_scan.scan(r["text"]) for s in part]
        text, marks = r["text"], sorted({i for _, a, b in spans for i in range(a, b)})
        for start, end in reversed([(a, b) for a, b in zip([m for m in marks if m - 1 not in marks], [m + 1 for m in marks if m + 1 not in marks])]):
            text = text[:start] + secret_scan.MARK * _unions(spans, start, end) + text[end:]
        out[r["doc_id"]] = (text, r["lang"], r["source"], len(text) if spans else r["n_chars"], library.encode(text))
    return out


def _unions(spans, start, end):
    """How many groups of overlapping spans lie in a run of touching ones."""
    groups, at = 0, start - 1
    for _, a, b in sorted((s for s in spans if start <= s[1] < end), key=lambda s: s[1:]):
        groups += a >= at
        at = max(at, b)
    return groups


def test_run_is_the_plain_steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = plain_run([r.asDict() for r in docs.collect()], bench, langid.train(docs))
    out = corpus_pipeline.run(spark, SF)
    got = {r.doc_id: (r.text, r.lang, r.source, r.n_chars, r.ids) for r in out.collect()}
    assert got == want and len(got) < docs.count()
    assert out.columns == [*docs.columns, "ids", "n_ids"]
    assert any(secret_scan.MARK in t[0] for t in got.values())


def test_stages_keep_columns_and_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string"
    text = "the thing and then there was another thing for them"
    rows = [(i, f"{text} {i} {'x' * i}", "en", "s", 1, "a") for i in range(1, 9)] + [(20, None, "en", "s", None, None), (21, "", None, None, 0, "b"), (22, "123", "en", "s", 3, "c"),
            (None, text, "en", "s", 1, "d"), (23, text + " é" * 100_000, None, "s", 1, "e"), (23, text + " é" * 100_000, None, "s", 1, "e")]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF)
            assert after.columns == docs.columns, name
            assert after.dtypes == docs.dtypes and after.count() <= n
            docs = after
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert last.columns == [*docs.columns, "ids_", "n_ids"]
        found = {r.doc_id for r in last.collect()}
        assert not found & {20, 21, 22} and (n == 0 or {None, 23} <= found)


def test_each_operator_is_registered_once():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in registry.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert registry.QUERIES.items() <= entry.queries().items() and "pipeline" in entry.queries()
    assert registry.ORACLE.keys() <= registry.QUERIES.keys() and entry.oracle_sql().keys() <= entry.queries().keys()
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_entry_works_without_the_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        assert importlib.reload(entry).EXTRA == {} and len(entry.queries()) > 80
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
