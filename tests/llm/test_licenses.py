"""Licence scan against a plain TF-IDF, and inheritance against walking up the paths."""

import math
import os
import re
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trendengine.llm import licenses as s

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, path string, text string, given string, directory int"


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_scan(given):
    """(kind, licence, score) of each text, every vector in full, with the df of every word."""
    n, df = len(given), Counter(w for t in given for w in set(tokens(t)))
    idf = lambda w: math.log((n + 1) / (df[w] + 1)) + 1
    vector = lambda t: {w: c * idf(w) for w, c in Counter(tokens(t)).items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    notices = [(name, vector(t), length(vector(t))) for name, t in s.TEMPLATES]
    texts = [(name, vector(t), length(vector(t))) for name, t in s.LICENCE_TEXTS]

    def best(t, templates=notices):
        v = vector(t)
        n = length(v) or 1
        return max(((sum(x * v.get(w, 0) for w, x in u.items()) / (m * n), -k, name) for k, (name, u, m) in enumerate(templates)))

    def runs(t):
        pieces = re.split(r"\n|(?<=[.!?;])[ \t\r\f\v]", t or "")
        for k in range(len(pieces)):
            for n in range(1, s.LINES + 1):
                if k + n <= len(pieces):
                    yield "\n".join(pieces[k : k + n])

    def judge(t):
        files = [(best(t or "", texts), s.FULL), (best(t or ""), s.FILE)]
        files = [b for b, least in files if b[0] >= least]
        if files:
            score, _, name = max(files, key=lambda b: round(b[0], 12))
            return "file", name, score
        score, _, name = max(map(best, runs(t)), key=lambda b: round(b[0], 12))
        return ("header", name, score) if score >= s.HEADER else ("none", None, 0.0)

    return [judge(t) for t in given]


def plain_inherit(rows):
    """rows: (doc_id, path, kind, licence, score) to (licence, directory) or None."""
    up = lambda p: p.rpartition("/")[0]
    best = {}
    for i, path, kind, name, score in rows:
        if kind == "file" and path is not None:
            best[up(path)] = min(best.get(up(path), (1, 0, "")), (-score, i, name))
    out = []
    for _, path, kind, _, _ in rows:
        found, at = None, None if path is None or kind != "none" else up(path)
        while at is not None and found is None:
            found = (best[at][2], at) if at in best else None
            at = up(at) if at else None
        out.append(found)
    return out


def check(docs, found):
    for (kind, name, score), r in zip(plain_scan([d[1] for d in docs]), found):
        assert (r.kind, r.license) == (kind, name) and r.score == pytest.approx(score)


def test_query_is_brute_force(spark):
    docs = sorted((r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = sorted(s.query(spark, SF).collect(), key=lambda r: r.doc_id)
    own = plain_scan([d[1] for d in docs])
    paths = [f"{src or 'none'}/{i // 1000}/{i // 10}/{i}" for i, _, src in docs]
    given = plain_inherit([(d[0], p, *o) for d, p, o in zip(docs, paths, own)])
    for r, p, (kind, name, score), g in zip(rows, paths, own, given):
        assert (r.path, r.kind, r.license, r.inherited_from) == (p, kind, name or (g and g[0]), g and g[1])
        assert r.score == pytest.approx(score)
    assert {r.kind for r in rows} >= {"header", "none"} and len({r.license for r in rows}) >= 4


def test_every_template_is_found_in_a_long_text_and_as_a_file():
    filler = "some words that have nothing to do with it. " * 200
    scorer = s.Scorer(1000, {t: 500 for t in (b"the", b"of", b"to", b"this", b"in", b"is", b"a", b"and")})
    for name, text in s.TEMPLATES:
        assert scorer.judge(text.encode())["kind"] == "file" and scorer.judge(text.encode())["license"] == name
        found = scorer.judge((filler + "\n" + text.replace(". ", ", ") + "\n" + filler).encode())
        assert found["kind"] == "header"
    assert scorer.judge(filler.encode())["kind"] == "none"


def test_inheritance_ties_nulls_repeats_and_clashing_names(spark):
    mit, apache = s.TEMPLATES[0][1], s.TEMPLATES[3][1]
    docs = [
        (1, "a/LICENSE", mit), (2, "a/b/c/x", "text"), (3, "a/b/LICENSE", apache), (4, "a/b/y", None), (5, "ab/z", "text"), (6, None, "text"),
        (7, "top", "text"), (8, "a/b/LICENSE2", mit + " indeed"), (9, "a/b/h", "many plain words here\n" + mit + "\nand many other words there " * 9), (9, "a/b/c/x", ""),
        (9, "a/b/c/x", ""), (10, "t/u", apache), (11, "t/v", apache), (12, "t/w", "w " * 300_000),
    ]
    frame = spark.createDataFrame([(*d, "g", 1) for d in docs], SCHEMA)
    out = s.inherit(s.scan(frame))
    assert out.columns == [*frame.columns, "own", "given_"]
    rows = out.collect()
    own = dict(zip(docs, plain_scan([d[2] for d in docs])))
    given = dict(zip(docs, plain_inherit([(d[0], d[1], *own[d]) for d in docs])))
    assert len(rows) == len(docs)
    for r in rows:
        key = (r.doc_id, r.path, r.text)
        assert (r.own.kind, r.own.license) == own[key][:2]
        got = (r.given_.license, r.given_.directory) if r.given_ and r.given_.license else None
        assert got == given[key]
    assert s.inherit(s.scan(frame.where("false"))).count() == 0
    top = spark.createDataFrame([(1, "LICENSE", mit), (2, "a/b", "text")], "doc_id long, path string, text string")
    assert {r.doc_id: r.given and r.given.directory for r in s.inherit(s.scan(top)).collect()} == {1: None, 2: ""}


def test_every_word_has_its_document_frequency(spark, monkeypatch):
    monkeypatch.setattr(s, "COMMON", 100)  # most weights come by the join
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = s.scan(docs).collect()
    wanted = plain_scan([r.text for r in rows])
    for r, (kind, name, score) in zip(rows, wanted):
        assert (r.own.kind, r.own.license) == (kind, name) and r.own.score == pytest.approx(score)


FOLDER = "/usr/share/common-licenses"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no licence files on this machine")
def test_licence_files_are_files_and_hand_down(spark):
    """Whole licence files among ordinary documents: each is its licence, and licenses its directory."""
    names = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-3": "LGPL-3.0-only", "MPL-2.0": "MPL-2.0"}
    rows = [(i, f"{name}/LICENSE", open(f"{FOLDER}/{name}").read()) for i, name in enumerate(names)]
    copyright = "Copyright (c) 2019, 2021 Jane Doe and others. All rights reserved.\n\n"
    short = {k: v for k, v in s.LICENCE_TEXTS if k in ("MIT", "BSD-2-Clause", "ISC", "Zlib", "PSF-2.0")}
    rows += [(100 + i, f"{name}/LICENSE", f"{name} license\n{copyright}{text}") for i, (name, text) in enumerate(short.items())]
    rows += [(200 + i, f"{name}/src/a/{i}", "plain words of a file that says nothing") for i, name in enumerate([*names, *short])]
    filler = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.lit("other/x").alias("path"), "text").limit(300)
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string")
    found = s.inherit(s.scan(docs.unionByName(filler.withColumn("doc_id", F.col("doc_id") + 1000)))).where("doc_id < 1000").collect()
    wanted = {**names, **{k: k for k in short}}
    for r in found:
        licence = wanted[r.path.split("/")[0]]
        assert (r.own.kind, r.own.license) == (("file", licence) if r.path.endswith("LICENSE") else ("none", None)), r.path
        assert r.path.endswith("LICENSE") or (r.given.license, r.given.directory) == (licence, r.path.split("/")[0])
    assert len(found) == len(rows)


def test_a_wrapped_notice_is_a_header(spark):
    notice = s.TEMPLATES[2][1]
    lines = textwrap.wrap(notice, 75)
    text = "plain words of a file\n" + "\n".join(f" # {x}" for x in lines) + "\n" + "and more plain words than before\n" * 30
    docs = spark.createDataFrame([(1, text), *((i, f"some other words {i}") for i in range(2, 60))], "doc_id long, text string")
    own = {r.doc_id: r.own for r in s.scan(docs).collect()}
    assert len(lines) == 3 and (own[1].kind, own[1].license) == ("header", "MIT") and own[2].kind == "none"
