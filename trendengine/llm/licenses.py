"""Licences of documents by sparse TF-IDF cosine to templates, and what directories hand down.

Each text, each of its sentences (cut at line feeds and after ``.``, ``!``, ``?``, ``;`` before white space), and each run of up to `LINES` adjacent
sentences, as a notice wrapped over lines makes them, is a vector of term counts times ``idf = ln((N + 1) / (df + 1)) + 1``. N and the df of every term are counted over all documents. The template
with the largest cosine wins, the first listed among equals; of sentences the first among those equal to `DIGITS` decimals.

* licence file: the whole text is within `FULL` of a licence text or within `FILE` of a notice; it licenses its directory;
* header: else, the best sentence or run is within `HEADER` of a notice; it licenses its own document.

A document without a licence of its own takes that of its nearest ancestor directory that has one: the file with the largest
cosine there, then the smallest doc_id.

Most sentences are left without a vector, by an exact bound: if a sentence lacks all but the most common terms, its
cosine to a template is at most the share of the template's length in these terms. Of the others, only those go on that
reach the threshold if each term of unknown df has the least idf, 1.

Scale: a counting pass, in which tasks sum up terms before the shuffle (the table has a row per term), and a scoring pass. Weights of the
templates' terms and of the `COMMON` most common ones are broadcast; those of rarer terms are joined, by term, to the few texts and
sentences that pass the bound, each distinct text once. What a template scores before division by the vector's length
needs template terms only, so the join adds up lengths and nothing else. Verdicts are joined to documents by
the digest of the text. Distinct directories, not
documents, are expanded to their ancestors and joined to licensed directories, so a directory with a third of all documents is one
row there; only the last join carries documents, and Spark splits its hot keys. The templates are fixed, their
terms bound the broadcast. A file that bundles several licences counts as the one that has most of its words.

Nulls: a null text has no licence of its own. A null path lies in no directory and inherits nothing. Rows that repeat are
judged alike. No rows: no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendengine.llm.common import any_columns, fresh, stored, table, utf8
from trendengine.llm.decontaminate import words
from trendengine.llm.licence_texts import LICENCE_TEXTS

FILE, FULL, HEADER = 0.5, 0.7, 0.6
#: Licence names (SPDX) and the notices that go with them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License, see the LICENSE file for details."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met.",
    ),
]
SENTENCE = re.compile(rb"\n|(?<=[.!?;])\s")
KIND = "struct<kind:string,license:string,score:double>"
LINES = 4
#: Terms with broadcast weights, terms a task holds before it hands them on, decimals in which sentences are ranked.
COMMON, HELD, DIGITS = 20_000, 200_000, 12
PARTS = "digest string, part int, license string, top double, square double, rest array<struct<term:binary,count:bigint>>"

Template = tuple[str, dict[bytes, float], float]  # name, weights, length


def vocabulary() -> list[bytes]:
    return sorted({w for _, text in [*TEMPLATES, *LICENCE_TEXTS] for w in words(text.encode())})


def count_terms(docs: DataFrame) -> DataFrame:
    """In how many documents each term occurs; the empty term stands for the number of documents."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found, rows = Counter(), 0
        hand_on = lambda: pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["term", "n"])
        for batch in batches:
            for text in utf8(batch.column(0)):
                found.update(set(words(text)))
                if len(found) > HELD:
                    yield hand_on()
                    found.clear()
            rows += batch.num_rows
        found[b""] = rows
        yield hand_on()

    return docs.select("text").mapInArrow(run, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))


def known_terms(counted: DataFrame) -> tuple[int, dict[bytes, int]]:
    """The number of documents, and df of template terms and the most common ones."""
    by_name = counted.where(F.col("term").isin([b"", *vocabulary()])).collect()  # one row per template term
    df = {bytes(r["term"]): r["n"] for r in by_name + counted.orderBy(F.desc("n")).limit(COMMON).collect()}
    return df.pop(b"", 0), df


class Scorer:
    """Scores with the weights of known terms: those of the templates and of ``df``."""

    def __init__(self, n: int, df: dict[bytes, int]):
        self.unseen = math.log(n + 1) + 1
        self.idf = {t: math.log((n + 1) / (df.get(t, 0) + 1)) + 1 for t in {*vocabulary(), *df}}
        self.notices = [self._template(*t) for t in TEMPLATES]
        self.texts = [self._template(*t) for t in LICENCE_TEXTS]
        self.needed = self._needed(self.notices, min(FILE, HEADER))
        self.needed_whole = self._needed(self.texts, FULL)

    def _template(self, name: str, text: str) -> Template:
        weights = {t: c * self.idf[t] for t, c in Counter(words(text.encode())).items()}
        return name, weights, math.sqrt(sum(w * w for w in weights.values()))

    def _needed(self, templates: list[Template], least: float) -> frozenset[bytes]:
        """Terms of which a vector must have one to come within ``least``: all but the most common, as long as these alone cannot."""
        common: set[bytes] = set()
        terms = {t for _, weights, _ in templates for t in weights}
        for term in sorted(terms, key=lambda t: (self.idf[t], t)):
            common.add(term)
            if any(math.sqrt(sum(w * w for t, w in ws.items() if t in common)) >= 0.999 * least * size for _, ws, size in templates if term in ws):
                common.remove(term)
                break
        return frozenset(terms) - common

    def part(self, tokens: list[bytes], least: float, templates: list[Template]) -> tuple[str, float, float, dict[bytes, int]] | None:
        """(licence, cosine times the vector's length, square of its length in known terms, other terms), if it may come within ``least``."""
        counts = Counter(tokens)
        vector = {t: c * self.idf[t] for t, c in counts.items() if t in self.idf}
        rest = {t: c for t, c in counts.items() if t not in vector}
        square = sum(w * w for w in vector.values())
        shortest = math.sqrt(square + sum(c * c for c in rest.values()))
        top, name = 0.0, None
        for licence, weights, length in templates:
            few, many = (weights, vector) if len(weights) < len(vector) else (vector, weights)
            dot = sum(w * many[t] for t, w in few.items() if t in many) / length
            if dot > top:
                top, name = dot, licence
        return (name, top, square, rest) if top >= 0.999 * least * shortest else None

    def parts(self, text: bytes | None) -> Iterator[tuple]:
        """(place, *part) of what may come within its threshold: -1 is the whole text against licence texts, 0 against notices, then runs of sentences."""
        tokens = words(text)
        if not self.needed_whole.isdisjoint(tokens) and (part := self.part(tokens, FULL, self.texts)):
            yield -1, *part
        if self.needed.isdisjoint(tokens):
            return
        if part := self.part(tokens, FILE, self.notices):
            yield 0, *part
        sentences = [words(x) for x in SENTENCE.split(text)]
        near = [not self.needed.isdisjoint(x) for x in sentences]
        for k in range(len(sentences)):
            for n in range(1, min(LINES, len(sentences) - k) + 1):
                if any(near[k : k + n]) and (part := self.part([w for x in sentences[k : k + n] for w in x], HEADER, self.notices)):
                    yield LINES * k + n, *part

    def judge(self, text: bytes | None) -> dict:
        """The verdict on a text whose other terms were never seen."""
        found = {"file": (0.0, None), "header": (0.0, None)}
        for at, name, top, square, rest in self.parts(text):
            score = top / math.sqrt(square + sum((c * self.unseen) ** 2 for c in rest.values()))
            kind, least = ("header", HEADER) if at > 0 else ("file", FILE if at == 0 else FULL)
            if score >= least and round(score, DIGITS) > round(found[kind][0], DIGITS):
                found[kind] = score, name
        for kind, (score, name) in found.items():
            if name:
                return {"kind": kind, "license": name, "score": min(1.0, score)}
        return {"kind": "none", "license": None, "score": 0.0}


def verdicts(docs: DataFrame) -> DataFrame:
    """Digest of the text, and `KIND`, of each distinct text that has a licence."""
    spark = docs.sparkSession
    counted = stored(spark, count_terms(docs), "terms")
    n, df = known_terms(counted)
    sent, kind = spark.sparkContext.broadcast((n, df)), StructType.fromDDL(PARTS)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        scorer, schema, rows, held = Scorer(*sent.value), to_arrow_schema(kind), [], 0
        for batch in batches:
            for text in utf8(batch.column(0)):
                for at, name, top, square, rest in scorer.parts(text):
                    digest = hashlib.sha256(text).hexdigest()
                    rows.append({"digest": digest, "part": at, "license": name, "top": top, "square": square, "rest": [{"term": t, "count": c} for t, c in rest.items()]})
                    held += 1 + len(rest)
                if held > HELD:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    key = ["digest", "part"]
    parts = stored(spark, docs.select("text").mapInArrow(run, PARTS).dropDuplicates(key), "parts")
    rest = parts.select(*key, F.explode("rest").alias("rest")).select(*key, "rest.term", "rest.count")
    idf = F.log(F.lit(n + 1.0) / (F.col("n") + 1)) + 1
    lengths = rest.join(counted, "term").groupBy(*key).agg(F.sum(F.pow(F.col("count") * idf, F.lit(2))).alias("more"))
    score = F.col("top") / F.sqrt(F.col("square") + F.coalesce("more", F.lit(0.0)))
    scored = parts.join(lengths, key, "left").select(*key, "license", score.alias("score"))
    rank = F.struct((-F.round("score", DIGITS)).alias("s"), "part", "license", "score")
    best = scored.groupBy("digest").agg(
        F.min(F.when(((F.col("part") == 0) & (F.col("score") >= FILE)) | ((F.col("part") < 0) & (F.col("score") >= FULL)), rank)).alias("file"),
        F.min(F.when((F.col("part") > 0) & (F.col("score") >= HEADER), rank)).alias("header"),
    )
    found = F.coalesce("file", "header")
    which = F.when(F.col("file").isNotNull(), "file").otherwise("header")
    verdict = F.struct(which.alias("kind"), found["license"].alias("license"), F.least(F.lit(1.0), found["score"]).alias("score"))
    return best.where(found.isNotNull()).select("digest", verdict.alias("verdict"))


@any_columns("text")
def scan(docs: DataFrame, name: str = "own") -> DataFrame:
    """``docs`` and a struct ``name``: kind (file, header, none), licence, cosine."""
    digest, verdict = fresh("digest", docs), fresh("verdict", docs)
    found = verdicts(docs).toDF(f"{digest}_of", verdict)
    keyed = docs.withColumn(digest, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    none = F.struct(F.lit("none").alias("kind"), F.lit(None).cast("string").alias("license"), F.lit(0.0).alias("score"))
    out = keyed.join(found, F.col(digest) == F.col(f"{digest}_of"), "left")
    return out.select(*docs.columns, F.coalesce(verdict, none).alias(name))


def _parent(path):
    """The directory of a path; null for a null path, '' at the top."""
    return F.when(F.locate("/", path) > 0, F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.when(path.isNotNull(), F.lit("")))


def inherit(scanned: DataFrame, own: str = "own", path: str = "path") -> DataFrame:
    """``scanned`` and a struct ``given``: licence and the directory it comes from, for documents without one of their own.

    Where the documents had a column ``own`` before `scan`, its struct is called ``own_``.
    """
    return any_columns("doc_id", own.lower(), path.lower())(_inherit)(scanned, own, path)


def _inherit(scanned: DataFrame, own: str, path: str) -> DataFrame:
    directory, given = fresh("directory", scanned), fresh("given", scanned)
    placed = scanned.withColumn(directory, _parent(F.col(path)))
    files = placed.where((F.col(f"{own}.kind") == "file") & F.col(directory).isNotNull())
    rank = F.struct((-F.col(f"{own}.score")).alias("s"), "doc_id", F.col(f"{own}.license").alias("license"))
    licensed = files.groupBy(F.col(directory).alias("_from")).agg(F.min(rank).alias("_best"))
    dirs = placed.where(F.col(directory).isNotNull()).select(F.col(directory).alias("_dir")).distinct()
    # 'a/b' -> 'a/b', 'a', ''
    parts = F.split("_dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    ancestors = dirs.select("_dir", F.explode(F.array_union(above, F.array(F.lit("")))).alias("_from"))
    nearest = (
        ancestors.join(licensed, "_from")
        .groupBy("_dir")
        .agg(F.max(F.struct(F.length("_from").alias("n"), "_from", F.col("_best.license").alias("license"))).alias("_near"))
    )
    place, near = fresh("_dir", placed), fresh("_near", placed)
    nearest = nearest.withColumnsRenamed({"_dir": place, "_near": near})
    out = placed.join(nearest, F.col(directory) == F.col(place), "left")
    handed = F.struct(F.col(f"{near}.license").alias("license"), F.col(f"{near}._from").alias("directory"))
    handed = F.when(F.col(f"{own}.kind") == "none", handed)
    return out.select(*scanned.columns, handed.alias(given))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/thousand/ten/doc_id``: licence of their own, or of the nearest directory above."""
    docs = table(spark, sf_dir, "documents")
    whole = lambda n: F.expr(f"doc_id div {n}").cast("string")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), whole(1000), whole(10), F.col("doc_id").cast("string"))
    scanned = scan(docs.select("doc_id", path.alias("path"), "text")).drop("text")
    found = inherit(stored(spark, scanned, "licences"))
    return found.select(
        "doc_id",
        "path",
        F.col("own.kind").alias("kind"),
        F.coalesce("own.license", "given.license").alias("license"),
        F.col("own.score").alias("score"),
        F.col("given.directory").alias("inherited_from"),
    )
