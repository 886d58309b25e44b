"""SimHash index against all pairs."""

import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from trendengine.llm import simhash
from trendengine.llm.graph import components

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, mask string"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, links):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@settings(max_examples=80, deadline=None)
@given(st.text())
def test_fingerprint_is_the_plain_one(text):
    text = text.encode("utf-8", "ignore").decode()
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_long_text_and_ascii_folding_only():
    text = "ÀB c d İ " * 30_000
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("size", [2, 17, 300, 1500])
def test_descent_finds_every_close_pair(size):
    import numpy as np

    rng = random.Random(size)
    base = [rng.getrandbits(64) for _ in range(max(1, size // 30))]
    values = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & simhash.ONES for b in base for _ in range(30)}
    x = np.array(sorted(values), dtype=np.uint64)
    x = x[np.argsort(simhash.gray_rank(x))]
    got = {(int(a), int(b)) for i, j in simhash._close_below(x) for a, b in zip(i, j)}
    v = [int(a) for a in x]
    assert got == {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if (v[i] ^ v[j]).bit_count() <= 2}


@pytest.mark.parametrize("node_rows", [4096, 64])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, node_rows):
    """Also with nodes that are cut again: a family of values that share most bits."""
    monkeypatch.setattr(simhash, "NODE_ROWS", node_rows)
    rng = random.Random(7)
    values = [rng.getrandbits(64) for _ in range(200)]
    values += [values[0] ^ rng.getrandbits(12) for _ in range(400)] + [v ^ (1 << 63) ^ 1 for v in values[:50]]
    values = list(dict.fromkeys(values))
    fps = spark.createDataFrame([(simhash._signed(v), i) for i, v in enumerate(values)], "fp long, doc long")
    found = components(spark, simhash.close_links(spark, fps)).collect()
    links = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2]
    wanted = {n: r for n, r in plain_components(range(len(values)), links).items() if n != r}
    assert {r.node: r.root for r in found} == wanted


def test_the_descent_returns_the_links_of_the_table(spark, monkeypatch):
    """Without the descent no link of the given table is found: small nodes go through the tree as well."""
    import numpy as np

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    fps = np.unique(np.array([r.fp for r in simhash.fingerprints(docs).collect()], dtype=np.int64).view(np.uint64))
    found = 0
    for mask in map(np.uint64, simhash._parts(0)):
        x = fps[np.lexsort((simhash.gray_rank(fps), fps & mask))]
        group = np.cumsum(np.concatenate([[False], np.diff(x & mask) != 0]))
        assert np.bincount(group).max() <= simhash.FANOUT  # small nodes only
        got = {(int(a), int(b)) for i, j in simhash._close_below(x, group) for a, b in zip(i, j)}
        near = lambda i, j: group[i] == group[j] and int(x[i] ^ x[j]).bit_count() <= 2
        assert got == {(i, j) for i in range(len(x)) for j in range(i + 1, min(len(x), i + 16)) if near(i, j)}
        found += len(got)
    assert found
    monkeypatch.setattr(simhash, "_close_below", lambda x, group=None: iter(()))
    a, _ = simhash._forest(group, x, np.arange(len(x)))
    assert not len(a)


def test_components_of_long_chain_and_hub(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, None), (7, 7)]
    found = components(spark, spark.createDataFrame(links, "a long, b long"))
    got = {r.node: r.root for r in found.collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 300)}}


def test_query_is_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    ids = sorted(fps)
    links = [(a, b) for a in ids for b in ids if b < a and (fps[a] ^ fps[b]).bit_count() <= 2]
    root = plain_components(ids, links)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.query(spark, SF).collect()}
    assert got == {i: (f"{fps[i]:016x}", root[i]) for i in ids}
    assert any(a != b for a, b in root.items())


def test_nulls_blanks_ties_and_repeated_rows(spark):
    same = "one two three four five six"
    docs = spark.createDataFrame(
        [(9, None, None, None, None, "x"), (3, "", "en", "s", 0, "x"), (4, " \n", "en", "s", 2, "x"), (None, same, "en", "s", 1, "x"),
         (7, same, "en", "s", 1, "x"), (7, same, "en", "s", 1, "x"), (8, same.upper(), None, None, None, None),
         (20, "alpha beta gamma delta", "en", "s", 1, "x"), (20, same, "en", "s", 1, "x")],
        SCHEMA,
    )
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(spark, docs).collect())
    assert got == [(-1, -1), (3, 3), (4, 3), (7, 7), (7, 7), (8, 7), (9, 3), (20, 7), (20, 7)]
    docs = docs.withColumns({"kept": simhash.F.lit(7), "Place": simhash.F.lit(2)})
    kept = simhash.keep_one(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 7]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(spark, docs).count() == 0
    assert simhash.keep_one(spark, docs).count() == 0
