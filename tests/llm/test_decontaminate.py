"""Wu-Manber search against SQL and plain search."""

import hashlib
import random
import re

import duckdb

from tests.oracle_check import compare, connect
from trendengine.llm import decontaminate as d

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, n_words string, found string"


def plain(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, ids = split(text), set(), set()
    for item, body in items:
        w = split(body)
        m = min(13, len(w))
        for k in range(len(w) - m + 1) if w else ():
            for i in range(len(words) - m + 1):
                if words[i : i + m] == w[k : k + m]:
                    hit.update(range(i, i + m))
                    ids.update([] if item is None else [str(item)])
    return len(words), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(words)


def check(spark, docs, items):
    rows = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = d.find_passages(spark, rows, bench, d.fresh("found", rows))
    assert found.columns == [*rows.columns, "found_"]
    for r in found.collect():
        n, hit, ids, bad = plain(r.text, items)
        spans = list(zip(r.found_.spans[::2], r.found_.spans[1::2]))
        assert (r.found_.n_words, sum(b - a for a, b in spans), r.found_["items"]) == (n, hit, ids)
    kept = d.drop_contaminated(spark, rows, bench)
    assert kept.columns == rows.columns
    wanted = [(i, t) for i, t in docs if not plain(t, items)[3]]
    assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.text)) for r in kept.collect())


def test_query_is_the_sql(spark):
    assert compare(d.query(spark, SF), connect(SF), d.SQL) is None


def test_against_plain_search_with_short_items_and_small_alphabets(spark, monkeypatch):
    rng = random.Random(3)
    text = lambda n, k=3: " ".join(rng.choice(["a", "B", "c", "é", "ü9"][:k]) for _ in range(n))
    items = [(i, text(n, 2)) for i, n in enumerate([1, 2, 5, 12, 13, 14, 20, 20])] + [(3, "c c c"), (None, "b a b b a"), (40, ""), (41, None)]
    items = items[3:]  # the one-word items would hit everything
    docs = [(i, text(rng.randrange(60))) for i in range(60)] + [(61, items[3][1] + " " + text(400, 5)), (62, None), (63, ""), (None, "c c c")]
    check(spark, docs, items)
    monkeypatch.setattr(d, "SHARD_WINDOWS", 5)
    check(spark, docs, items)
    check(spark, docs, [(1, "a"), (2, "b a")])


def test_long_text_repeats_ties_and_empty_tables(spark):
    passage = " ".join(f"w{i}" for i in range(13))
    docs = [(1, passage.upper() + "!" + " x" * 247), (1, passage + " x" * 248), (2, "the " * 100_000), (3, (passage + "\n") * 3)]
    check(spark, docs, [(10, passage), (9, passage), (9, passage)])
    check(spark, docs, [])
    check(spark, [], [(1, passage)])


def test_digest_of_items():
    assert hashlib.sha256(b"").hexdigest() == duckdb.sql("SELECT sha256('')").fetchall()[0][0]
