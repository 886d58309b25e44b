"""Mixing against SQL, its targets against plain sharing, its samples against their probabilities."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tests.oracle_check import compare, connect
from trendengine.llm import mixing as m

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, source string, text string, mix string, mixed int, rank int"


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 2 * sizes[s]}
        out |= share
        if not above:
            return out
        out |= {s: 2 * sizes[s] for s in above}
        left, free = left - sum(2 * sizes[s] for s in above), free - above


def test_query_is_the_sql(spark):
    assert compare(m.query(spark, SF), connect(SF), m.SQL) is None


def test_no_python_in_the_plan(spark):
    plan = m.query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def make(n, seed):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        source = draw.choice(["a", "a", "a", "b", "c", "Z", "é", None, "tiny"]) if i % 50 else "huge"
        size = draw.choice([0, 1, 5, 20, 100]) if source != "tiny" else 1
        rows.append((i, source, " \t".join(["w x"] * size) if i % 40 else None, "x", 1, 2))
    return rows + [(n, "huge", "w " * 30_000, "x", 1, 2), (n + 1, "a", "w " * 5_000, "x", 1, 2)]


def test_targets_copies_and_clashing_names(spark):
    rows = make(4000, 1)
    frame = spark.createDataFrame(rows, SCHEMA)
    found = m.mix(spark, frame)
    assert found.columns == [*frame.columns, "mix_"]
    out = {r.doc_id: r for r in found.collect()}
    sizes = Counter()
    for _, source, text, *_ in rows:
        sizes[source] += n_words(text)
    wanted, taken = plain_targets(sizes), Counter()
    for i, source, text, *_ in rows:
        if i in out:
            r = out[i]
            assert (r.text, r.mix, r.mixed, r.rank) == (text, "x", 1, 2) and r.mix_.size == n_words(text)
            assert 1 <= r.mix_.copies <= 2 and r.mix_.source_size == sizes[source] and r.mix_.target == pytest.approx(wanted[source])
            taken[source] += r.mix_.copies * r.mix_.size
    for source, target in wanted.items():
        if source != "huge":
            assert abs(taken[source] - target) <= max(40, 0.001 * target), source
    # one document has nearly all words: only the others can come twice, and all of them do
    assert taken["huge"] == 2 * sizes["huge"] - 30_000 < wanted["huge"]
    again = {r.doc_id: r for r in m.mix(spark, frame.repartition(7)).collect()}
    assert {i: r.mix_.copies for i, r in again.items()} == {i: r.mix_.copies for i, r in out.items()}


def test_inclusion_follows_the_odds(spark):
    """Documents liked three times as much get three times the copies."""
    rows = [(i, "a", "w " * (1 + i % 7), "x", i % 2, 0) for i in range(6000)] + [(i, "b", "w " * 9, "x", 0, 0) for i in range(6000, 9000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    totals = defaultdict(int)
    for r in m.mix(spark, frame, weights=(1, 3), budget=0.6, preference=1 + 2 * F.col("mixed")).collect():
        totals[r.source, r.mixed] += r.mix_.copies
    assert totals["a", 1] / totals["a", 0] == pytest.approx(3, rel=0.15)


def test_preferences_stop_at_the_limit(spark):
    from pyspark.sql import functions as F

    rows = [(i, "a", "w " * 10, "x", i % 10, 0) for i in range(1000)]
    liked = F.when(F.col("mixed") == 0, 100.0).when(F.col("mixed") == 1, F.lit(None)).otherwise(1.0)
    out = m.mix(spark, spark.createDataFrame(rows, SCHEMA), preference=liked).collect()
    taken = Counter()
    for r in out:
        taken[r.mixed] += r.mix_.copies * r.mix_.size
    assert taken[0] == 2000 and 1 not in taken and sum(taken.values()) == pytest.approx(15000, abs=10)


def test_empty_nulls_repeats_and_no_words(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert m.mix(spark, frame).count() == 0
    blank = spark.createDataFrame([(1, "a", " ", "", 0, 0), (2, None, None, "", 0, 0)], SCHEMA)
    assert m.mix(spark, blank).count() == 0
    rows = [(None, None, "a b c", "", 0, 0)] * 3 + [(1, "s", "a b", "", 0, 0)] * 2 + [(1, "s", "c d e f", "", 0, 0)]
    out = m.mix(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(1 <= r.mix_.copies <= 2 for r in out)
    by_row = Counter((r.doc_id, r.text) for r in out)
    assert set(by_row.values()) <= {1, 2, 3} and by_row[None, "a b c"] in (0, 3)  # exact repeats go together
