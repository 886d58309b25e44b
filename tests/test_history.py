"""Filters over processed keys: the rows of the plain anti-join, without reading a history that cannot match."""

import pytest
from pyspark.sql import functions as F

from trendengine.operators import history as H


def keyed(spark, numbers, extra=()):
    return spark.createDataFrame([(f"k{n}", i) for i, n in enumerate(numbers)] + list(extra), "k string, n int")


def left(spark, root, rows, keys=("k",)):
    return sorted(H.pending(spark, root, rows, list(keys)).collect(), key=str)


def test_rows_of_the_anti_join_nulls_and_repeats(spark, tmp_path):
    root = str(tmp_path)
    rows = keyed(spark, [1, 2, 2, 5000, 9000, 9000], [(None, 7), ("", 8)])
    assert left(spark, root, rows) == sorted(rows.collect(), key=str)
    assert H.record(spark, root, keyed(spark, range(6000), [(None, 1)]), ["k"]) == 6000
    assert [(r.k, r.n) for r in left(spark, root, rows)] == [("", 8), ("k9000", 4), ("k9000", 5), (None, 7)]
    assert H.record(spark, root, keyed(spark, [1, 1, 2]), ["k"]) == 0
    assert left(spark, root, rows.where("false")) == []


@pytest.mark.parametrize("small", [1024, 1])
def test_no_recorded_key_is_pending_over_generations(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(H, "SMALL_BLOCKS", small)
    monkeypatch.setattr(H, "BUCKET_KEYS", 1000)
    root, done = str(tmp_path), set()
    for start, count in ((0, 9000), (8000, 3000), (20_000, 40), (30_000, 400), (40_000, 7)):
        numbers = range(start, start + count)
        assert H.record(spark, root, keyed(spark, numbers), ["k"]) == len(set(numbers) - done)
        done |= set(numbers)
        sizes = sorted(g.keys for g in H.generations(spark, root)[1])
        assert sum(sizes) == len(done) and all(2 * a < b for a, b in zip(sizes, sizes[1:]))
    assert sizes == [7, 440, 2000, 9000]
    got = {r.k for r in left(spark, root, keyed(spark, range(50_000)))}
    assert got == {f"k{n}" for n in set(range(50_000)) - done}


def test_filters_let_few_misses_through_and_these_read_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    H.record(spark, root, keyed(spark, range(20_000)), ["k"])
    _, found = H.generations(spark, root)
    misses = keyed(spark, range(100_000, 200_000))
    passed = H.possible_hits(spark, root, misses.select(F.col("k").alias("_key_0")), ["_key_0"], found)
    assert passed.count() < 300  # about 70 of 100,000
    none = misses.join(passed, F.col("k") == F.col("_key_0"), "left_anti")
    monkeypatch.setattr(H, "_keys_of", lambda *_: pytest.fail("the history was read"))
    assert H.pending(spark, root, none, ["k"]).count() == none.count()


def test_only_buckets_of_hits_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(H, "BUCKET_KEYS", 100)
    root = str(tmp_path)
    H.record(spark, root, keyed(spark, range(5000)), ["k"])
    (made,) = H.generations(spark, root)[1]
    home = spark.createDataFrame([("k3",)], "k string").select(H._bucket(["k"], made.buckets)).head()[0]
    others = [p for p in tmp_path.glob(f"keys/{made.folder}/bucket=*/*.parquet") if p.parent.name != f"bucket={home}"]
    assert made.buckets == 50 and len(others) > 40
    for path in others:  # a read of one of these fails
        path.write_bytes(b"broken")
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    assert left(spark, root, keyed(spark, [3])) == []


def test_filters_are_shuffled_once(spark):
    plan = H.filter_blocks(keyed(spark, range(100)).select("k"), ["k"], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_blocks_hold_the_bits_of_their_keys(spark):
    keys = keyed(spark, range(300)).select("k")
    first, step = H._first_and_step(["k"])
    want = {}
    for r in keys.select(H._block(["k"], F.lit(3)).alias("b"), first.alias("f"), step.alias("s")).collect():
        want.setdefault(r.b, set()).update((r.f + r.s * i) % H.BLOCK_BITS for i in range(H.HASHES))
    made = H.filter_blocks(keys, ["k"], 3)
    assert {r.block: {i for i in range(H.BLOCK_BITS) if r.bits[i // 8] >> i % 8 & 1} for r in made.collect()} == want
    words = made.select("block", H._words(F.col("bits")).alias("w"))
    bits = words.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(H.BLOCK_BITS - 1))))
    got = bits.where(H._is_set(F.col("w"), F.col("i"))).groupBy("block").agg(F.collect_set("i").alias("i")).collect()
    assert {r.block: set(r.i) for r in got} == want


@pytest.mark.parametrize("small", [1024, 1])
def test_rows_are_asked_without_a_sort_and_before_they_are_made_distinct(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(H, "SMALL_BLOCKS", small)
    root, asked = str(tmp_path), []
    H.record(spark, root, keyed(spark, range(5000)), ["k"])
    real = H.possible_hits
    monkeypatch.setattr(H, "possible_hits", lambda *a: asked.append((a[2], real(*a))) or asked[-1][1])
    rows = keyed(spark, [1, 1, 2, 9000])
    assert [r.k for r in left(spark, root, rows)] == ["k9000"]
    ((wanted, hits),) = asked
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan(wanted) and "Sort" not in plan(hits)
    assert ("ShuffledHashJoin" in plan(hits)) == (small == 1)
    assert hits.count() == hits.select("_key_0").distinct().count() >= 2


def test_keys_of_several_columns_and_types(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", None, "x"), ("ab", 1, "x")], "`a.b` string, bucket int, generation string")
    H.record(spark, root, rows.where("bucket = 1").withColumn("bucket", F.col("bucket").cast("long")), ["a.b", "bucket"])
    assert [tuple(r)[:2] for r in left(spark, root, rows, ("a.b", "bucket"))] == [("a", 2), ("b", None)]


def test_runs_at_the_same_time_and_a_crash(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(H, "PAUSE", 0.0)
    root = str(tmp_path)
    meet = [lambda: H.record(spark, root, keyed(spark, [1, 2]), ["k"])]
    assert H.record(spark, root, keyed(spark, [2, 3]), ["k"], lambda: meet and meet.pop()()) == 1
    assert left(spark, root, keyed(spark, [1, 2, 3])) == []

    def kill():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        H.record(spark, root, keyed(spark, [4]), ["k"], kill)
    assert [r.k for r in left(spark, root, keyed(spark, [1, 4]))] == ["k4"]
    assert len(H.expire(spark, root)) == 2  # the absorbed one and the crashed one
    assert H.record(spark, root, keyed(spark, [4]), ["k"]) == 1 and left(spark, root, keyed(spark, [1, 2, 3, 4])) == []


def test_artists_by_trimmed_lower_name(spark, tmp_path):
    root = str(tmp_path)
    H.record(spark, root, H.artist_names(spark.createDataFrame([(" ABBA ",), ("",)], "artist string")), ["_name"])
    rows = spark.createDataFrame([("abba", 1), ("Queen ", 2), (" ", 3), (None, 4)], "artist string, id int")
    assert [tuple(r) for r in H.unprocessed_artists(spark, root, rows).collect()] == [("Queen ", 2)]
