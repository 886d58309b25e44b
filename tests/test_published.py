"""Published versions under runs at the same time and crashes; bucketed joins by their plans."""

import threading

import pytest
from pyspark.sql import functions as F

from trendengine.operators import colocated, dims
from trendengine.plans import published as V
from trendengine.session import create_if_absent


def rows(spark, ids, start=0):
    return spark.createDataFrame([(i, f"id {k}", f"Artist {k}", "pop", "NV", 0) for i, k in enumerate(ids, start)], "ingest_seq long, id string, artist string, genres string, location string, genre_pos int")


def found(spark, root):
    return sorted((r.artist_id, r.spotify_id) for r in V.read_published(spark, root, dims.ARTISTS).collect())


def test_a_marker_is_made_once(spark, tmp_path):
    path = str(tmp_path / "a" / "1")
    assert create_if_absent(spark, path, "x") and not create_if_absent(spark, path, "y")
    assert (tmp_path / "a" / "1").read_text() == "x"


def test_interleaved_runs_issue_each_number_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "PAUSE", 0.0)
    root = str(tmp_path)
    meet = [lambda: V.publish_dim(spark, rows(spark, "cdx"), root, dims.ARTISTS)]
    assert V.publish_dim(spark, rows(spark, "abc"), root, dims.ARTISTS, lambda: meet and meet.pop()()) == 2
    assert found(spark, root) == [(1, "id c"), (2, "id d"), (3, "id x"), (4, "id a"), (5, "id b")]
    assert V.publish_dim(spark, rows(spark, "abcdx"), root, dims.ARTISTS) is None
    assert [n for n, _ in V.versions(spark, f"{root}/dim_artists")] == [1, 2]


def test_threads_issue_each_number_once(spark, tmp_path):
    root, names = str(tmp_path), ["abc", "bcd", "cde", "xyz"]
    threads = [threading.Thread(target=V.publish_dim, args=(spark, rows(spark, n), root, dims.ARTISTS)) for n in names]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = found(spark, root)
    assert [n for n, _ in got] == list(range(1, 9)) and {k for _, k in got} == {f"id {c}" for c in "abcdexyz"}


def test_a_kill_between_write_and_publish_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path)
    V.publish_dim(spark, rows(spark, "ab"), root, dims.ARTISTS)

    def kill():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        V.publish_dim(spark, rows(spark, "abc"), root, dims.ARTISTS, kill)
    assert found(spark, root) == [(1, "id a"), (2, "id b")]
    assert V.publish_dim(spark, rows(spark, "abcd"), root, dims.ARTISTS) == 2
    assert found(spark, root) == [(1, "id a"), (2, "id b"), (3, "id c"), (4, "id d")]


def test_bucketed_tables_join_without_a_shuffle(spark):
    facts = spark.range(5000).select((F.col("id") % 300).cast("string").alias("k"), "id")
    dim = spark.range(250).select(F.col("id").cast("string").alias("k"), (F.col("id") * 10).alias("number"))
    left, right = colocated.bucketed(spark, facts, "k", 4, "facts"), colocated.bucketed(spark, dim, "k", 4, "dim")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = colocated.join_buckets(left, right, "k")
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert len(rows) == 5000 and all(r.number == (int(r.k) * 10 if int(r.k) < 250 else None) for r in rows)
