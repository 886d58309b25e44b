"""One key holds a third of the rows or more: results stay whole, no task gets them all."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendengine.operators import analytics, dedup, dims, enrich
from trendengine.operators.joins import hot_keys, spread_join


@pytest.fixture
def skewed(spark):
    """6,000 clean rows; half of them belong to one artist, genre and state."""
    hot = F.col("id") % 2 == 0
    day = F.date_add(F.lit(dt.date(2025, 1, 1)), (F.col("id") % 200).cast("int"))
    return spark.range(0, 6000, 1, 8).select(
        F.lit("A").alias("artist"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 97)).alias("id"),
        F.when(hot, "pop").otherwise(F.concat(F.lit("g"), F.col("id") % 13)).alias("genres"),
        F.when(hot, "CA").otherwise("NV").alias("location"),
        day.alias("date"),
        (F.col("id") % 101).cast("double").alias("trend_score"),
        F.col("id").alias("ingest_seq"),
    )


def test_dedup_hashes_and_breaks_ties_by_place_in_the_row(spark, skewed):
    rows = skewed.where("id <> 'hot'").withColumn("genre_pos", (2**31 - 1 - F.col("ingest_seq")).cast("int"))
    rows = rows.withColumns({"date": F.lit(dt.date(2025, 1, 1)), "ingest_seq": F.lit(7).cast("long"), "genres": F.lit("pop")})
    once = dedup.dedup_trends(rows)
    best = {r["id"]: r["p"] for r in rows.groupBy("id").agg(F.min("genre_pos").alias("p")).collect()}
    assert sorted((r["id"], r["genre_pos"]) for r in once.collect()) == sorted(best.items())
    assert "SortAggregate" not in once._jdf.queryExecution().executedPlan().toString()
    twice = dedup.dedup_trends(skewed.withColumn("genre_pos", F.lit(0)).withColumn("date", F.lit(dt.date(2025, 1, 1))))
    assert sorted(r["ingest_seq"] for r in twice.where("id = 'hot'").collect()) == [0]


def test_copies_are_combined_before_the_shuffle(spark, skewed):
    copies = skewed.where("id = 'hot'").withColumn("date", F.lit(dt.date(2025, 1, 1)))
    once = dedup.dedup_trends(copies)
    rows = once.collect()
    assert [(r["id"], r["ingest_seq"]) for r in rows] == [("hot", 0)]
    plan = once._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange")[1]
    assert "partial_min_by" in below


@pytest.fixture
def without_broadcast(spark):
    """Joins as between two large tables, with skew limits small enough for test data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _largest_share(df):
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    return max(sizes) / sum(sizes)


def test_spread_join_splits_the_hot_key(spark, skewed, without_broadcast):
    lookup = skewed.groupBy("id").agg(F.max("trend_score").alias("peak"))
    plain, spread = skewed.join(lookup, "id"), spread_join(skewed, lookup, ["id"], hot_rows=300)
    assert sorted(map(tuple, spread.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    assert _largest_share(plain) > 0.5 > 0.25 > _largest_share(spread)


def test_adaptive_execution_splits_a_join_of_two_tables(spark, skewed, without_broadcast):
    other = skewed.select("id").distinct().repartition(4)
    joined = skewed.join(other, "id")
    assert len(joined.collect()) == 6000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_only_hot_keys_are_copied(spark, skewed):
    found = {r["id"]: r["_tasks"] for r in hot_keys(skewed, ["id"], hot_rows=1000).collect()}
    assert found == {"hot": 3}
    assert hot_keys(skewed, ["id"]).isEmpty()
    lookup = skewed.select("id").distinct()
    for how, n in (("left_semi", 6000), ("left_anti", 0), ("left", 6000), ("inner", 6000)):
        assert spread_join(skewed, lookup, ["id"], how, hot_rows=1000).count() == n


def test_national_gate_splits_the_hot_key(spark, skewed, without_broadcast, monkeypatch):
    monkeypatch.setattr(spread_join, "__defaults__", ("inner", 300))
    national = skewed.select("id", "trend_score")
    gated = enrich.national_gate(skewed, national)
    peaks = {r["id"]: r["peak"] for r in enrich.national_peaks(national).collect()}
    wanted = [r for r in skewed.collect() if peaks[r["id"]] >= 50]
    assert sorted(map(tuple, gated.collect())) == sorted(map(tuple, wanted))
    assert _largest_share(gated) < 0.25


def test_keyed_fact_is_whole(spark, skewed, without_broadcast):
    tables = [dim.new_rows(skewed) for dim in dims.DIMENSIONS]
    fact = dims.fact_with_keys(skewed, *tables)
    assert fact.count() == 6000
    assert fact.select("artist_id").distinct().count() == skewed.select("id").distinct().count()


def test_windows_see_aggregated_rows_only(skewed):
    """The hot artist reaches the weekly window as one row per week."""
    weekly = analytics.weekly_means(skewed).where("id = 'hot'").count()
    assert weekly <= 30
    assert analytics.velocity(skewed).where("id = 'hot'").count() == weekly


def test_hot_keys_by_way_of_cells(spark, skewed, monkeypatch):
    """A cell that many keys fill has no hot key for that; null keys count as one, as before."""
    from trendengine.operators import joins

    rows = skewed.select(F.concat("id", F.col("ingest_seq").cast("string")).alias("k"))
    assert hot_keys(rows, ["k"], hot_rows=10).isEmpty()
    monkeypatch.setattr(joins, "CELLS", 1)
    assert hot_keys(rows, ["k"], hot_rows=10).isEmpty()
    assert [tuple(r) for r in hot_keys(skewed, ["id"], hot_rows=1000).collect()] == [("hot", 3)]
    nulls = skewed.select(F.when(F.col("id") != "hot", F.col("id")).alias("id"))
    assert [tuple(r) for r in hot_keys(nulls, ["id"], hot_rows=1000).collect()] == [(None, 3)]
