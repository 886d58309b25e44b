"""Large dimensions joined where their rows lie: facts and dimension in buckets of one key.

Both tables are written once into the same number of buckets by the hash of the key, each bucket sorted. A join on the key then reads bucket by
bucket: no exchange, no broadcast, no sort. It pays where the same two large tables are joined time after time; a key that holds much of the fact
stays in one bucket, so hot keys are better served by the joins of `dims`, which split them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendengine.session import scratch_path


def bucketed(spark: SparkSession, df: DataFrame, key: str, buckets: int, label: str) -> DataFrame:
    """``df`` stored in buckets of ``key``, as an external table of the session's catalog with a name of its own."""
    name = f"{label}_{uuid.uuid4().hex}"
    # one file per bucket, so that the sorted order holds on reading
    rows = df.repartition(buckets, key)
    rows.write.option("path", scratch_path(spark, name)).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def join_buckets(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """``facts`` with the columns of ``dim``, null where it lacks the key; both as `bucketed` made them."""
    return facts.join(dim.hint("merge"), key, "left")


def artist_fact(facts: DataFrame, artists: DataFrame) -> DataFrame:
    """Artist numbers beside the rows (spotify_id, location, date, trend_score) of bucketed tables; rows without one are left out."""
    keyed = join_buckets(facts, artists, "spotify_id").where(F.col("artist_id").isNotNull())
    return keyed.select("artist_id", "location", "date", "trend_score")
