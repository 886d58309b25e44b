"""Keep one row per key, with a defined winner.

Grouping with ``min_by`` / ``max_by`` combines on the map side, so a key that holds
a large part of the rows reaches the shuffle as one row per task. One aggregate per
column, not one struct, lets Catalyst drop the columns a later step does not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendengine.schemas import GRAIN


def _pick(df: DataFrame, keys: list[str], order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(*(pick(F.col(c), order).alias(c) for c in rest))
    return picked.select(*df.columns)


def keep_first(df: DataFrame, keys: list[str], order="ingest_seq") -> DataFrame:
    return _pick(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: list[str], order="ingest_seq") -> DataFrame:
    return _pick(df, keys, order, F.max_by)


#: Places in a row are ints, so they have room below a step of the place in the input.
STEP = 2**31


def dedup_trends(exploded: DataFrame, seq: str = "ingest_seq", pos: str = "genre_pos") -> DataFrame:
    """One row per (id, genres, location, date); the first one read wins, then the genre named first in it.

    Two steps that hash: the smallest place per key, one decimal of fixed width that is combined before the shuffle, then
    the rows at these places. Picking text by its place in one aggregate would sort all rows, twice. The join is on
    place and key, so a key with many copies does not meet in one task. Without ``pos`` rows are picked by ``seq`` alone.
    """
    if pos not in exploded.columns:
        return keep_first(exploded, GRAIN, seq)
    place = F.col(seq).cast("decimal(19,0)") * F.lit(STEP).cast("decimal(10,0)") + F.col(pos)
    first = exploded.groupBy(*GRAIN).agg(F.min(place.cast("decimal(30,0)")).alias("_place"))
    first = first.select(
        *(F.col(c).alias(f"_{c}") for c in GRAIN),
        F.expr(f"_place div {STEP}BD").alias("_seq"),
        F.expr(f"_place % {STEP}BD").cast("int").alias("_pos"),
    )
    same = (F.col(seq) == F.col("_seq")) & (F.col(pos) == F.col("_pos"))
    for c in GRAIN:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return exploded.join(first, same, "left_semi")


def first_scores(exploded: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """Keys and scores of the same rows, for facts: with a score of fixed width one aggregate hashes, in one pass."""
    return keep_first(exploded.select(*GRAIN, "trend_score", seq), GRAIN, seq).drop(seq)


def dedup_stats(exploded: DataFrame) -> DataFrame:
    """Rows before and after, and what was removed."""
    before, after = F.sum("n"), F.count(F.lit(1))
    return (
        exploded.groupBy(*GRAIN)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(before, F.lit(0)).alias("rows_before"), after.alias("rows_after"))
        .select(
            "rows_before",
            "rows_after",
            (F.col("rows_before") - F.col("rows_after")).alias("removed"),
            F.round(
                F.try_divide(
                    100.0 * (F.col("rows_before") - F.col("rows_after")), F.col("rows_before")
                ),
                2,
            ).alias("removed_percent"),
        )
    )


def dedup_artists(artists: DataFrame, run_ts: str, order="ingest_seq") -> DataFrame:
    """One row per artist id, the last one read; missing genres become an empty list."""
    rows = artists
    if "genres" not in rows.columns:
        rows = rows.withColumn("genres", F.lit(None).cast("array<string>"))
    return keep_last(rows, ["id"], order).select(
        "artist",
        "id",
        F.coalesce("genres", F.array().cast("array<string>")).alias("genres"),
        F.lit(run_ts).alias("scrape_date"),
    )
