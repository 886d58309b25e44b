"""Facts and rankings over the clean trend table.

Groups that may hold a large part of the rows are aggregated before any window, so a
window holds at most one row per day, week, genre or artist of its group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trendengine.functions import scores as S

PLACES = 6


def _rounded(c: Column, name: str) -> Column:
    """Six places, whatever the order in which the rows were summed.

    Sums of doubles differ in their last bits from run to run. Where the exact value lies half
    way between two results, a first rounding at the ninth place takes that noise away.
    """
    return F.round(F.round(c, PLACES + 3), PLACES).alias(name)


def trend_cells(trends: DataFrame, *keys: str) -> DataFrame:
    """Count, sum and maximum of the scores per key: cells that add up, so those of several batches merge (`merged_cells`)."""
    return trends.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("trend_score").alias("s"),
        F.max("trend_score").alias("m"),
    )


def merged_cells(cells: DataFrame, *keys: str) -> DataFrame:
    return cells.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.max("m").alias("m"))


def fact_genre_trends(trends: DataFrame) -> DataFrame:
    """Scores per genre, location and day."""
    return genre_fact_of(trend_cells(trends, "genres", "location", "date"))


def genre_fact_of(cells: DataFrame) -> DataFrame:
    """The genre fact from its merged cells."""
    return cells.select(
        "genres",
        "location",
        "date",
        _rounded(F.col("s") / F.col("n"), "avg_score"),
        F.col("m").alias("max_score"),
        F.col("n").alias("n_artists"),
    )


def regional_genre_share(trends: DataFrame) -> DataFrame:
    """Share of each genre in the summed score of its location."""
    cells = trends.groupBy("location", "genres").agg(F.sum("trend_score").alias("score"))
    total = F.sum("score").over(W.partitionBy("location"))  # one row per genre
    return cells.select(
        "location",
        "genres",
        _rounded(F.col("score"), "score"),
        _rounded(F.try_divide(F.col("score"), total), "share"),
    )


def trend_rollups(trends: DataFrame) -> DataFrame:
    """Totals by genre, by location, by both and overall.

    Grouping sets copy each input row once per set, so they run over the cells.
    """
    return _cube(trend_cells(trends, "genres", "location"))


def rollups_of(cells: DataFrame) -> DataFrame:
    """Totals from finer cells, such as those of the genre fact."""
    return _cube(merged_cells(cells, "genres", "location"))


def _cube(cells: DataFrame) -> DataFrame:
    return cells.cube("genres", "location").agg(
        F.sum("n").alias("n_rows"),
        _rounded(F.sum("s") / F.sum("n"), "avg_score"),
        F.max("m").alias("max_score"),
        F.grouping_id().cast("long").alias("level"),
    )


def weekly_means(trends: DataFrame) -> DataFrame:
    return (
        trends.withColumn("week", F.date_trunc("week", "date").cast("date"))
        .groupBy("id", "genres", "location", "week")
        .agg(F.avg("trend_score").alias("avg_score"))
    )


def velocity(trends: DataFrame, across_gaps: bool = False) -> DataFrame:
    """Change of the weekly mean against the week before; null where that week has no rows.

    With ``across_gaps`` the week before is the previous one on record, however long ago.
    """
    by_week = W.partitionBy("id", "genres", "location").orderBy("week")
    follows = (F.datediff("week", F.lag("week").over(by_week)) == 7) | F.lit(across_gaps)
    change = F.when(follows, F.col("avg_score") - F.lag("avg_score").over(by_week))
    return weekly_means(trends).select(
        "id",
        "genres",
        "location",
        "week",
        _rounded(F.col("avg_score"), "avg_score"),
        _rounded(change, "velocity"),
    )


def _top(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """First k rows of each group. Catalyst cuts each task to k rows per group before the shuffle."""
    ranked = df.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("long"))


def rising_artists(trends: DataFrame, k: int = 3, across_gaps: bool = False) -> DataFrame:
    """Artists with the highest velocity per genre, location and week."""
    moving = velocity(trends, across_gaps).where(F.col("velocity").isNotNull())
    order = [F.desc("velocity"), F.asc("id")]
    return _top(moving, ["genres", "location", "week"], order, k)


def top_artists(trends: DataFrame, k: int = 3) -> DataFrame:
    """Artists with the highest mean score per genre and location."""
    means = trends.groupBy("genres", "location", "id").agg(
        _rounded(F.avg("trend_score"), "avg_score"), F.max("trend_score").alias("peak")
    )
    order = [F.desc("avg_score"), F.desc("peak"), F.asc("id")]
    return _top(means, ["genres", "location"], order, k)


def trending_in_region(artist_fact: DataFrame, location: str, k: int = 10) -> DataFrame:
    """Artists of one location by peak score: a top-k, without a full sort."""
    return (
        artist_fact.where(F.col("location") == location)
        .groupBy("id")
        .agg(F.max("trend_score").alias("peak"), F.count(F.lit(1)).alias("n_days"))
        .orderBy(F.desc("peak"), F.asc("id"))
        .limit(k)
    )


def trajectory(artist_fact: DataFrame, days: int = 7) -> DataFrame:
    """Moving average over the last ``days`` calendar days per artist and location."""
    day = F.unix_date("date")
    recent = W.partitionBy("id", "location").orderBy(day).rangeBetween(-(days - 1), 0)
    return artist_fact.select(
        "id",
        "location",
        "date",
        "trend_score",
        _rounded(F.avg("trend_score").over(recent), "moving_avg"),
        F.count(F.lit(1)).over(recent).alias("n_days"),
    )


def genre_direction(genre_fact: DataFrame) -> DataFrame:
    """Change of the mean genre score against the previous day on record, and its sign."""
    by_day = W.partitionBy("genres", "location").orderBy("date")
    change = F.col("avg_score") - F.lag("avg_score").over(by_day)
    moved = genre_fact.select(
        "genres", "location", "date", "avg_score", _rounded(change, "change")
    )
    return moved.withColumn("direction", F.signum("change").cast("long"))


def fill_calendar(artist_fact: DataFrame) -> DataFrame:
    """Every day between first and last per artist and location, with 0 on days without a score.

    Days are added between a row and its successor, so the fact is neither joined nor re-read.
    """
    by_day = W.partitionBy("id", "location").orderBy("date")
    until = F.coalesce(F.date_sub(F.lead("date").over(by_day), 1), F.col("date"))
    spans = artist_fact.select(
        "id", "location", F.col("date").alias("_day"), "trend_score", until.alias("_until")
    )
    days = spans.select("*", F.explode_outer(F.sequence("_day", "_until")).alias("date"))
    observed = F.col("date") == F.col("_day")
    return days.select(
        "id",
        "location",
        "date",
        F.when(observed, F.col("trend_score")).otherwise(F.lit(0.0)).alias("trend_score"),
        (~observed).alias("filled"),
    )


def in_span(trends: DataFrame, span) -> DataFrame:
    """Rows of a range of days (see ``last_complete_month`` and ``last_days``)."""
    return trends.where(S.within(F.col("date"), span))


def artist_fact_rows(clean_df: DataFrame, order="ingest_seq") -> DataFrame:
    """One score per artist, location and day from the un-exploded table.

    Exploded rows would count a score once per genre.
    """
    return (
        clean_df.groupBy("id", "location", "date")
        .agg(F.min_by("trend_score", order).alias("trend_score"))
    )
