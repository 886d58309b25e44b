"""Joins and lookups around the artist list: names, genres, work lists, cached scores."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendengine.constants import (
    MARKETS,
    NATIONAL_GATE_MIN_PEAK,
    NATIONAL_GEO,
    REGION_CODES,
    STATE_NAMES,
)
from trendengine.functions import text as X
from trendengine.operators.clean import require_columns
from trendengine.operators.dedup import keep_first, keep_last
from trendengine.operators.joins import spread_join
from trendengine.session import remove_folder
from trendengine.sources.batches import folder_names


def state_table(spark: SparkSession) -> DataFrame:
    """The 51 state codes and names."""
    rows = ", ".join(f"('{code}', '{name}')" for code, name in STATE_NAMES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS states(state_code, state_name)")


def join_state_name(df: DataFrame, code: str = "state_code") -> DataFrame:
    """State name by code, null for an unknown code. The table is fixed at 51 rows, so it is broadcast."""
    states = state_table(df.sparkSession).withColumnRenamed("state_code", code)
    return df.join(F.broadcast(states), code, "left").select(*df.columns, "state_name")


def valid_genres(genres: DataFrame) -> DataFrame:
    """Genre list without blank entries and words for a missing value."""
    require_columns(genres, ["genre_id", "genre"])
    return genres.select("genre_id", F.trim("genre").alias("genre")).where(~X.is_null_like(F.col("genre")))


def first_artist(tracks: DataFrame) -> DataFrame:
    """First artist of each track; tracks without one are skipped."""
    artist = F.try_element_at(F.col("track.artists"), F.lit(1))
    others = [c for c in tracks.columns if c != "track"]
    return tracks.select(
        *others, artist["name"].alias("artist"), artist["id"].alias("id")
    ).where(F.col("id").isNotNull())


def playlist_artists(tracks: DataFrame) -> DataFrame:
    """Artists per playlist, the first track of each artist counting."""
    return keep_first(first_artist(tracks), ["playlist", "id"], "position")


def union_playlists(playlists: list[DataFrame]) -> DataFrame:
    """All playlists as one table; columns go by name."""
    whole = playlists[0]
    for other in playlists[1:]:
        whole = whole.unionByName(other, allowMissingColumns=True)
    return whole


def enrich_genres(artists: DataFrame, cache: DataFrame) -> DataFrame:
    """Genres from the cache (artist_id, genres). An empty list is a hit, an absent id a miss."""
    known = cache.select(F.col("artist_id").alias("id"), F.col("genres"), F.lit(True).alias("hit"))
    return artists.drop("genres").join(known, "id", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def genre_cache_stats(enriched: DataFrame) -> DataFrame:
    return enriched.agg(
        F.count_if("hit").alias("cache_hits"), F.count_if(~F.col("hit")).alias("cache_misses")
    )


def artist_locations(rows: DataFrame) -> DataFrame:
    """Sorted locations per artist. As long as the number of locations, i.e. of codes once `key_shape_check` passes."""
    return (
        rows.where(F.col("location").isNotNull())
        .groupBy("id")
        .agg(F.array_sort(F.collect_set("location")).alias("locations"))
    )


def unprocessed_artists(artists: DataFrame, processed: DataFrame) -> DataFrame:
    """Artists with a name that is not in the output yet; case and outer spaces do not count."""
    name = F.lower(F.trim("artist"))
    done = processed.select(name.alias("_name")).where(F.col("_name") != "").distinct()
    named = artists.withColumn("_name", name).where(F.col("_name") != "")
    return spread_join(named, done, ["_name"], "left_anti").select(*artists.columns)


def with_artist_key(df: DataFrame, name: str = "artist") -> DataFrame:
    return df.withColumn("artist_key", X.norm_key(name))


def all_requests(artists: DataFrame, month: str) -> DataFrame:
    """Requests (artist, region) of one month, answered or not."""
    keys = with_artist_key(artists).where(F.col("artist_key") != "").select("artist_key").distinct()
    regions = F.array(*(F.lit(f"{NATIONAL_GEO}-{code}") for code in REGION_CODES))
    return keys.select("artist_key", F.explode(regions).alias("geo"), F.lit(month).alias("month"))


def pending_requests(artists: DataFrame, cache: DataFrame, month: str) -> DataFrame:
    """Requests (artist, region) not answered by the cache for one month.

    The regions on record are gathered per artist before the join and taken off the fixed
    list of 50, so only open requests are ever made into rows.
    """
    keys = with_artist_key(artists).where(F.col("artist_key") != "").select("artist_key").distinct()
    names = [f"{NATIONAL_GEO}-{code}" for code in REGION_CODES]
    known = (
        cache.where((F.col("month") == month) & F.col("geo").isin(names))
        .groupBy("artist_key")
        .agg(F.collect_set("geo").alias("_known"))
    )
    regions = F.array(*map(F.lit, names))
    open_regions = F.array_except(regions, F.coalesce("_known", F.array().cast("array<string>")))
    return keys.join(known, "artist_key", "left").select(
        "artist_key", F.explode(open_regions).alias("geo"), F.lit(month).alias("month")
    )


def genre_market_grid(genres: DataFrame) -> DataFrame:
    """Each genre with each of the nine markets."""
    return genres.select("genre", F.explode(F.array(*map(F.lit, MARKETS))).alias("market"))


def national_peaks(national: DataFrame) -> DataFrame:
    return national.groupBy("id").agg(F.max("trend_score").alias("peak"))


def national_gate(
    regional: DataFrame, national: DataFrame, min_peak: float = NATIONAL_GATE_MIN_PEAK
) -> DataFrame:
    """Regional rows of artists whose national peak reaches the threshold."""
    passing = national_peaks(national).where(F.col("peak") >= min_peak).select("id")
    return spread_join(regional, passing, ["id"], "left_semi")


def cache_upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Cache with new entries in the place of old ones of the same key."""
    both = old.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)))
    return keep_last(both, keys, "_gen").drop("_gen")


#: Buckets of a stored cache. It is part of the layout: another number needs a new folder.
CACHE_BUCKETS = 64


def in_buckets(entries: DataFrame, keys: list[str], buckets: int = CACHE_BUCKETS) -> DataFrame:
    return entries.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def upsert_buckets(spark: SparkSession, root: str, new: DataFrame, keys: list[str], buckets: int = CACHE_BUCKETS) -> list[int]:
    """`cache_upsert` on a stored cache, ``<root>/data/bucket=…``: only buckets with new entries are read and replaced. Their numbers.

    New entries are written beside the cache first, then merged with what their buckets hold; a run that is cut short leaves the cache
    as it was, or with some buckets replaced whole, and may be repeated.
    """
    data, staged = f"{root}/data", f"{root}/_staged-{uuid.uuid4().hex}"
    in_buckets(new, keys, buckets).write.parquet(f"{staged}/new")
    new = spark.read.parquet(f"{staged}/new")
    touched = sorted(r[0] for r in new.select("bucket").distinct().collect())  # as many as there are buckets
    if touched:
        if folder_names(spark, data):
            old = spark.read.schema(new.schema).parquet(data).where(F.col("bucket").isin(touched))
            new = cache_upsert(old, new, [*keys, "bucket"])
        new.select(*new.columns).write.parquet(f"{staged}/merged")
        merged = spark.read.schema(new.schema).parquet(f"{staged}/merged")
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(data)
    remove_folder(spark, staged)
    return touched


def read_buckets(spark: SparkSession, root: str) -> DataFrame:
    """All entries of a stored cache."""
    return spark.read.parquet(f"{root}/data").drop("bucket")


def merge_cached_scores(cached: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Scores per request: the cached ones, else those just fetched.

    One grouping of both tables instead of two joins against the request list.
    """
    both = cached.withColumns({"_rank": F.lit(0), "source": F.lit("cache")}).unionByName(
        fresh.withColumns({"_rank": F.lit(1), "source": F.lit("fetch")})
    )
    return keep_first(both, keys, "_rank").drop("_rank")


def stamp_missing(df: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """Scrape time where there is none yet."""
    stamp = run_ts if isinstance(run_ts, str) else run_ts.strftime("%Y-%m-%d %H:%M:%S")
    if "scrape_date" not in df.columns:
        return df.withColumn("scrape_date", F.lit(stamp))
    return df.withColumn("scrape_date", F.coalesce("scrape_date", F.lit(stamp)))


def artists_table(artists: DataFrame) -> DataFrame:
    """Artist list with its genres as one text."""
    return artists.withColumn("genres", X.join_list("genres"))


def _staging_candidates(cleaned: DataFrame) -> DataFrame:
    from trendengine.functions import genres as G

    require_columns(cleaned, ["genres", "location"])
    genre = F.explode_outer(F.split(G.unify_delimiters(F.col("genres")), ";"))
    rows = cleaned.select(
        F.coalesce("artist", F.lit("")).alias("artist"),
        "id",
        genre.alias("genre"),
        X.state_code("location").alias("state_code"),
        F.col("date").try_cast("date").alias("date"),
        F.col("trend_score").try_cast("double").alias("trend_score"),
    )
    return rows.withColumn("genre", F.nullif(G.clean_token(F.col("genre")), F.lit("")))


def _fits_staging():
    """Keys are there, and the state code has the two characters that the warehouse column takes."""
    keys = F.col("id").isNotNull() & F.col("genre").isNotNull() & F.col("date").isNotNull()
    return keys & F.coalesce(F.length("state_code") == 2, F.lit(False))


def staging_rows(cleaned: DataFrame) -> DataFrame:
    """Exploded clean rows in warehouse form: one bare genre per row, state name added, load time stamped.

    A missing artist is empty text, as the warehouse column is not null; see ``staging_rejects`` for what is left out.
    """
    from trendengine.operators.quality import assert_single_genre

    rows = _staging_candidates(cleaned).where(_fits_staging())
    named = join_state_name(rows).withColumn("load_timestamp", F.current_timestamp())
    return assert_single_genre(named).select(
        "artist", "id", "genre", "state_code", "state_name", "date", "trend_score", "load_timestamp"
    )


def staging_rejects(cleaned: DataFrame) -> DataFrame:
    """How many rows the warehouse table takes, and how many it does not, by their first defect."""
    defect = (
        F.when(_fits_staging(), "none")
        .when(F.col("id").isNull() | F.col("date").isNull() | F.col("state_code").isNull(), "missing key")
        .when(F.col("genre").isNull(), "no genre")
        .otherwise("state code")
    )
    return _staging_candidates(cleaned).groupBy(defect.alias("defect")).agg(F.count(F.lit(1)).alias("n"))
