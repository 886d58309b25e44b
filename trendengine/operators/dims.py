"""Incremental dimensions with dense surrogate keys, and the tables keyed by them.

A new key gets the next free number in order of first appearance. Keys on record are
never renumbered or renamed, so a second run over the same input adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendengine.functions import genres as G
from trendengine.functions import text as X
from trendengine.operators.numbering import number_rows
from trendengine.schemas import DIM_ARTISTS, DIM_GENRES, DIM_LOCATIONS

# Places in a row and in its genre text are ints, so each has room below the next one, and a
# long times both steps stays below 10^38.
STEP = 2**31


def _usable(clean_df: DataFrame) -> DataFrame:
    """Rows with id and location, both standardized again in case they were edited."""
    return clean_df.withColumns(
        {
            "id": X.blank_to_null("id"),
            "location": F.upper(X.blank_to_null("location")),
            "artist": F.trim("artist"),
        }
    ).where(F.col("id").isNotNull() & F.col("location").isNotNull())


def artist_keys(clean_df: DataFrame, seq="ingest_seq", pos: str | None = None) -> DataFrame:
    """Artist ids with first appearance and their last name that is not blank.

    The table is first reduced to its distinct pairs of id and name, which hashing does; picking
    a text by its position would sort the input and is left to the few pairs.
    """
    pairs = (
        _usable(clean_df)
        .groupBy("id", "artist")
        .agg(F.min(seq).alias("_first"), F.max(seq).alias("_last"))
    )
    named = F.col("artist").isNotNull() & (F.col("artist") != "")
    last_name = F.max_by("artist", F.when(named, F.col("_last")))
    return (
        pairs.groupBy(F.col("id").alias("spotify_id"))
        .agg(F.min("_first").alias("_seq"), F.coalesce(last_name, F.lit("")).alias("artist_name"))
        .withColumn("_pos", F.lit(0))
    )


def genre_keys(clean_df: DataFrame, seq="ingest_seq", pos: str | None = None) -> DataFrame:
    """Genres with first appearance; ``pos`` orders rows that share ``seq``, then token order counts.

    Place in the input is one decimal, so that one minimum finds it and the aggregate keeps
    a fixed-width buffer, i.e. hashes instead of sorting its input.
    """
    text = G.unify_delimiters(G.fill_unknown(F.trim("genres")))
    order = F.col(pos) if pos else F.lit(0)
    tokens = _usable(clean_df).select(
        F.col(seq).alias("_seq"), order.alias("_row"), F.posexplode_outer(F.split(text, ";")).alias("_i", "_raw")
    )
    inner = F.col("_row").cast("long") * F.lit(STEP) + F.col("_i")
    place = F.col("_seq").cast("decimal(19,0)") * F.lit(STEP**2).cast("decimal(19,0)") + inner.cast("decimal(19,0)")
    return (
        tokens.withColumn("genre", X.genre_name("_raw"))
        .where(F.col("genre").isNotNull())
        .groupBy("genre")
        .agg(F.min(place.cast("decimal(38,0)")).alias("_place"))
        .select(
            "genre",
            F.expr(f"_place div {STEP**2}BD").alias("_seq"),
            F.expr(f"_place % {STEP**2}BD").cast("long").alias("_pos"),
        )
    )


def location_keys(clean_df: DataFrame, seq="ingest_seq", pos: str | None = None) -> DataFrame:
    return (
        _usable(clean_df)
        .groupBy(F.col("location").alias("state_code"))
        .agg(F.min(seq).alias("_seq"))
        .withColumn("_pos", F.lit(0))
    )


def is_valid(number: Column, key: Column) -> Column:
    return number.isNotNull() & key.isNotNull() & (F.coalesce(key, F.lit("")) != "")


def valid_dim(existing: DataFrame, id_col: str, key_col: str, standardize=F.trim) -> DataFrame:
    """Rows of a stored dimension that have both number and natural key."""
    rows = existing.withColumn(key_col, standardize(F.col(key_col)))
    return rows.where(is_valid(F.col(id_col), F.col(key_col)))


@dataclass(frozen=True)
class Dimension:
    """How one dimension is keyed, scanned and stored."""

    name: str
    schema: T.StructType
    id_col: str
    key_col: str
    scan: Callable[..., DataFrame]
    standardize: Callable[..., Column] = F.trim
    labels: tuple[str, ...] = ()

    def missing_keys(self, clean_df: DataFrame, existing: DataFrame | None = None, **order) -> DataFrame:
        """Keys of the rows that are not on record, with their place of first appearance."""
        keys = self.scan(clean_df, **order)
        if existing is None:
            return keys
        return keys.join(self.valid(existing).select(self.key_col), self.key_col, "left_anti")

    def number(self, keys: DataFrame, existing: DataFrame | None = None) -> DataFrame:
        """Keys as rows to append, numbered after the highest number on record."""
        start = F.lit(0)
        if existing is not None:
            highest = F.coalesce(F.max(self.id_col), F.lit(0))
            start = self.valid(existing).agg(highest).scalar()
        numbered = number_rows(keys, "_seq", ["_pos", self.key_col], "_number")
        return numbered.select(
            (F.col("_number") + start).alias(self.id_col), self.key_col, *self.labels
        )

    def new_rows(self, clean_df: DataFrame, existing: DataFrame | None = None, **order) -> DataFrame:
        return self.number(self.missing_keys(clean_df, existing, **order), existing)

    def row_counts(self, existing: DataFrame) -> DataFrame:
        """Stored rows, and how many of them lack number or natural key."""
        usable = is_valid(F.col(self.id_col), self.standardize(F.col(self.key_col)))
        return existing.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(usable).alias("n_valid"),
            F.count_if(~usable).alias("n_invalid"),
        )

    def valid(self, existing: DataFrame) -> DataFrame:
        return valid_dim(existing, self.id_col, self.key_col, self.standardize)


ARTISTS = Dimension(
    "dim_artists", DIM_ARTISTS, "artist_id", "spotify_id", artist_keys, labels=("artist_name",)
)
GENRES = Dimension("dim_genres", DIM_GENRES, "genre_id", "genre", genre_keys, X.genre_name)
LOCATIONS = Dimension(
    "dim_locations", DIM_LOCATIONS, "location_id", "state_code", location_keys, X.state_code
)
DIMENSIONS = [ARTISTS, GENRES, LOCATIONS]


def _numbered(rows: DataFrame, dim_rows: DataFrame, dim: Dimension, column: str) -> DataFrame:
    """Number of one dimension next to its natural key, null where the dimension lacks it.

    Keys of a dimension are unique, so rows stay as many. A dimension read from storage is broadcast
    if it is small by its file sizes; else both sides are shuffled, and keys with very many rows are split.
    """
    lookup = dim_rows.select(F.col(dim.key_col).alias(column), dim.id_col)
    return rows.join(lookup, column, "left")


def single_genres(rows: DataFrame) -> DataFrame:
    """Genres as the dimension spells them: one that still holds several is split, each part once a row."""
    parts = F.array_distinct(F.transform(F.split(G.unify_delimiters(F.col("genres")), ";"), X.genre_name))
    parts = F.filter(parts, lambda x: x.isNotNull())
    # a genre of which nothing is left stays as a row without genre
    return rows.withColumn("genres", F.explode_outer(parts))


def _standard_keys(rows: DataFrame) -> DataFrame:
    """Ids and locations as the dimensions spell them; null where nothing is left."""
    return rows.withColumns({"id": X.blank_to_null("id"), "location": F.upper(X.blank_to_null("location"))})


def keyed_rows(trends: DataFrame, artists: DataFrame, genres: DataFrame, locations: DataFrame) -> DataFrame:
    """Trend rows, one per genre, with natural and surrogate keys; every row stays, numbers may be null."""
    rows = single_genres(_standard_keys(trends.select("id", "genres", "location", "date", "trend_score")))
    rows = _numbered(rows, artists, ARTISTS, "id")
    rows = _numbered(rows, genres, GENRES, "genres")
    return _numbered(rows, locations, LOCATIONS, "location")


_NUMBERS = ["artist_id", "genre_id", "location_id"]


def has_numbers(rows: DataFrame) -> Column:
    """Whether a row has every number that its table carries."""
    found = F.lit(True)
    for name in _NUMBERS:
        if name in rows.columns:
            found = found & F.col(name).isNotNull()
    return found


def rejected(keyed: DataFrame) -> DataFrame:
    """Rows that cannot enter a keyed table, with the keys that no dimension has."""
    return keyed.where(~has_numbers(keyed))


def key_counts(keyed: DataFrame) -> DataFrame:
    """Rows, those with all numbers and those rejected, and how many lack each number."""
    lacks = [F.count_if(F.col(c).isNull()).alias(f"without_{c}") for c in _NUMBERS if c in keyed.columns]
    complete = F.count_if(has_numbers(keyed))
    n = F.count(F.lit(1))
    return keyed.agg(n.alias("n_rows"), complete.alias("n_keyed"), (n - complete).alias("n_rejected"), *lacks)


def fact_with_keys(trends: DataFrame, artists: DataFrame, genres: DataFrame, locations: DataFrame) -> DataFrame:
    """Natural keys replaced by surrogate keys; see ``rejected`` for rows without one."""
    rows = keyed_rows(trends, artists, genres, locations)
    return rows.where(has_numbers(rows)).select("artist_id", "genre_id", "location_id", "date", "trend_score")


def artist_genres(exploded: DataFrame, artists: DataFrame, genres: DataFrame) -> DataFrame:
    """Pairs of artist and genre numbers. Pairs are made unique before the joins."""
    pairs = single_genres(exploded.select("id", "genres").withColumn("id", X.blank_to_null("id"))).distinct()
    rows = _numbered(_numbered(pairs, artists, ARTISTS, "id"), genres, GENRES, "genres")
    return rows.where(has_numbers(rows)).select("artist_id", "genre_id")


def keyed_artist_rows(artist_rows: DataFrame, artists: DataFrame, locations: DataFrame) -> DataFrame:
    """Daily artist rows with natural and surrogate keys; every row stays, numbers may be null."""
    rows = _standard_keys(artist_rows.select("id", "location", "date", "trend_score"))
    return _numbered(_numbered(rows, artists, ARTISTS, "id"), locations, LOCATIONS, "location")


def fact_artist_trends(artist_rows: DataFrame, artists: DataFrame, locations: DataFrame) -> DataFrame:
    """Daily score per artist and location, without genre."""
    rows = keyed_artist_rows(artist_rows, artists, locations)
    return rows.where(has_numbers(rows)).select("artist_id", "location_id", "date", "trend_score")


def exploded_view(artist_fact: DataFrame, pairs: DataFrame) -> DataFrame:
    """Artist fact with one row per genre of the artist, for genre-level aggregates only. A row without any genre stays, with a null number."""
    return artist_fact.join(pairs, "artist_id", "left").select(
        "artist_id", "genre_id", "location_id", "date", "trend_score"
    )
