"""Schemas of the tables that cross a boundary (files, warehouse)."""

from pyspark.sql import types as T

_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()


def _struct(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


RAW_COLUMNS = ["artist", "id", "genres", "location", "date", "trend_score"]

# Raw trend rows arrive as text; typing is the job of the cleaning step.
RAW_SCHEMA = _struct(**{c: _S for c in RAW_COLUMNS})

CLEAN_SCHEMA = _struct(
    artist=_S, id=_S, genres=_S, location=_S, date=T.DateType(), trend_score=_D
)

# Natural key of the exploded trend table and of the artist-level fact.
GRAIN = ["id", "genres", "location", "date"]
ARTIST_GRAIN = ["id", "location", "date"]

RISING_SCHEMA = T.StructType(
    [
        T.StructField("artist", _S),
        T.StructField("id", _S),
        T.StructField("scrape_date", _S),
        T.StructField("genres", T.ArrayType(_S)),
    ]
)

_LINKS = T.MapType(_S, _S)
_IMAGES = T.ArrayType(_struct(url=_S, height=_L, width=_L))

# --- fixed values: field names of stored search objects, and column names of tables ---
# Search results stored under genre=<g>/market=<m>/ (the two come from the path).
ARTIST_OBJECT_SCHEMA = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("name", _S),
        T.StructField("genres", T.ArrayType(_S)),
        T.StructField("popularity", T.LongType()),
        T.StructField("followers", T.StructType([T.StructField("total", _L)])),
        T.StructField("type", _S),
        T.StructField("uri", _S),
        T.StructField("href", _S),
        T.StructField("images", _IMAGES),
        T.StructField("external_urls", _LINKS),
    ]
)

_ARTIST_REF = T.StructType([T.StructField("id", _S), T.StructField("name", _S)])

TRACK_OBJECT_SCHEMA = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("name", _S),
        T.StructField("artists", T.ArrayType(_ARTIST_REF)),
        T.StructField("popularity", _L),
        T.StructField("duration_ms", _L),
        T.StructField("explicit", T.BooleanType()),
        T.StructField("track_number", _L),
        T.StructField("disc_number", _L),
        T.StructField("is_local", T.BooleanType()),
        T.StructField("is_playable", T.BooleanType()),
        T.StructField("type", _S),
        T.StructField("uri", _S),
        T.StructField("href", _S),
        T.StructField("preview_url", _S),
        T.StructField("external_urls", _LINKS),
        T.StructField("external_ids", _LINKS),
        T.StructField(
            "album",
            _struct(id=_S, name=_S, album_type=_S, release_date=_S, total_tracks=_L, images=_IMAGES, external_urls=_LINKS),
        ),
    ]
)

DIM_ARTISTS = _struct(artist_id=_L, spotify_id=_S, artist_name=_S)
DIM_GENRES = _struct(genre_id=_L, genre=_S)
DIM_LOCATIONS = _struct(location_id=_L, state_code=_S)
