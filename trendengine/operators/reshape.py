"""Wide to long: enriched records whose keys carry region and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendengine.constants import TREND_KEY_PATTERN, TREND_KEY_PREFIX
from trendengine.functions import scores as S
from trendengine.functions import text as X


def unpivot_trends(lines: DataFrame, value: str = "value", mode: str = "FAILFAST") -> DataFrame:
    """Long rows from JSON lines with ``daily_trends_<ST>`` maps or ``daily_trends_<ST>_<day>`` scores.

    Keys are data, so a line is read as a map, never as columns. Flags, keys of another
    form and missing scores drop out.
    """
    as_map = "map<string,string>"
    options = {"mode": mode}
    record = F.from_json(value, as_map, options)
    records = lines.where(F.trim(value) != "").select(record.alias("r"))
    # The outer form of explode keeps Spark from testing the parsed map for emptiness first,
    # which would parse each line twice; the filters drop what it adds.
    entries = records.select(
        F.col("r")["artist"].alias("artist"),
        F.col("r")["id"].alias("id"),
        _genre_text(F.col("r")["genres"]).alias("genres"),
        F.explode_outer("r").alias("k", "v"),
    ).where(F.col("k").startswith(TREND_KEY_PREFIX) & F.col("v").isNotNull())
    # A nested map gives its own (day, score) pairs; a plain score is a pair with an empty day.
    nested = F.col("v").startswith("{")
    pairs = F.when(nested, F.from_json("v", as_map, options)).otherwise(
        F.create_map(F.lit(""), F.col("v"))
    )
    scores = entries.select("artist", "id", "genres", "k", F.explode_outer(pairs).alias("day", "score"))
    key = F.when(F.col("day") == "", F.col("k")).otherwise(F.concat_ws("_", "k", "day"))
    located = scores.withColumn("k", key).where(F.col("k").rlike(TREND_KEY_PATTERN))
    part = lambda i: F.regexp_extract("k", TREND_KEY_PATTERN, i)
    return located.select(
        "artist",
        "id",
        "genres",
        F.upper(part(1)).alias("location"),
        S.to_day(part(2)).alias("date"),
        F.col("score").try_cast("double").alias("trend_score"),
    ).where(F.col("trend_score").isNotNull())


def parsed_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that are not blank, with their record as a VARIANT ``v``; null where a line is no JSON object or names a key twice."""
    rows = lines.where(F.trim(value) != "").withColumn("v", F.try_parse_json(value))
    return rows.withColumn("v", F.when(F.schema_of_variant("v").startswith("OBJECT"), F.col("v")))


def rejected_records(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Broken lines, each with the place of a first look: cut short, no object, or other."""
    text = F.trim(value)
    reason = (
        F.when(text.startswith("{") & ~text.endswith("}"), "cut short").when(~text.startswith("{"), "no object").otherwise("malformed")
    )
    return parsed.where("v IS NULL").select(F.col(value), reason.alias("reason"))


def unpivot_records(parsed: DataFrame) -> DataFrame:
    """`unpivot_trends` over parsed records: long rows from keys that are data. The record is parsed once, its keys become rows as they are.

    Broken lines have no rows here; `rejected_records` has them.
    """
    text = lambda v, path="$": F.try_variant_get(v, path, "string")
    is_object = lambda c: f"schema_of_variant({c}) LIKE 'OBJECT%'"
    genres = F.when(
        F.schema_of_variant(F.try_variant_get("v", "$.genres", "variant")).startswith("ARRAY"),
        X.join_list(F.try_variant_get("v", "$.genres", "array<string>")),
    ).otherwise(F.coalesce(text("v", "$.genres"), F.lit("")))
    records = parsed.where("v IS NOT NULL").select("v", text("v", "$.artist").alias("artist"), text("v", "$.id").alias("id"), genres.alias("genres"))
    spark = parsed.sparkSession
    # a score by itself is one row with an empty day; a map of scores gives its own
    found = spark.sql(
        f"""SELECT artist, id, genres, e.key AS k, coalesce(d.key, '') AS day, coalesce(d.value, e.value) AS score
        FROM {{records}}, LATERAL variant_explode(v) AS e,
          LATERAL variant_explode_outer(CASE WHEN {is_object("e.value")} THEN e.value END) AS d
        WHERE startswith(e.key, '{TREND_KEY_PREFIX}') AND NOT is_variant_null(e.value)""",
        records=records,
    )
    key = F.when(F.col("day") == "", F.col("k")).otherwise(F.concat_ws("_", "k", "day"))
    part = lambda i: F.regexp_extract("k", TREND_KEY_PATTERN, i)
    return found.withColumn("k", key).where(F.col("k").rlike(TREND_KEY_PATTERN)).select(
        "artist",
        "id",
        "genres",
        F.upper(part(1)).alias("location"),
        S.to_day(part(2)).alias("date"),
        text("score").try_cast("double").alias("trend_score"),
    ).where(F.col("trend_score").isNotNull())


def processed_artists(lines: DataFrame, value: str = "value") -> DataFrame:
    """Names already in the enriched lines, for a run that goes on where another stopped; broken lines have none."""
    name = F.trim(F.get_json_object(F.col(value), "$.artist"))
    return lines.select(name.alias("artist")).where(F.col("artist") != "").distinct()


def _genre_text(genres: Column) -> Column:
    """Genres of a record as one text, be they a list, a text or missing."""
    listed = X.join_list(F.from_json(genres, "array<string>"))
    return F.when(genres.startswith("["), listed).otherwise(F.coalesce(genres, F.lit("")))
