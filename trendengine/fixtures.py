"""Trend-shaped views over the provided tables, for the registered queries and the tests.

``RAW_SQL`` is the dirty raw table laid down in FIXTURES.md; the same text runs on Spark
and on the oracle engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_SQL = """
SELECT event_id AS ingest_seq,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE concat('  Artist ', CAST(user_id AS STRING), ' ') END AS artist,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE concat(' ', CAST(user_id AS STRING), ' ') END AS id,
  CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'Pop; Rock' WHEN 2 THEN 'Pop|Rock,EDM'
       WHEN 3 THEN concat('[', chr(39), 'Pop', chr(39), ', ', chr(39), 'Rock', chr(39), ']')
       WHEN 4 THEN 'Pop;;Rock;' WHEN 5 THEN '["indie pop"]' WHEN 6 THEN ' ; ' ELSE concat(' ', upper(event_type), ' ') END AS genres,
  CASE WHEN event_id % 89 = 0 THEN NULL
       ELSE CASE user_id % 5 WHEN 0 THEN ' nv ' WHEN 1 THEN 'ca' WHEN 2 THEN 'TX' WHEN 3 THEN 'ny ' ELSE 'xx' END END AS location,
  CASE WHEN event_id % 101 = 0 THEN 'bad-date'
       WHEN event_id % 2 = 0 THEN replace(CAST(CAST(ts AS DATE) AS STRING), '-', '_')
       ELSE CAST(CAST(ts AS DATE) AS STRING) END AS date,
  CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 37 = 0 THEN 'n/a'
       WHEN event_id % 41 = 0 THEN '-5' ELSE CAST(value AS STRING) END AS trend_score
FROM {events}
"""


# Rows that ask for more care: a list with a comma inside of an item, an empty list, blank keys, NaN, weeks without rows.
HARD_SQL = """
SELECT event_id AS ingest_seq, concat('Artist ', CAST(user_id AS STRING)) AS artist,
  CASE WHEN event_id % 7 = 0 THEN '   ' ELSE CAST(user_id AS STRING) END AS id,
  CASE event_id % 6 WHEN 0 THEN '["pop,rock"]' WHEN 1 THEN '[]' WHEN 2 THEN 'Pop' WHEN 3 THEN ' ' WHEN 4 THEN 'pop|' ELSE NULL END AS genres,
  CASE WHEN event_id % 11 = 0 THEN ' ' WHEN event_id % 13 = 0 THEN 'tex' WHEN event_id % 2 = 0 THEN 'nv' ELSE 'ca' END AS location,
  CAST(CAST(ts AS DATE) AS STRING) AS date,
  CASE event_id % 5 WHEN 0 THEN 'NaN' WHEN 1 THEN '250' ELSE CAST(value AS STRING) END AS trend_score
FROM {events}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hard_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(HARD_SQL, events=table(spark, sf_dir, "events"))


def raw_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_SQL, events=table(spark, sf_dir, "events"))


# The texts below hold {placeholders} for tables and for what the two engines spell differently.

# A genre list with entries that stand for a missing value.
GENRE_LIST_SQL = """
SELECT event_id AS genre_id,
  CASE event_id % 7 WHEN 0 THEN '<NA>' WHEN 1 THEN ' na ' WHEN 2 THEN 'NULL' WHEN 3 THEN ' '
       WHEN 4 THEN NULL ELSE concat(' ', event_type, ' ', CAST(user_id AS STRING)) END AS genre
FROM {events}
"""

# Artist records as scraped: several per id, some without genres or scrape time.
ARTIST_LIST_SQL = """
SELECT event_id AS ingest_seq,
  concat('Artist ', CAST(user_id AS STRING), CASE WHEN event_id % 5 = 0 THEN ' (live)' ELSE '' END) AS artist,
  CAST(user_id AS STRING) AS id,
  CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN {empty_list} WHEN 2 THEN split('pop;rock', ';') ELSE split(event_type, ';') END AS genres,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE substr(CAST(ts AS STRING), 1, 19) END AS scrape_date
FROM {events}
"""

# Tracks of playlists, flat; queries nest them as the source does.
TRACK_SQL = """
SELECT event_type AS playlist, event_id AS position,
  CASE WHEN event_id % 17 = 0 THEN 'no track' WHEN event_id % 19 = 0 THEN 'no artist' ELSE 'ok' END AS state,
  CAST(user_id AS STRING) AS id,
  concat('Artist ', CAST(user_id AS STRING), CASE WHEN event_id % 5 = 0 THEN ' & Band' ELSE '' END) AS artist
FROM {events}
"""

# Genre cache: an id is absent, has an empty list, or has genres.
GENRE_CACHE_SQL = """
SELECT DISTINCT CAST(user_id AS STRING) AS artist_id,
  CASE WHEN user_id % 3 = 1 THEN {empty_list} ELSE split('pop;rock', ';') END AS genres
FROM {events} WHERE user_id % 3 <> 0
"""

# Clean trend rows of more size and a longer calendar than the raw fixture.
SHIPMENT_TRENDS_SQL = """
SELECT l_orderkey * 10 + l_linenumber AS ingest_seq,
  CAST(l_suppkey AS STRING) AS id,
  CASE l_returnflag WHEN 'A' THEN 'pop' WHEN 'N' THEN 'rock' ELSE 'edm' END AS genres,
  CASE l_linenumber % 4 WHEN 0 THEN 'NV' WHEN 1 THEN 'CA' WHEN 2 THEN 'TX' ELSE 'NY' END AS location,
  CAST(l_shipdate AS DATE) AS date,
  l_quantity * 2.0 AS trend_score
FROM {lineitem}
"""

# Scores per (artist, region, month, day) as kept by a cache of requests.
ORDER_SCORES_SQL = """
SELECT lower(c_name) AS artist_key, concat('US-', {region_of_order}) AS geo,
  {month_of_order} AS month, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day,
  o_orderstatus AS status, CAST(floor(o_totalprice / 10000) AS BIGINT) AS score
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

_SPARK = {
    "empty_list": "CAST(array() AS array<string>)",
    "region_of_order": "element_at(regions(), CAST(o_orderkey % 50 AS INT) + 1)",
    "month_of_order": "date_format(o_orderdate, 'MMM_yyyy')",
}


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """One of the texts above over the provided tables."""
    from trendengine.constants import REGION_CODES

    regions = "array(" + ", ".join(f"'{code}'" for code in REGION_CODES) + ")"
    names = [n for n in ("events", "lineitem", "orders", "customer") if "{" + n + "}" in sql]
    for key, value in _SPARK.items():
        sql = sql.replace("{" + key + "}", value.replace("regions()", regions))
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def nested_tracks(flat: DataFrame) -> DataFrame:
    """Tracks with their artists as a list of structs; some tracks or lists are missing."""
    from pyspark.sql import functions as F

    main = F.struct(F.col("id").alias("id"), F.col("artist").alias("name"))
    guest = F.struct(F.lit("guest").alias("id"), F.lit("Guest").alias("name"))
    artists = F.when(F.col("state") == "no artist", F.slice(F.array(main), 1, 0)).otherwise(
        F.array(main, guest)
    )
    track = F.when(F.col("state") != "no track", F.struct(artists.alias("artists")))
    return flat.select("playlist", "position", track.alias("track"))


def enriched_lines(rows: DataFrame, *kept: str) -> DataFrame:
    """JSON lines in both spellings of the enriched record, from clean rows; columns ``kept`` stay beside them."""
    from pyspark.sql import functions as F

    key = F.concat(F.lit("daily_trends_"), F.col("location"))
    day = F.date_format("date", "yyyy-MM-dd")
    head = [F.col("artist"), F.col("id"), F.split("genres", ";").alias("genres")]
    score = F.col("trend_score")
    nested = F.to_json(
        F.map_from_entries(F.array(F.struct(F.concat(day, F.lit(" 00:00:00")), score)))
    )
    flat = F.concat(F.lit('"'), key, F.lit("_"), day, F.lit('":'), score.cast("string"))
    as_map = F.concat(F.lit('"'), key, F.lit('":'), nested)
    body = F.when(F.col("ingest_seq") % 2 == 0, flat).otherwise(as_map)
    record = F.to_json(F.struct(*head))
    line = F.concat(
        F.regexp_replace(record, r"\}$", ""), F.lit(',"daily_trends_US_only":true,'), body, F.lit("}")
    )
    return rows.select(line.alias("value"), *kept)
