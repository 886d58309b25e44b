"""The registered queries in the SQL of the oracle engine, over the same tables."""

from __future__ import annotations

import re

from trendengine import fixtures as fx
from trendengine.constants import MARKETS, REGION_CODES, STATE_NAMES, WHITESPACE, WORD
from trendengine.plans.queries import BATCH_ENDS, MONTH, RUN_TS
from trendengine.operators.quality import DRIFT_WIDTH, HISTORY, LEAST_HISTORY, LEAST_SPREAD, MAD_TO_SIGMA, NEWEST, THRESHOLDS, WIDTH


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _fixture(sql: str) -> str:
    fill = {
        "empty_list": "CAST([] AS VARCHAR[])",
        "region_of_order": f"list_extract({_list(REGION_CODES)}, CAST(o_orderkey % 50 AS INT) + 1)",
        "month_of_order": "strftime(o_orderdate, '%b_%Y')",
    }
    for name in ("events", "lineitem", "orders", "customer"):
        fill[name] = name
    for key, value in fill.items():
        sql = sql.replace("{" + key + "}", value)
    return sql


_TOKEN = r"""lower(regexp_replace(tok, '^[\s"''\[\]\(\)]+|[\s"''\[\]\(\)]+$', '', 'g'))"""
_BAD_SCORE = "(trend_score IS NULL OR isnan(trend_score) OR trend_score < 0 OR trend_score > 100)"
_CLIP = "CASE WHEN trend_score IS NULL OR isnan(trend_score) THEN CAST(0 AS DOUBLE) ELSE least(100.0::DOUBLE, greatest(0.0::DOUBLE, trend_score)) END"
_FACT = "artist, id, genres, location, date, trend_score"
_STATES = ", ".join(f"('{c}', '{n}')" for c, n in STATE_NAMES.items())


def _first(table: str, keys: str, order: str = "ingest_seq", desc: str = "") -> str:
    return f"SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order} {desc}) = 1"


# Common tables; each may use those above it.
CTES = {
    "raw": _fixture(fx.RAW_SQL),
    "typed": """
        SELECT ingest_seq, trim(artist) AS artist, trim(id) AS id, trim(genres) AS genres,
          upper(trim(location)) AS location, try_cast(trim(replace(date, '_', '-')) AS DATE) AS date,
          try_cast(trend_score AS DOUBLE) AS trend_score FROM raw""",
    "cleaned": f"""
        SELECT artist, id, coalesce(genres, 'Unknown') AS genres, location, date, {_CLIP} AS trend_score, ingest_seq
        FROM typed WHERE id IS NOT NULL AND location IS NOT NULL AND date IS NOT NULL""",
    "listed": r"SELECT *, string_split(regexp_replace(genres, '[|,]', ';', 'g'), ';') AS toks FROM cleaned",
    "tokens": "SELECT *, unnest(toks) AS tok, unnest(range(len(toks))) AS pos FROM listed",
    "exploded": f"""
        SELECT artist, id, {_TOKEN} AS genres, location, date, trend_score, ingest_seq, CAST(pos AS BIGINT) AS genre_pos
        FROM tokens WHERE {_TOKEN} <> ''""",
    "trends": f"SELECT {_FACT} FROM ({_first('exploded', 'id, genres, location, date', 'ingest_seq, genre_pos')})",
    "artist_rows": f"SELECT id, location, date, trend_score FROM ({_first('cleaned', 'id, location, date')})",
    "genre_fact": """
        SELECT genres, location, date, round(avg(trend_score), 6) AS avg_score, max(trend_score) AS max_score,
          count(*) AS n_artists FROM trends GROUP BY ALL""",
    "shipments": _fixture(fx.SHIPMENT_TRENDS_SQL),
    "shipment_days": "SELECT id, location, date, max(trend_score) AS trend_score FROM shipments GROUP BY ALL",
    "artist_list": _fixture(fx.ARTIST_LIST_SQL),
    "artists_last": _first("artist_list", "id", "ingest_seq", "DESC"),
    "tracks": _fixture(fx.TRACK_SQL),
    "firsts": "SELECT playlist, position, artist, id FROM tracks WHERE state = 'ok'",
    "per_playlist": _first("firsts", "playlist, id", "position"),
    "genre_cache": _fixture(fx.GENRE_CACHE_SQL),
    "enriched": """
        SELECT a.id, a.artist, c.artist_id IS NOT NULL AS hit, array_to_string(c.genres, ';') AS genres
        FROM artists_last a LEFT JOIN genre_cache c ON a.id = c.artist_id""",
    "genre_list": _fixture(fx.GENRE_LIST_SQL),
    "order_scores": _fixture(fx.ORDER_SCORES_SQL),
    "last_names": "SELECT id, arg_max(artist, ingest_seq) AS artist_name FROM exploded WHERE artist <> '' GROUP BY id",
    "d_artists": """
        SELECT row_number() OVER (ORDER BY s) AS artist_id, f.id AS spotify_id, coalesce(artist_name, '') AS artist_name
        FROM (SELECT id, min(ingest_seq) AS s FROM exploded GROUP BY id) f LEFT JOIN last_names n ON f.id = n.id""",
    "d_genres": """
        SELECT row_number() OVER (ORDER BY s) AS genre_id, genre FROM
        (SELECT genres AS genre, min((ingest_seq, genre_pos)) AS s FROM exploded GROUP BY genres)""",
    "d_locations": """
        SELECT row_number() OVER (ORDER BY s) AS location_id, location AS state_code FROM
        (SELECT location, min(ingest_seq) AS s FROM exploded GROUP BY location)""",
    "keyed_days": """
        SELECT artist_id, location_id, date, trend_score FROM artist_rows
        JOIN d_artists ON id = spotify_id JOIN d_locations ON location = state_code""",
    "pairs": """
        SELECT DISTINCT artist_id, genre_id FROM exploded
        JOIN d_artists ON id = spotify_id JOIN d_genres ON genres = genre""",
    "weekly": """
        SELECT id, genres, location, CAST(date_trunc('week', date) AS DATE) AS week, avg(trend_score) AS a
        FROM trends GROUP BY ALL""",
    "moving": """
        SELECT id, genres, location, week, round(a, 6) AS avg_score,
          round(CASE WHEN week - lag(week) OVER w = 7 THEN a - lag(a) OVER w END, 6) AS velocity FROM weekly
        WINDOW w AS (PARTITION BY id, genres, location ORDER BY week)""",
    "batch_of": "SELECT event_id, " + "CASE " + " ".join(
        f"WHEN CAST(ts AS DATE) <= DATE '{e}' THEN '{e:%Y_%m_%d}'" for e in BATCH_ENDS[:-1]) + f" ELSE '{BATCH_ENDS[-1]:%Y_%m_%d}' END AS batch_date FROM events",
    "batches": "SELECT raw.*, batch_date FROM raw JOIN batch_of ON ingest_seq = event_id",
    # The hard rows, written out by what each of them must become.
    "hard": """
        SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS id,
          CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN 'TEX' WHEN event_id % 2 = 0 THEN 'NV' ELSE 'CA' END AS location,
          CAST(ts AS DATE) AS date, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 250 ELSE value END::DOUBLE AS score,
          CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 100 ELSE least(100, greatest(0, value)) END::DOUBLE AS trend_score FROM events""",
    "hard_split": """
        SELECT *, unnest(CASE event_id % 6 WHEN 0 THEN ['pop', 'rock'] WHEN 2 THEN ['pop'] WHEN 4 THEN ['pop']
          WHEN 5 THEN ['unknown'] ELSE CAST([] AS VARCHAR[]) END) AS genres FROM hard""",
    "hard_trends": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, genres, location, date ORDER BY event_id) AS n FROM hard_split) WHERE n = 1",
    "hard_good": "SELECT * FROM hard_split WHERE id <> '' AND location <> ''",
    "hard_artists": "SELECT id AS k, row_number() OVER (ORDER BY min(event_id)) AS artist_id FROM hard_good GROUP BY id",
    "hard_genres": "SELECT genres AS k, row_number() OVER (ORDER BY min((event_id, genres))) AS genre_id FROM hard_good GROUP BY genres",
    "hard_places": "SELECT location AS k, row_number() OVER (ORDER BY min(event_id)) AS location_id FROM hard_good GROUP BY location",
    "hard_keyed": """
        SELECT nullif(t.id, '') AS id, t.genres, nullif(t.location, '') AS location, date, trend_score, artist_id, genre_id, location_id
        FROM hard_trends t LEFT JOIN hard_artists a ON a.k = t.id LEFT JOIN hard_genres g ON g.k = t.genres
        LEFT JOIN hard_places p ON p.k = t.location""",
    "score_days": "SELECT artist_key, geo, month, day, status, max(score) AS score FROM order_scores GROUP BY ALL",
}


def _with(body: str) -> str:
    """The body behind the common tables it needs, in order."""
    needed, texts = set(), [body]
    while texts:
        words = set(re.findall(r"\w+", texts.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            texts.append(CTES[name])
    parts = ", ".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH {parts} {body}" if parts else body


_CLEAN_COUNTS = f"""
  count(*) AS rows_in, count(*) FILTER (WHERE date IS NULL) AS bad_dates,
  count(*) FILTER (WHERE {_BAD_SCORE}) AS score_out_of_range,
  count(*) FILTER (WHERE id IS NULL OR location IS NULL OR date IS NULL) AS dropped_missing_id_loc_date,
  count(*) FILTER (WHERE id IS NOT NULL AND location IS NOT NULL AND date IS NOT NULL AND (id = '' OR location = '')) AS blank_keys
"""
_EXPLODE_COUNTS = f"""
  (SELECT count(*) FROM cleaned WHERE genres <> regexp_replace(genres, '[|,]', ';', 'g')) AS genre_delim_replaced,
  (SELECT count(*) FROM exploded) AS rows_after_explode,
  (SELECT count(*) FROM tokens WHERE {_TOKEN} = '') AS dropped_empty_genre,
  (SELECT count(*) FROM listed WHERE len(toks) = 0) AS dropped_empty_list
"""
_SUMMARY = f"SELECT m.*, {_EXPLODE_COUNTS} FROM (SELECT {_CLEAN_COUNTS} FROM typed) m"
_LATEST = "SELECT artist, id, genres, location, date, trend_score{} FROM batches WHERE batch_date = '2024_01_31'"
_NOT_NULL_LIKE = "genre IS NOT NULL AND lower(trim(genre)) NOT IN ('<na>', 'na', 'null', '')"


def _numbered(first: str, rest: str, name: str, key: str, order: str) -> str:
    """Two runs: keys of the first rows, then those of all rows that are new."""
    return f"""
      SELECT '{name}' AS dim, row_number() OVER (ORDER BY late, s) AS number, k AS natural_key FROM (
        SELECT {key} AS k, NOT bool_or({first}) AS late,
          coalesce(min({order}) FILTER (WHERE {first}), min({order})) AS s FROM {rest} GROUP BY {key})"""


_NEAR = "location IN ('NV', 'CA')"
_DEFECTS = {
    "missing_keys": "id IS NULL OR location IS NULL OR date IS NULL",
    "score_out_of_range": _BAD_SCORE,
    "missing_genres": "genres IS NULL OR genres = 'Unknown'",
    "location_not_two_letters": "length(location) <> 2",
    "bad_dates": "date IS NULL",
}
_DQ = " UNION ALL ".join(
    f"""SELECT '{m}' AS metric, n AS n_bad, round(100.0::DOUBLE * n / t, 4) AS bad_percent,
      {limit}::DOUBLE AS threshold, round(100.0::DOUBLE * n / t, 4) <= {limit} AS passed
      FROM (SELECT count(*) AS t, count(*) FILTER (WHERE {_DEFECTS[m]}) AS n FROM typed)"""
    for m, limit in THRESHOLDS.items()
)
_RAW_COLUMNS = "artist, id, genres, location, date, trend_score"
_PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM raw"
    for c in ["ingest_seq", *_RAW_COLUMNS.split(", ")]
)
_DESCRIBE_TEXT = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_unique,
      (SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM typed WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1) AS top,
      max(n) AS freq FROM (SELECT {c} AS v, count(*) AS n FROM typed WHERE {c} IS NOT NULL GROUP BY 1)"""
    for c in ["artist", "id", "genres", "location"]
)
_WS = WHITESPACE
_STRIPPED = f"lower(regexp_replace(text, '^[{_WS}]+|[{_WS}]+$', '', 'g'))"

_BODIES = {
    # sources
    "scan_raw_csv": f"SELECT {_RAW_COLUMNS} FROM raw",
    "latest_batch_by_file": _LATEST.format(", batch_date"),
    "latest_batch_by_dir": "SELECT artist, id, '2024_02_05' AS batch_date FROM artist_list",
    "latest_batch_with_file": _LATEST.format(", batch_date"),
    "batch_date_from_path": "SELECT batch_date, count(*) AS n_rows FROM batches GROUP BY 1",
    "scan_json_array": "SELECT artist, id, scrape_date, array_to_string(genres, ';') AS genres FROM artist_list",
    "scan_hive_json": f"""
        SELECT CAST(user_id AS VARCHAR) AS id, concat('Artist ', user_id) AS name, CAST(floor(value) AS BIGINT) AS popularity,
          event_type AS genre, list_extract({_list(MARKETS)}, CAST(user_id % {len(MARKETS)} AS INT) + 1) AS market FROM events""",
    "scan_dims": """
        SELECT 'dim_artists' AS dim, artist_id AS number, spotify_id AS natural_key FROM d_artists
        UNION ALL SELECT 'dim_genres', genre_id, genre FROM d_genres UNION ALL SELECT 'dim_locations', location_id, state_code FROM d_locations""",
    "latest_batch_by_dir_empty": "SELECT count(*) AS n_events, CAST(NULL AS VARCHAR) AS batch_date FROM events",
    "valid_genres": f"SELECT genre_id, trim(genre) AS genre FROM genre_list WHERE {_NOT_NULL_LIKE}",
    "dim_row_counts": """
        SELECT count(*) AS n_rows, count(nullif(trim(genre), '')) AS n_valid,
          count(*) - count(nullif(trim(genre), '')) AS n_invalid FROM genre_list""",
    "scan_cleaned": "SELECT concat('Artist ', id) AS artist, id, genres, location, date, trend_score, ingest_seq FROM shipments",
    "scan_cleaned_range": """
        SELECT concat('Artist ', id) AS artist, id, genres, location, date, trend_score, ingest_seq FROM shipments
        WHERE date BETWEEN DATE '1995-11-05' AND DATE '1996-02-20'""",
    # sinks
    "write_partitioned": f"SELECT {_FACT}, year(date) AS year, month(date) AS month FROM exploded",
    "write_cleaned_csv": f"SELECT {_FACT} FROM exploded",
    "artists_to_csv": "SELECT artist, id, coalesce(array_to_string(genres, '; '), '') AS genres FROM artist_list",
    "load_staging": f"""
        SELECT coalesce(artist, '') AS artist, id, genres AS genre, location AS state_code, name AS state_name, date, trend_score
        FROM exploded LEFT JOIN (VALUES {_STATES}) st(code, name) ON location = code""",
    "load_copy": f"""
        SELECT coalesce(artist, '') AS artist, id, genres AS genre, location AS state_code, name AS state_name, date, trend_score
        FROM exploded LEFT JOIN (VALUES {_STATES}) st(code, name) ON location = code""",
    "load_latest_batch": f"""
        SELECT coalesce(artist, '') AS artist, id, genres AS genre, location AS state_code, name AS state_name, date, trend_score, batch_date
        FROM exploded JOIN batch_of ON ingest_seq = event_id LEFT JOIN (VALUES {_STATES}) st(code, name) ON location = code
        WHERE batch_date = '{BATCH_ENDS[-1]:%Y_%m_%d}'""",
    "staging_rejects": """
        SELECT CASE WHEN location IN ('', 'TEX') THEN 'state code' ELSE 'none' END AS defect, count(*) AS n FROM hard_split GROUP BY 1""",
    "land_raw_batch": _LATEST.format(""),
    "transform_batch": _SUMMARY,
    # projections
    "standardize_strings": "SELECT ingest_seq, artist, id, genres, location FROM typed",
    "standardize_genre": "SELECT genre_id, lower(nullif(trim(genre), '')) AS genre FROM genre_list",
    "normalize_text": f"SELECT doc_id, regexp_replace({_STRIPPED}, '[^{WORD}{_WS}]', '', 'g') AS text FROM documents",
    "norm_key": f"SELECT conv_id, turn, regexp_replace({_STRIPPED}, '[{_WS}]+', ' ', 'g') AS text FROM conversations",
    "normalize_delims": "SELECT ingest_seq, regexp_replace(genres, '[|,]', ';', 'g') AS genres FROM raw",
    "trend_cache_key": r"""
        SELECT ingest_seq, concat_ws('|', regexp_replace(lower(artist), '\s+', ' ', 'g'), 'US-' || location,
          strftime(date, '%b_%Y')) AS cache_key FROM cleaned""",
    "parse_dates": "SELECT ingest_seq, date FROM typed",
    "add_partition_cols": "SELECT ingest_seq, date, year(date) AS year, month(date) AS month FROM cleaned",
    "last_complete_month": "SELECT * FROM shipments WHERE date BETWEEN DATE '1998-02-01' AND DATE '1998-02-28'",
    "last_14_days": f"SELECT {_FACT} FROM cleaned WHERE date BETWEEN DATE '2024-01-06' AND DATE '2024-01-19'",
    "stamp_missing": f"SELECT ingest_seq, id, coalesce(scrape_date, '{RUN_TS}') AS scrape_date FROM artist_list",
    "parse_scores": "SELECT ingest_seq, trend_score FROM typed",
    "clip_scores": f"SELECT ingest_seq, {_CLIP} AS trend_score FROM typed",
    "fill_unknown": "SELECT ingest_seq, coalesce(genres, 'Unknown') AS genres FROM typed",
    "first_artist": "SELECT playlist, position, artist, id FROM firsts",
    # filters
    "clean_trends": f"SELECT {_FACT}, ingest_seq FROM cleaned",
    "drop_missing_keys": "SELECT ingest_seq, id, location, date FROM cleaned",
    "filter_score_range": f"SELECT ingest_seq, trend_score FROM typed WHERE NOT {_BAD_SCORE}",
    "quarantine_rows": "SELECT ingest_seq, id, location, date FROM typed WHERE id IS NULL OR location IS NULL OR date IS NULL",
    # generators
    "parse_genres": f"SELECT ingest_seq, len(toks) AS n_items, pos, {_TOKEN} AS item FROM tokens",
    "explode_genres": "SELECT * FROM exploded",
    "unpivot_trends": "SELECT artist, id, genres, location, date, trend_score FROM cleaned".replace(
        "genres,", "array_to_string(string_split(genres, ';'), '; ') AS genres,"),
    "unpivot_variant": "SELECT artist, id, array_to_string(string_split(genres, ';'), '; ') AS genres, location, date, trend_score FROM cleaned "
    "WHERE ingest_seq % 50 <> 0 AND ingest_seq % 49 <> 0",
    "unpivot_rejects": """
        SELECT CASE WHEN ingest_seq % 50 = 0 THEN 'cut short' ELSE 'no object' END AS reason, count(*) AS n FROM cleaned
        WHERE ingest_seq % 50 = 0 OR ingest_seq % 49 = 0 GROUP BY ALL""",
    "land_records": """
        SELECT count(*) FILTER (WHERE NOT bad) AS n_rows, count(*) FILTER (WHERE bad) AS n_aside, count(*) FILTER (WHERE bad) AS n_broken
        FROM (SELECT ingest_seq % 50 = 0 OR ingest_seq % 49 = 0 AS bad FROM cleaned)""",
    "land_enriched_batch": f"""
        SELECT artist, id, trim(coalesce(nullif(array_to_string(string_split(genres, ';'), '; '), ''), 'Unknown')) AS genres, location, date, trend_score,
          '2024_02_01' AS batch_date FROM cleaned""",
    "resume_artists": "SELECT c_custkey, c_name AS artist FROM customer WHERE c_custkey % 3 <> 0",
    "artist_locations": "SELECT id, string_agg(DISTINCT location, ',' ORDER BY location) AS locations FROM shipments GROUP BY id",
    # joins
    "join_state_name": f"""
        SELECT ingest_seq, location, name AS state_name FROM cleaned
        LEFT JOIN (VALUES {_STATES}) st(code, name) ON location = code""",
    "enrich_genres": "SELECT id, artist, hit, genres FROM enriched",
    "genre_cache_stats": "SELECT count(*) FILTER (WHERE hit) AS cache_hits, count(*) FILTER (WHERE NOT hit) AS cache_misses FROM enriched",
    "unprocessed_artists": """
        SELECT c_custkey, c_name AS artist FROM customer WHERE lower(c_name) NOT IN (
          SELECT lower(c_name) FROM customer JOIN orders ON o_custkey = c_custkey
          WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')""",
    "unprocessed_artists_filtered": """
        SELECT c_custkey, c_name AS artist FROM customer WHERE lower(c_name) NOT IN (
          SELECT lower(c_name) FROM customer JOIN orders ON o_custkey = c_custkey
          WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')""",
    "pending_requests": f"""
        SELECT k AS artist_key, 'US-' || r AS geo, '{MONTH}' AS month
        FROM (SELECT DISTINCT lower(c_name) AS k FROM customer), (SELECT unnest({_list(REGION_CODES)}) AS r)
        WHERE NOT EXISTS (SELECT 1 FROM order_scores o WHERE o.artist_key = k AND o.geo = 'US-' || r AND o.month = '{MONTH}')""",
    "pending_requests_filtered": f"""
        SELECT k AS artist_key, 'US-' || r AS geo, '{MONTH}' AS month
        FROM (SELECT DISTINCT lower(c_name) AS k FROM customer), (SELECT unnest({_list(REGION_CODES)}) AS r)
        WHERE NOT EXISTS (SELECT 1 FROM order_scores o WHERE o.artist_key = k AND o.geo = 'US-' || r AND o.month = '{MONTH}')""",
    "genre_market_grid": f"SELECT genre, unnest({_list(MARKETS)}) AS market FROM d_genres",
    "national_gate": """
        SELECT * FROM artist_rows WHERE id IN (SELECT CAST(user_id AS VARCHAR) FROM events
          WHERE event_type = 'view' GROUP BY user_id HAVING max(value) >= 50)""",
    "merge_cached_scores": """
        WITH_ hits AS (SELECT DISTINCT artist_key, geo, month FROM order_scores WHERE status = 'F'),
        every AS (SELECT artist_key, geo, month, day, max(score) AS score FROM order_scores GROUP BY ALL)
        SELECT artist_key, geo, month, 'cache' AS source, day, score FROM score_days WHERE status = 'F'
        UNION ALL SELECT artist_key, geo, month, 'fetch', day, score FROM every ANTI JOIN hits USING (artist_key, geo, month)""",
    "cache_upsert": """
        WITH_ renewed AS (SELECT DISTINCT artist_key, geo, month FROM order_scores WHERE status = 'O')
        SELECT artist_key, geo, month, day, score FROM score_days WHERE status = 'O'
        UNION ALL SELECT artist_key, geo, month, day, score FROM score_days
        ANTI JOIN renewed USING (artist_key, geo, month) WHERE status = 'F'""",
    "cache_upsert_buckets": """
        WITH_ renewed AS (SELECT DISTINCT artist_key, geo, month FROM order_scores WHERE status = 'O')
        SELECT artist_key, geo, month, day, score FROM score_days WHERE status = 'O'
        UNION ALL SELECT artist_key, geo, month, day, score FROM score_days
        ANTI JOIN renewed USING (artist_key, geo, month) WHERE status = 'F'""",
    "fact_with_keys": """
        SELECT artist_id, genre_id, location_id, date, trend_score FROM trends JOIN d_artists ON id = spotify_id
        JOIN d_genres ON genres = genre JOIN d_locations ON location = state_code""",
    "fact_with_keys_hard": """
        SELECT artist_id, genre_id, location_id, date, trend_score FROM hard_keyed
        WHERE artist_id IS NOT NULL AND genre_id IS NOT NULL AND location_id IS NOT NULL""",
    "fact_rejects": """
        SELECT id, genres, location, date, trend_score FROM hard_keyed
        WHERE artist_id IS NULL OR genre_id IS NULL OR location_id IS NULL""",
    "fact_key_counts": """
        SELECT count(*) AS n_rows, count(*) FILTER (artist_id + genre_id + location_id IS NOT NULL) AS n_keyed,
          count(*) FILTER (artist_id + genre_id + location_id IS NULL) AS n_rejected, count(*) FILTER (artist_id IS NULL) AS without_artist_id,
          count(*) FILTER (genre_id IS NULL) AS without_genre_id, count(*) FILTER (location_id IS NULL) AS without_location_id FROM hard_keyed""",
    "fact_artist_trends": "SELECT * FROM keyed_days",
    "fact_artist_buckets": "SELECT artist_id, location, date, trend_score FROM artist_rows JOIN d_artists ON id = spotify_id",
    "artist_genres": "SELECT * FROM pairs",
    "exploded_view": "SELECT artist_id, genre_id, location_id, date, trend_score FROM keyed_days JOIN pairs USING (artist_id)",
    # aggregates and profiles
    "clean_metrics": f"SELECT {_CLEAN_COUNTS} FROM typed",
    "explode_metrics": f"SELECT {_EXPLODE_COUNTS}",
    "run_summary": _SUMMARY,
    "run_summary_hard": """
        SELECT count(*) AS rows_in, 0::BIGINT AS bad_dates, count(*) FILTER (score IS NULL OR score > 100 OR score < 0) AS score_out_of_range,
          0::BIGINT AS dropped_missing_id_loc_date, count(*) FILTER (id = '' OR location = '') AS blank_keys,
          count(*) FILTER (event_id % 6 IN (0, 4)) AS genre_delim_replaced, count(*) FILTER (event_id % 6 IN (0, 2, 4, 5)) AS rows_after_explode,
          count(*) FILTER (event_id % 6 IN (3, 4)) AS dropped_empty_genre, count(*) FILTER (event_id % 6 = 1) AS dropped_empty_list FROM hard""",
    "describe_scores_nan": """
        SELECT count(score) AS n_rows, count(DISTINCT score) AS n_distinct, round(avg(score), 6) AS mean,
          round(stddev_samp(score), 6) AS std, min(score) AS min, round(quantile_cont(score, 0.25), 6) AS p25,
          round(quantile_cont(score, 0.5), 6) AS p50, round(quantile_cont(score, 0.75), 6) AS p75, max(score) AS max,
          (SELECT score FROM hard WHERE score IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode FROM hard""",
    "score_histogram_nan": """
        WITH_ b AS (SELECT min(score) AS lo, max(score) - min(score) AS w FROM hard),
        c AS (SELECT CAST(least(floor((score - lo) / w * 20), 19) AS BIGINT) AS bin, count(*) AS n FROM hard, b WHERE score IS NOT NULL GROUP BY 1)
        SELECT bin, round(lo + bin * w / 20, 6) AS lower, round(lo + (bin + 1) * w / 20, 6) AS upper, coalesce(n, 0) AS n
        FROM (SELECT unnest(range(20)) AS bin) LEFT JOIN c USING (bin), b""",
    "null_profile": _PROFILE,
    "describe_scores": """
        SELECT count(trend_score) AS n_rows, count(DISTINCT trend_score) AS n_distinct, round(avg(trend_score), 6) AS mean,
          round(stddev_samp(trend_score), 6) AS std, min(trend_score) AS min, round(quantile_cont(trend_score, 0.25), 6) AS p25,
          round(quantile_cont(trend_score, 0.5), 6) AS p50, round(quantile_cont(trend_score, 0.75), 6) AS p75, max(trend_score) AS max,
          (SELECT trend_score FROM typed WHERE trend_score IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode FROM typed""",
    "describe_text": _DESCRIBE_TEXT,
    "score_histogram": """
        WITH_ b AS (SELECT min(trend_score) AS lo, max(trend_score) - min(trend_score) AS w FROM typed),
        c AS (SELECT CAST(least(floor((trend_score - lo) / w * 20), 19) AS BIGINT) AS bin, count(*) AS n
          FROM typed, b WHERE trend_score IS NOT NULL GROUP BY 1)
        SELECT bin, round(lo + bin * w / 20, 6) AS lower, round(lo + (bin + 1) * w / 20, 6) AS upper, coalesce(n, 0) AS n
        FROM (SELECT unnest(range(20)) AS bin) LEFT JOIN c USING (bin), b""",
    "location_counts": "SELECT location, count(*) AS n FROM typed GROUP BY 1",
    "id_length_counts": "SELECT length(id) AS id_length, count(*) AS n FROM typed GROUP BY 1",
    "genre_presence": """
        SELECT count(genres) AS with_genres, count(*) - count(genres) AS without_genres,
          round(100.0::DOUBLE * (count(*) - count(genres)) / count(*), 2) AS missing_percent FROM typed""",
    "unknown_share": """
        SELECT count(*) FILTER (WHERE genres = 'unknown') AS unknown_rows, count(*) AS total_rows,
          round(100.0::DOUBLE * count(*) FILTER (WHERE genres = 'unknown') / count(*), 2) AS unknown_percent FROM exploded""",
    "fact_genre_trends": "SELECT * FROM genre_fact",
    "regional_genre_share": """
        SELECT location, genres, round(sum(trend_score), 6) AS score,
          round(sum(trend_score) / sum(sum(trend_score)) OVER (PARTITION BY location), 6) AS share
        FROM trends GROUP BY location, genres""",
    "trend_rollups": """
        SELECT genres, location, count(*) AS n_rows, round(avg(trend_score), 6) AS avg_score, max(trend_score) AS max_score,
          CAST(GROUPING_ID(genres, location) AS BIGINT) AS level FROM trends
        GROUP BY GROUPING SETS ((genres, location), (genres), (location), ())""",
    "trend_rollups_incremental": """
        SELECT genres, location, count(*) AS n_rows, round(avg(trend_score), 6) AS avg_score, max(trend_score) AS max_score,
          CAST(GROUPING_ID(genres, location) AS BIGINT) AS level FROM trends
        GROUP BY GROUPING SETS ((genres, location), (genres), (location), ())""",
    "fact_genre_incremental": "SELECT * FROM genre_fact",
    "sketch_profile": """
        SELECT metric, (SELECT count(*) FROM exploded) AS n_rows, true AS "within"
        FROM (VALUES ('p25'), ('p50'), ('p75'), ('n_distinct'), ('n_keys')) AS t(metric)""",
    "dedup_artists_last": f"""
        SELECT artist, id, coalesce(array_to_string(genres, ';'), '') AS genres, '{RUN_TS}' AS scrape_date FROM artists_last""",
    "dedup_trends": "SELECT * FROM trends",
    "dedup_stats": """
        SELECT b AS rows_before, a AS rows_after, b - a AS removed, round(100.0::DOUBLE * (b - a) / b, 2) AS removed_percent
        FROM (SELECT (SELECT count(*) FROM exploded) AS b, (SELECT count(*) FROM trends) AS a)""",
    "playlist_artists": "SELECT playlist, position, artist, id FROM per_playlist",
    "union_playlists": f"SELECT playlist, position, artist, id FROM ({_first('per_playlist', 'id', 'position', 'DESC')})",
    # dimensions
    "dim_artists": "SELECT * FROM d_artists",
    "dim_genres": "SELECT * FROM d_genres",
    "dim_locations": "SELECT * FROM d_locations",
    "dims_incremental": " UNION ALL ".join([
        _numbered(_NEAR, "exploded", "dim_artists", "id", "(ingest_seq, genre_pos)"),
        _numbered(_NEAR, "exploded", "dim_genres", "genres", "(ingest_seq, genre_pos)"),
        _numbered(_NEAR, "exploded", "dim_locations", "location", "(ingest_seq, genre_pos)"),
    ]),
    "dims_concurrent": " UNION ALL ".join([
        _numbered(_NEAR, "exploded", "dim_artists", "id", "(ingest_seq, genre_pos)"),
        _numbered(_NEAR, "exploded", "dim_genres", "genres", "(ingest_seq, genre_pos)"),
        _numbered(_NEAR, "exploded", "dim_locations", "location", "(ingest_seq, genre_pos)"),
    ]),
    # windows, calendar, top-k
    "velocity": "SELECT * FROM moving",
    "rising_artists": """
        SELECT *, row_number() OVER (PARTITION BY genres, location, week ORDER BY velocity DESC, id) AS rank
        FROM moving WHERE velocity IS NOT NULL QUALIFY rank <= 3""",
    "trajectory_7d": """
        SELECT *, round(avg(trend_score) OVER w, 6) AS moving_avg, count(*) OVER w AS n_days FROM shipment_days
        WINDOW w AS (PARTITION BY id, location ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
    "genre_direction": """
        SELECT *, CAST(sign(change) AS BIGINT) AS direction FROM (SELECT genres, location, date, avg_score,
          round(avg_score - lag(avg_score) OVER (PARTITION BY genres, location ORDER BY date), 6) AS change FROM genre_fact)""",
    "top_artists": """
        SELECT *, row_number() OVER (PARTITION BY genres, location ORDER BY avg_score DESC, peak DESC, id) AS rank FROM (
          SELECT genres, location, id, round(avg(trend_score), 6) AS avg_score, max(trend_score) AS peak FROM trends GROUP BY ALL)
        QUALIFY rank <= 3""",
    "trending_in_region": """
        SELECT id, max(trend_score) AS peak, count(*) AS n_days FROM artist_rows WHERE location = 'NV'
        GROUP BY id ORDER BY peak DESC, id LIMIT 10""",
    "fill_calendar": """
        WITH_ spans AS (SELECT id, location, min(date) AS lo, max(date) AS hi FROM artist_rows GROUP BY ALL),
        days AS (SELECT id, location, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM spans)
        SELECT id, location, date, coalesce(trend_score, 0::DOUBLE) AS trend_score, trend_score IS NULL AS filled
        FROM days LEFT JOIN artist_rows USING (id, location, date)""",
    # quality
    "assert_single_genre": """
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE contains(genres, ';')) AS violations,
          count(*) FILTER (WHERE contains(genres, ';')) = 0 AS passed FROM exploded""",
    "key_shape_check": """
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT regexp_matches(location, '^[A-Z]{2}$')) AS bad_locations,
          min(length(id)) AS min_id_length, max(length(id)) AS max_id_length, count(DISTINCT length(id)) AS n_id_lengths FROM cleaned""",
    "dq_report": _DQ,
    "control_limits": f"""
        WITH_ days AS (SELECT event_id, CAST(ts AS DATE) AS day FROM events),
        planted AS (
          SELECT typed.* REPLACE (CASE WHEN day >= DATE '2024-01-28' AND ingest_seq % 2 = 0 THEN NULL ELSE location END AS location), day
          FROM typed JOIN days ON event_id = ingest_seq),
        shares AS (
          SELECT CAST(day AS VARCHAR) AS batch, unnest(['missing_keys', 'score_out_of_range', 'missing_genres', 'location_not_two_letters', 'bad_dates']) AS metric,
            unnest([count(*) FILTER (WHERE id IS NULL OR location IS NULL OR date IS NULL), count(*) FILTER (WHERE {_BAD_SCORE}),
              count(*) FILTER (WHERE genres IS NULL OR genres = 'Unknown'), count(*) FILTER (WHERE length(location) <> 2), count(*) FILTER (WHERE date IS NULL)])
              * 100.0::DOUBLE / count(*) AS value
          FROM planted GROUP BY day),
        past AS (SELECT *, coalesce(list(value) OVER (PARTITION BY metric ORDER BY batch ROWS BETWEEN {HISTORY} PRECEDING AND 1 PRECEDING), []) AS p FROM shares),
        mid AS (SELECT *, list_aggregate(p, 'median') AS c FROM past),
        wide AS (SELECT *, greatest({MAD_TO_SIGMA}::DOUBLE * list_aggregate(list_transform(p, lambda v: abs(v - c)), 'median'), {LEAST_SPREAD}::DOUBLE) AS w FROM mid),
        smooth AS (SELECT *, list_reduce(list_concat([c], p, [value]), lambda a, v: {1 - NEWEST}::DOUBLE * a + {NEWEST}::DOUBLE * v) AS e FROM wide)
        SELECT batch, metric, round(value, 6) AS value, len(p)::BIGINT AS n_before, round(c, 6) AS center, round(w, 6) AS spread,
          coalesce(len(p) >= {LEAST_HISTORY} AND abs(value - c) > {WIDTH}::DOUBLE * w, false) AS outside,
          coalesce(len(p) >= {LEAST_HISTORY} AND abs(e - c) > {DRIFT_WIDTH}::DOUBLE * sqrt({NEWEST}::DOUBLE / (2 - {NEWEST}::DOUBLE)) * w, false) AS drifting FROM smooth""",
    # streams
    "stream_clean": f"SELECT {_FACT} FROM exploded",
    "stream_counts": _SUMMARY,
    "stream_dedup": "SELECT * FROM trends",
    "stream_dedup_late": f"SELECT {_FACT} FROM ({_first('exploded', 'id, genres, location, date', 'ingest_seq % 3 = 0, ingest_seq, genre_pos')})",
}


def _finish(body: str) -> str:
    """``WITH_`` marks a body with tables of its own; they go behind the common ones."""
    if "WITH_" not in body:
        return _with(body)
    head = _with(body.replace("WITH_", "", 1))
    own = body.replace("WITH_", "", 1)
    common = head[: len(head) - len(own)].rstrip()
    return f"{common}, {own.lstrip()}"


ORACLE = {name: _finish(body) for name, body in _BODIES.items()}
