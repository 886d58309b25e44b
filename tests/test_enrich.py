import pytest

from trendengine.constants import MARKETS, REGION_CODES, STATE_NAMES
from trendengine.operators import enrich as E


def test_fixed_tables():
    assert len(STATE_NAMES) == 51 and len(REGION_CODES) == 50 and "DC" not in REGION_CODES
    assert len(MARKETS) == 9 and len(set(MARKETS)) == 9


def test_state_names(spark):
    df = spark.createDataFrame([("NV",), ("DC",), ("XX",), (None,)], "state_code string")
    found = {r["state_code"]: r["state_name"] for r in E.join_state_name(df).collect()}
    assert found == {"NV": "Nevada", "DC": "District of Columbia", "XX": None, None: None}


TRACKS = "playlist string, position long, track struct<artists: array<struct<id: string, name: string>>>"


def _track(playlist, position, *artists):
    return (playlist, position, ([{"id": i, "name": n} for i, n in artists],))


def test_playlists(spark):
    one = spark.createDataFrame(
        [
            _track("one", 1, ("a", "Ann"), ("x", "Guest")),
            _track("one", 2, ("a", "Ann again")),
            ("one", 3, None),
            _track("one", 4),
            ("one", 5, (None,)),
            _track("one", 6, (None, "No id")),
        ],
        TRACKS,
    )
    two = spark.createDataFrame([_track("two", 1, ("a", "Ann B.")), _track("two", 2, ("b", "Bo"))], TRACKS)
    lists = [E.playlist_artists(one), E.playlist_artists(two)]
    assert [tuple(r) for r in lists[0].collect()] == [("one", 1, "Ann", "a")]
    assert E.union_playlists(lists).count() == 3


def test_genre_cache(spark):
    artists = spark.createDataFrame([("1",), ("2",), ("3",)], "id string")
    cache = spark.createDataFrame([("1", ["pop"]), ("2", [])], "artist_id string, genres array<string>")
    rows = E.enrich_genres(artists, cache)
    assert {r["id"]: (r["genres"], r["hit"]) for r in rows.collect()} == {
        "1": (["pop"], True), "2": ([], True), "3": (None, False),
    }
    assert tuple(E.genre_cache_stats(rows).head()) == (2, 1)


def test_unprocessed_artists(spark):
    artists = spark.createDataFrame([("Ann",), (" BO ",), ("Cy",), ("  ",), (None,)], "artist string")
    done = spark.createDataFrame([("ann ",), ("",), (None,)], "artist string")
    assert sorted(r[0] for r in E.unprocessed_artists(artists, done).collect()) == [" BO ", "Cy"]


def test_pending_requests(spark):
    artists = spark.createDataFrame([("Ann  Lee",), ("ann lee",), ("Bo",), ("",)], "artist string")
    known = [("ann lee", f"US-{c}", "Jul_2025") for c in REGION_CODES if c != "NV"]
    known += [("ann lee", "US-NV", "Jun_2025"), ("bo", "US", "Jul_2025")]
    cache = spark.createDataFrame(known, "artist_key string, geo string, month string")
    rows = [tuple(r) for r in E.pending_requests(artists, cache, "Jul_2025").collect()]
    assert [r for r in rows if r[0] == "ann lee"] == [("ann lee", "US-NV", "Jul_2025")]
    assert sorted(r[1] for r in rows if r[0] == "bo") == sorted(f"US-{c}" for c in REGION_CODES)
    assert len(rows) == 51


def test_national_gate(spark):
    scores = "id string, trend_score double"
    national = spark.createDataFrame([("a", 49.0), ("b", 50.0), ("b", 1.0), ("c", None)], scores)
    regional = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 2.0), ("c", 3.0), ("d", 4.0)], scores)
    assert [tuple(r) for r in E.national_gate(regional, national).collect()] == [("b", 2.0), ("b", 2.0)]


def test_cached_scores(spark):
    columns = "artist_key string, geo string, month string, scores map<string,int>"
    keys = ["artist_key", "geo", "month"]
    cached = spark.createDataFrame([("a", "US-NV", "m", {"1": 5})], columns)
    fresh = spark.createDataFrame([("a", "US-NV", "m", {"1": 9}), ("a", "US-CA", "m", {"2": 3})], columns)
    merged = {(r["geo"], r["source"], tuple(r["scores"].items())) for r in E.merge_cached_scores(cached, fresh, keys).collect()}
    assert merged == {("US-NV", "cache", (("1", 5),)), ("US-CA", "fetch", (("2", 3),))}
    renewed = {(r["geo"], tuple(r["scores"].items())) for r in E.cache_upsert(cached, fresh, keys).collect()}
    assert renewed == {("US-NV", (("1", 9),)), ("US-CA", (("2", 3),))}


def test_stamp(spark):
    df = spark.createDataFrame([("a", "old"), ("b", None)], "id string, scrape_date string")
    assert {r["id"]: r["scrape_date"] for r in E.stamp_missing(df, "now").collect()} == {"a": "old", "b": "now"}
    assert E.stamp_missing(df.drop("scrape_date"), "now").head()["scrape_date"] == "now"


def test_valid_genres(spark):
    df = spark.createDataFrame(
        [(1, " House "), (2, "<NA>"), (3, "Null"), (4, " na"), (5, " "), (6, None), (7, "nap")], "genre_id long, genre string"
    )
    assert sorted(r["genre"] for r in E.valid_genres(df).collect()) == ["House", "nap"]
    with pytest.raises(ValueError):
        E.valid_genres(df.drop("genre_id"))


def test_staging_rows(clean_frame):
    import datetime as dt

    day = dt.date(2025, 1, 1)
    df = clean_frame(
        ("A", "1", "Pop|Rock; ", "nv ", day, 5.0),
        ("B", "2", "jazz", "XX", day, None),
        ("C", None, "jazz", "NV", day, 1.0),
        ("D", "4", "jazz", "NV", None, 1.0),
    )
    rows = E.staging_rows(df)
    assert rows.columns[-1] == "load_timestamp"
    assert sorted(tuple(r)[:-1] for r in rows.collect()) == [
        ("A", "1", "pop", "NV", "Nevada", day, 5.0),
        ("A", "1", "rock", "NV", "Nevada", day, 5.0),
        ("B", "2", "jazz", "XX", None, day, None),
    ]


def test_several_genres_fail_the_load(spark):
    from pyspark.errors import PySparkException

    from trendengine.operators.quality import assert_single_genre

    good = spark.createDataFrame([("pop",), (None,)], "genre string")
    assert assert_single_genre(good).count() == 2
    with pytest.raises(PySparkException):
        assert_single_genre(spark.createDataFrame([("pop;rock",)], "genre string")).collect()


def test_an_upsert_replaces_only_the_buckets_it_touches(spark, tmp_path):
    from trendengine.operators import enrich

    root = str(tmp_path)
    rows = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "k long, v string")
    names = lambda: {str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.parquet")}
    assert enrich.upsert_buckets(spark, root, rows(range(200), "a"), ["k"], 16) == list(range(16))
    before = names()
    touched = enrich.upsert_buckets(spark, root, rows([3, 1000], "b"), ["k"], 16)
    assert 1 <= len(touched) <= 2
    kept = {n for n in before if int(n.split("bucket=")[1].split("/")[0]) not in touched}
    assert kept and kept <= names() and not (before - kept) & names()
    wanted = {**dict.fromkeys(range(200), "a"), 3: "b", 1000: "b"}
    assert {r.k: r.v for r in enrich.read_buckets(spark, root).collect()} == wanted
    assert enrich.upsert_buckets(spark, root, rows([], "c"), ["k"], 16) == [] and enrich.read_buckets(spark, root).count() == 201
