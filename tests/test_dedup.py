import datetime as dt

from trendengine.operators import dedup as D

DAY = dt.date(2025, 1, 1)
COLUMNS = "artist string, id string, genres string, location string, date date, trend_score double, ingest_seq long"


def test_first_row_of_the_grain_wins(spark):
    df = spark.createDataFrame(
        [
            ("late", "1", "pop", "NV", DAY, 2.0, 9),
            (None, "1", "pop", "NV", DAY, 1.0, 3),
            ("other", "1", "rock", "NV", DAY, 3.0, 1),
        ],
        COLUMNS,
    ).repartition(3)
    rows = {tuple(r) for r in D.dedup_trends(df).collect()}
    assert rows == {
        (None, "1", "pop", "NV", DAY, 1.0, 3),
        ("other", "1", "rock", "NV", DAY, 3.0, 1),
    }
    stats = D.dedup_stats(df).head().asDict()
    assert stats == {"rows_before": 3, "rows_after": 2, "removed": 1, "removed_percent": 33.33}


def test_unread_columns_leave_the_plan(spark):
    df = spark.createDataFrame([("a", "1", "pop", "NV", DAY, 2.0, 9)], COLUMNS)
    plan = D.dedup_trends(df).select("id", "trend_score")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "min_by(artist" not in plan


def test_stats_of_nothing(spark):
    stats = D.dedup_stats(spark.createDataFrame([], COLUMNS)).head()
    assert stats["rows_before"] == 0 and stats["removed_percent"] is None


def test_last_artist_record_wins(spark):
    df = spark.createDataFrame(
        [("Mira", "a1", ["x"], 1), ("Mira Sol", "a1", None, 5), ("Otto", "b2", ["y", "z"], 2)],
        "artist string, id string, genres array<string>, ingest_seq long",
    )
    rows = {r["id"]: r for r in D.dedup_artists(df, "2025-01-01 10:00:00").collect()}
    assert len(rows) == 2
    assert rows["a1"]["artist"] == "Mira Sol" and rows["a1"]["genres"] == []
    assert rows["b2"]["genres"] == ["y", "z"]
    assert all(r["scrape_date"] == "2025-01-01 10:00:00" for r in rows.values())


def test_artists_without_a_genre_column(spark):
    df = spark.createDataFrame([("Mira", "a1", 1)], "artist string, id string, ingest_seq long")
    assert D.dedup_artists(df, "t").head()["genres"] == []
