import datetime as dt

import pytest

from trendengine.operators import dims
from trendengine.plans import batch
from trendengine.sources.readers import read_dim

DAY = dt.date(2025, 1, 1)
COLUMNS = (
    "artist string, id string, genres string, location string, date date, trend_score double, "
    "ingest_seq long, genre_pos int"
)


def _rows(spark, *rows):
    return spark.createDataFrame(
        [(a, i, g, loc, DAY, 1.0, seq, pos) for a, i, g, loc, seq, pos in rows], COLUMNS
    ).repartition(3)


def _stored(spark, root, fmt):
    out = {}
    for dim in dims.DIMENSIONS:
        rows = read_dim(spark, f"{root}/{dim.name}", dim.schema, fmt).collect()
        out[dim.name] = sorted(tuple(r) for r in rows)
        assert len({r[0] for r in rows}) == len(rows) == len({r[1] for r in rows})
    return out


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_incremental_runs(spark, tmp_path, fmt):
    first = _rows(
        spark,
        ("Old Name", "b", "rock", "NV", 20, 0),
        ("Ann", "a", "pop", "CA", 10, 0),
        ("", "a", "jazz", "CA", 11, 1),
        (None, "a", "rock", "CA", 11, 0),
        ("Nobody", None, "ghost", "CA", 1, 0),
        ("Nowhere", "z", "ghost", " ", 1, 0),
    )
    batch.refresh_dims(spark, first, str(tmp_path), fmt)
    once = _stored(spark, tmp_path, fmt)
    assert once == {
        "dim_artists": [(1, "a", "Ann"), (2, "b", "Old Name")],
        "dim_genres": [(1, "pop"), (2, "rock"), (3, "jazz")],
        "dim_locations": [(1, "CA"), (2, "NV")],
    }
    second = _rows(
        spark,
        ("New Name", "b", "dub", "NV", 1, 0),
        ("Cy", "c", "Pop;folk", "tx", 2, 0),
        ("Cy!", "c", "folk", "TX", 3, 0),
    )
    batch.refresh_dims(spark, second, str(tmp_path), fmt)
    twice = _stored(spark, tmp_path, fmt)
    assert twice == {
        "dim_artists": once["dim_artists"] + [(3, "c", "Cy!")],
        "dim_genres": once["dim_genres"] + [(4, "dub"), (5, "folk")],
        "dim_locations": once["dim_locations"] + [(3, "TX")],
    }
    batch.refresh_dims(spark, second, str(tmp_path), fmt)
    assert _stored(spark, tmp_path, fmt) == twice


def test_artist_without_any_name_gets_an_empty_one(spark):
    rows = dims.ARTISTS.new_rows(_rows(spark, (None, "a", "pop", "CA", 1, 0))).collect()
    assert [tuple(r) for r in rows] == [(1, "a", "")]


def test_genre_named_twice_in_a_row_counts_where_it_comes_first(spark):
    rows = _rows(spark, ("A", "a", "pop; rock; pop", "CA", 1, 0))
    found = dims.GENRES.new_rows(rows).orderBy("genre_id").collect()
    assert [r["genre"] for r in found] == ["pop", "rock"]


def test_invalid_stored_rows_are_ignored(spark):
    stored = spark.createDataFrame([(7, " Pop "), (None, "rock"), (9, None), (3, "")], "genre_id long, genre string")
    assert tuple(dims.GENRES.row_counts(stored).head()) == (4, 1, 3)
    rows = _rows(spark, ("A", "a", "pop", "CA", 1, 0), ("A", "a", "rock", "CA", 2, 0))
    found = dims.GENRES.new_rows(rows, stored).collect()
    assert [tuple(r) for r in found] == [(8, "rock")]


def test_facts_do_not_multiply_scores(spark):
    rows = _rows(spark, ("A", "a", "pop", "CA", 1, 0), ("A", "a", "rock", "CA", 1, 1))
    artists, genres, places = (d.new_rows(rows, pos="genre_pos") for d in dims.DIMENSIONS)
    from trendengine.operators.analytics import artist_fact_rows

    fact = dims.fact_artist_trends(artist_fact_rows(rows), artists, places)
    assert [tuple(r) for r in fact.collect()] == [(1, 1, DAY, 1.0)]
    view = dims.exploded_view(fact, dims.artist_genres(rows, artists, genres))
    assert sorted(tuple(r) for r in view.collect()) == [(1, 1, 1, DAY, 1.0), (1, 2, 1, DAY, 1.0)]
    keyed = dims.fact_with_keys(rows, artists, genres, places)
    assert keyed.count() == 2


def test_no_row_is_lost_in_keyed_tables(spark):
    """Several genres in one token, blank keys and keys not on record: rows plus rejects are all rows."""
    rows = _rows(
        spark,
        ("A", "a", "pop", "CA", 1, 0), ("A", " a ", "Pop;Rock ", "ca", 2, 0), ("A", "  ", "pop", "CA", 3, 0), ("A", "a", "pop", " ", 4, 0),
        ("A", None, "pop", "CA", 5, 0), ("A", "a", ";", "CA", 6, 0), ("A", "a", None, "CA", 7, 0),
    )
    tables = [d.new_rows(rows.where("ingest_seq < 3"), pos="genre_pos") for d in dims.DIMENSIONS]
    keyed = dims.keyed_rows(rows, *tables)
    counts = dims.key_counts(keyed).head().asDict()
    assert (counts["n_rows"], counts["n_keyed"], counts["n_rejected"]) == (8, 3, 5)
    assert (counts["without_artist_id"], counts["without_genre_id"], counts["without_location_id"]) == (2, 2, 1)
    assert dims.fact_with_keys(rows, *tables).count() == 3 and dims.rejected(keyed).count() == 5
    artist_rows = rows.select("id", "location", "date", "trend_score")
    kept = dims.fact_artist_trends(artist_rows, tables[0], tables[2]).count()
    assert (kept, dims.rejected(dims.keyed_artist_rows(artist_rows, tables[0], tables[2])).count()) == (4, 3)
    assert sorted(tuple(r) for r in dims.artist_genres(rows, tables[0], tables[1]).collect()) == [(1, 1), (1, 2)]


def test_artist_without_genre_stays_in_the_view(spark):
    fact = spark.createDataFrame([(1, 1, DAY, 1.0), (2, 1, DAY, 2.0)], "artist_id long, location_id long, date date, trend_score double")
    pairs = spark.createDataFrame([(1, 5)], "artist_id long, genre_id long")
    assert sorted((r.artist_id, r.genre_id) for r in dims.exploded_view(fact, pairs).collect()) == [(1, 5), (2, None)]


def test_genre_order_with_far_places(spark):
    far = 2**31 - 1
    rows = _rows(spark, ("A", "a", "late", "CA", 5, far), ("A", "a", "later;last", "CA", 6, 0), ("A", "a", "first", "CA", 2**62, 3), ("A", "a", "zero", "CA", 1, far))
    found = dims.GENRES.new_rows(rows, pos="genre_pos").orderBy("genre_id").collect()
    assert [r["genre"] for r in found] == ["zero", "late", "later", "last", "first"]
