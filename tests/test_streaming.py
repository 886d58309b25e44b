import os

import pytest

from trendengine.operators.clean import clean
from trendengine.operators.explode import explode_genres
from trendengine.schemas import CLEAN_SCHEMA
from trendengine.sinks import writers as W
from trendengine.streaming import stream as ST

COLUMNS = CLEAN_SCHEMA.fieldNames()


def _write(raw, root, day):
    W.write_csv(raw, W.raw_path(root, day))


def _take_in(spark, root, out):
    raw = ST.read_raw_stream(spark, f"{root}/*/*.csv", files_per_trigger=1)
    ST.append_parquet(ST.clean_stream(raw), f"{out}/table", f"{out}/state")
    return sorted((tuple(r) for r in spark.read.parquet(f"{out}/table").select(*COLUMNS).collect()), key=str)


def test_stream_equals_batch_and_takes_each_file_once(spark, tmp_path, raw_frame):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    first = raw_frame(
        ("A", "1", "pop|rock", "nv", "2025_01_01", "120"), ("B", None, "pop", "nv", "2025-01-01", "1")
    )
    second = raw_frame(("C", "3", "['dub']", "ca", "2025-02-01", None))
    batch = lambda df: [tuple(r) for r in explode_genres(clean(df)).select(*COLUMNS).collect()]
    _write(first, root, "2025_01_01")
    assert _take_in(spark, root, out) == sorted(batch(first), key=str)
    _write(second, root, "2025_02_01")
    assert _take_in(spark, root, out) == sorted(batch(first) + batch(second), key=str)
    assert _take_in(spark, root, out) == sorted(batch(first) + batch(second), key=str)


def test_stream_dedup_across_files(spark, tmp_path, raw_frame):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    row = ("A", "1", "pop", "NV", "2025-01-01", "1")
    _write(raw_frame(row, row), root, "2025_01_01")
    _write(raw_frame(row, ("A", "1", "rock", "NV", "2025-01-01", "1")), root, "2025_01_02")
    def take_in():
        ST.dedup_stream(ST.read_raw_stream(spark, f"{root}/*/*.csv", files_per_trigger=1), out, f"{out}/state")
        return sorted((r["genres"], str(r["date"])) for r in spark.read.parquet(f"{out}/rows").collect())

    assert take_in() == [("pop", "2025-01-01"), ("rock", "2025-01-01")]
    # months late by its day, and a file with an old time stamp
    late = row[:4] + ("2024-01-01", "1")
    _write(raw_frame(late, row, late), root, "2025_01_03")
    for file in (tmp_path / "in" / "2025_01_03").rglob("*.csv"):
        os.utime(file, (1_600_000_000, 1_600_000_000))
    found = [("pop", "2024-01-01"), ("pop", "2025-01-01"), ("rock", "2025-01-01")]
    assert take_in() == found and take_in() == found


def _days(raw_frame, *days, score="1"):
    return raw_frame(*(("A", str(i % 5), "pop|rock", "NV", day, score) for day in days for i in range(7)))


def _found(spark, out):
    return sorted(tuple(r) for r in spark.read.parquet(f"{out}/rows").select("id", "genres", "date", "trend_score").collect())


def test_stored_rows_are_read_for_late_rows_only(spark, tmp_path, raw_frame, monkeypatch):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    asked, read = [], ST.stored_rows
    monkeypatch.setattr(ST, "stored_rows", lambda s, o, n, months: (asked.append(sorted(months)), read(s, o, n, months))[1])

    def take_in():
        ST.dedup_stream(ST.read_raw_stream(spark, f"{root}/*/*.csv", files_per_trigger=1), out, f"{out}/state", delay="5 days")

    # overlapping days, nothing older than the delay: state alone tells new keys from known ones
    for n, days in enumerate((("2025-03-01", "2025-03-02"), ("2025-03-02", "2025-03-04"), ("2025-03-04", "2025-03-05"), ("2025-03-20",))):
        _write(_days(raw_frame, *days, score=str(n)), root, f"2025_03_2{n}")
        take_in()
    assert asked == []
    one = lambda day, score: [(str(i), g, day, score) for i in range(5) for g in ("pop", "rock")]
    import datetime as dt

    wanted = [x for d, n in ((1, 0.0), (2, 0.0), (4, 1.0), (5, 2.0), (20, 3.0)) for x in one(dt.date(2025, 3, d), n)]
    assert _found(spark, out) == sorted(wanted)
    # late: a known day, a new one, and one of another month; only these months are read
    _write(_days(raw_frame, "2025-03-01", "2025-03-03", "2024-07-01", "2025-03-20", score="9"), root, "2025_03_30")
    take_in()
    wanted += one(dt.date(2025, 3, 3), 9.0) + one(dt.date(2024, 7, 1), 9.0)
    assert asked == [[(2024, 7), (2025, 3)]] and _found(spark, out) == sorted(wanted)
    take_in()
    assert len(asked) == 1 and _found(spark, out) == sorted(wanted)


def test_state_forgets_what_the_watermark_passed(spark, tmp_path, raw_frame):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    kept = []
    for n, day in enumerate(("2025-01-01", "2025-03-01", "2025-03-02")):
        _write(_days(raw_frame, day), root, f"2025_03_2{n}")
        query = ST.dedup_stream(ST.read_raw_stream(spark, f"{root}/*/*.csv"), out, f"{out}/state", delay="5 days")
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert kept[-1] <= 20 and spark.read.parquet(f"{out}/rows").count() == 30


def test_a_micro_batch_that_comes_twice_counts_once(spark, tmp_path, raw_frame, monkeypatch):
    """The part after the state: its answer and the rows of a micro-batch are handed over again."""
    out = str(tmp_path / "out")
    takes = []
    monkeypatch.setattr(ST, "run_batches", lambda raw, take, checkpoint: takes.append(take))
    spark.createDataFrame([], ST.LANDED_SCHEMA).write.parquet(f"{out}/arrived/x")
    ST.dedup_landed(spark, out, f"{out}/state", "5 days")
    schema = "artist string, id string, genres string, location string, date date, trend_score double, batch_id long, known boolean"
    import datetime as dt

    row = ("A", "1", "pop", "NV", dt.date(2025, 1, 1), 1.0, 0, None)
    first = spark.createDataFrame([row, (None, "1", "pop", "NV", dt.date(2025, 1, 1), None, None, False)], schema)
    later = spark.createDataFrame([row[:4] + (dt.date(2025, 2, 1), 1.0, 1, None), row, (None, "1", "pop", "NV", dt.date(2025, 2, 1), None, None, False)], schema)
    for rows, number in ((first, 0), (first, 0), (later, 1), (later, 1)):
        takes[0](rows, number)
    assert sorted(str(r["date"]) for r in spark.read.parquet(f"{out}/rows").collect()) == ["2025-01-01", "2025-02-01"]


def test_stream_keeps_rows_counts_and_dimensions(spark, tmp_path, raw_frame):
    from trendengine.operators import dims
    from trendengine.operators.profile import sum_metrics
    from trendengine.sources.readers import read_dim

    root, out = str(tmp_path / "in"), str(tmp_path / "out")

    def take_in():
        raw = ST.read_raw_stream(spark, f"{root}/*/*.csv", files_per_trigger=1)
        ST.refresh_stream(raw, out, f"{out}/dims", f"{out}/state")

    def genres():
        rows = read_dim(spark, f"{out}/dims/dim_genres", dims.GENRES.schema).orderBy("genre_id").collect()
        return [tuple(r) for r in rows]

    _write(raw_frame(("A", "1", "pop|rock", "nv", "2025_01_01", "1"), ("B", None, "x", "nv", "2025-01-01", "1")), root, "2025_01_01")
    take_in()
    assert genres() == [(1, "pop"), (2, "rock")]
    _write(raw_frame(("A", "1", "dub;pop", "nv", "2025_01_02", "500")), root, "2025_01_02")
    take_in()
    take_in()
    assert genres() == [(1, "pop"), (2, "rock"), (3, "dub")]
    assert spark.read.parquet(f"{out}/rows").count() == 4
    counts = sum_metrics(spark.read.parquet(f"{out}/counts").drop("batch_id")).head()
    assert (counts["rows_in"], counts["rows_after_explode"], counts["dropped_missing_id_loc_date"]) == (3, 4, 1)
