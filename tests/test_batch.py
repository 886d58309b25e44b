import datetime as dt

import pytest

from trendengine.operators.explode import run_summary
from trendengine.plans import batch
from trendengine.schemas import DIM_ARTISTS
from trendengine.sinks import writers as W
from trendengine.sources import readers as R


@pytest.fixture
def root(raw_frame, tmp_path):
    rows = [
        (" Ann ", "1", "pop|rock", "nv", "2025_01_01", "120"),
        ("Bo", "2", "[]", "ca", "2025-01-31", "7"),
        ("Bo", "2", "dub;;", "ca", "2025-02-01", None),
        ("Cy", None, "dub", "ca", "2025-02-01", "1"),
    ]
    W.write_csv(raw_frame(*rows), W.raw_path(str(tmp_path / "in"), "2025_02_02"))
    return tmp_path


@pytest.mark.parametrize("files", [None, 2])
def test_transform_writes_rows_and_counts(spark, root, files):
    path, counts = batch.transform_batch(spark, str(root / "out"), root=str(root / "in"), files_per_month=files)
    assert path.endswith("/2025_02_02/spotify_rising_cleaned_2025_02_02")
    rows = R.read_cleaned(spark, path).select("artist", "id", "genres", "location", "date", "trend_score")
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("Ann", "1", "pop", "NV", dt.date(2025, 1, 1), 100.0),
        ("Ann", "1", "rock", "NV", dt.date(2025, 1, 1), 100.0),
        ("Bo", "2", "dub", "CA", dt.date(2025, 2, 1), 0.0),
    ]
    raw = R.read_raw_csv(spark, W.raw_path(str(root / "in"), "2025_02_02"))
    assert counts == run_summary(raw).head().asDict()
    assert counts["rows_after_explode"] == 3 and counts["dropped_empty_list"] == 1


def test_dimensions_and_staging_from_the_written_table(spark, root):
    path, _ = batch.transform_batch(spark, str(root / "out"), root=str(root / "in"))
    cleaned = R.read_cleaned(spark, path)
    batch.refresh_dims(spark, cleaned, str(root / "dims"))
    names = {r["artist_name"] for r in R.read_dim(spark, str(root / "dims/dim_artists"), DIM_ARTISTS).collect()}
    assert names == {"Ann", "Bo"}
    assert batch.stage_rows(cleaned).count() == 3
    assert batch.stage_rows(cleaned.limit(0)) is None


def test_text_is_scanned_once(spark, root):
    """Counting and writing share one pass, without any shuffle."""
    from trendengine.operators.clean import clean
    from trendengine.operators.explode import explode_genres

    raw = R.with_file_order(R.read_raw_csv(spark, W.raw_path(str(root / "in"), "2025_02_02")))
    plan = explode_genres(clean(raw))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan


def test_empty_batch(spark, raw_frame, tmp_path):
    W.write_csv(raw_frame(), W.raw_path(str(tmp_path / "in"), "2025_02_02"))
    path, counts = batch.transform_batch(spark, str(tmp_path / "out"), root=str(tmp_path / "in"))
    assert set(counts.values()) == {0} and len(counts) == 9


def test_job_is_set_up_by_the_environment(spark, root, monkeypatch):
    from trendengine.plans.job import main

    for name in ("TRANSFORM_ROOT", "RAW_ROOT", "TRANSFORM_ONE_OFF_INPUT", "DIMS_ROOT", "STAGING_PATH", "STAGING_JDBC_URL"):
        monkeypatch.delenv(name, raising=False)
    with pytest.raises(EnvironmentError):
        main()
    monkeypatch.setenv("TRANSFORM_ROOT", str(root / "out"))
    with pytest.raises(ValueError):
        main()
    monkeypatch.setenv("RAW_ROOT", str(root / "in"))
    monkeypatch.setenv("DIMS_ROOT", str(root / "dims"))
    monkeypatch.setenv("STAGING_PATH", str(root / "staging"))
    assert main()["rows_after_explode"] == 3
    assert sorted(r["genre"] for r in spark.read.parquet(str(root / "staging")).collect()) == ["dub", "pop", "rock"]
    assert R.read_dim(spark, str(root / "dims/dim_artists"), DIM_ARTISTS).count() == 2


def test_load_step_finds_the_newest_cleaned_batch(spark, root, raw_frame):
    out, got = str(root / "out"), []
    with pytest.raises(FileNotFoundError):
        batch.load_batch(spark, out, got.append)
    batch.transform_batch(spark, out, root=str(root / "in"))
    assert batch.latest_cleaned(spark, out)[1] == "2025_02_02"
    assert batch.load_batch(spark, out, got.append) == "2025_02_02" and got[0].count() == 3
    W.write_csv(raw_frame(), W.raw_path(str(root / "in"), "2025_03_03"))
    batch.transform_batch(spark, out, root=str(root / "in"))
    assert batch.load_batch(spark, out, got.append) is None and len(got) == 1


def test_refresh_leaves_no_staged_keys(spark, root):
    path, _ = batch.transform_batch(spark, str(root / "out"), root=str(root / "in"), files_per_month=2)
    batch.refresh_dims(spark, R.read_cleaned(spark, path), str(root / "dims"))
    assert not [p.name for p in [*(root / "dims").iterdir(), *(root / "out").iterdir()] if "_staged" in p.name]
