import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from trendengine.functions import scores as S
from trendengine.operators import clean as C


def test_good_row_is_standardized_and_bad_row_dropped(raw_frame):
    raw = raw_frame(
        ("  Mira Sol ", " a1 ", None, " tx ", "2025_11_30", "130.5"),
        ("Otto", "b2", "Folk", "or", "30/11/2025", None),
    )
    rows = C.clean(raw).collect()
    assert [tuple(r) for r in rows] == [
        ("Mira Sol", "a1", "Unknown", "TX", dt.date(2025, 11, 30), 100.0)
    ]
    metrics = C.clean_metrics(raw).head().asDict()
    assert metrics == {
        "rows_in": 2,
        "bad_dates": 1,
        "score_out_of_range": 2,
        "dropped_missing_id_loc_date": 1,
        "blank_keys": 0,
    }


@pytest.mark.parametrize(
    "text, day",
    [
        ("2025-01-31", dt.date(2025, 1, 31)),
        (" 2025_01_31 ", dt.date(2025, 1, 31)),
        ("2024-02-29", dt.date(2024, 2, 29)),
        ("2025-02-29", None),
        ("2025-1-31", None),
        ("2025-01-31 00:00:00", None),
        ("2025-01-31T", None),
        ("2025-13-01", None),
        ("2025-01", None),
        ("+2025-01-31", None),
        ("today", None),
        ("", None),
        (None, None),
    ],
)
def test_days_are_read_strictly(spark, text, day):
    df = spark.createDataFrame([(text,)], "date string")
    own, pattern = df.select(
        S.to_day(F.col("date")), F.try_to_date(F.trim(F.replace("date", F.lit("_"), F.lit("-"))), "yyyy-MM-dd")
    ).head()
    assert own == day == pattern


@pytest.mark.parametrize(
    "text, score, out",
    [
        ("42", 42.0, False),
        (" 7.5 ", 7.5, False),
        ("0", 0.0, False),
        ("100", 100.0, False),
        ("100.01", 100.0, True),
        ("-3", 0.0, True),
        ("n/a", 0.0, True),
        ("", 0.0, True),
        (None, 0.0, True),
        ("NaN", 0.0, True),
        ("Infinity", 100.0, True),
    ],
)
def test_scores_are_clipped_and_counted(spark, text, score, out):
    parsed = S.to_score(F.col("s"))
    row = spark.createDataFrame([(text,)], "s string").select(S.clip(parsed), S.is_out_of_range(parsed)).head()
    assert tuple(row) == (score, out)


def test_blank_keys_stay_and_are_counted(raw_frame):
    raw = raw_frame(("A", "  ", "pop", "NV", "2025-01-01", "1"))
    assert C.clean(raw).head()["id"] == ""
    assert C.clean_metrics(raw).head()["blank_keys"] == 1


def test_null_artist_stays_null(raw_frame):
    assert C.clean(raw_frame((None, "x", "pop", "NV", "2025-01-01", "1"))).head()["artist"] is None


def test_quarantine_and_clean_split_the_input(raw_frame):
    raw = raw_frame(
        ("A", "x", "pop", "NV", "2025-01-01", "1"),
        ("A", None, "pop", "NV", "2025-01-01", "1"),
        ("A", "x", "pop", None, "2025-01-01", "1"),
        ("A", "x", "pop", "NV", "never", "1"),
    )
    assert C.quarantine(raw).count() == 3
    assert C.clean(raw).count() == 1


def test_observed_counts_equal_the_aggregate(raw_frame, tmp_path):
    raw = raw_frame(*[("A", str(i), "pop", "NV", "2025-01-0%d" % (i % 10), str(i * 9)) for i in range(40)])
    seen = Observation("seen")
    C.clean(raw, seen).write.parquet(str(tmp_path / "out"))
    assert seen.get == C.clean_metrics(raw).head().asDict()


def test_other_columns_pass_through(raw_frame):
    raw = raw_frame(("A", "x", "pop", "NV", "2025-01-01", "1")).withColumn("ingest_seq", F.lit(7))
    assert C.clean(raw).head()["ingest_seq"] == 7


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="trend_score"):
        C.clean(spark.createDataFrame([("a", "b")], "artist string, id string"))


def test_filter_instead_of_clip(raw_frame):
    raw = raw_frame(
        *[("A", "x", "pop", "NV", "2025-01-01", s) for s in ("50", "0", "100", "101", "-1", None, "NaN")]
    )
    kept = C.filter_score_range(C.type_columns(raw)).select("trend_score").collect()
    assert sorted(r[0] for r in kept) == [0.0, 50.0, 100.0]


def test_key_tests_reach_the_scan(spark, raw_frame, tmp_path):
    raw_frame(("A", "x", "pop", "NV", "2025-01-01", "1")).write.parquet(str(tmp_path / "raw"))
    plan = C.clean(spark.read.parquet(str(tmp_path / "raw")))._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "IsNotNull(id)" in pushed and "IsNotNull(location)" in pushed
