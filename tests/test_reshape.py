import datetime as dt
import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from trendengine.operators.reshape import unpivot_trends
from trendengine.sources.readers import read_json_lines


def _lines(spark, tmp_path, *records):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n\n  \n")
    return read_json_lines(spark, str(path))


def test_both_spellings(spark, tmp_path):
    lines = _lines(
        spark, tmp_path,
        {
            "artist": "A", "id": "1", "genres": ["x", "y"], "scrape_date": "d",
            "daily_trends_ca": {"2025-08-01 00:00:00": 45, "2025-08-02 00:00:00": None, "2025-08-03": 0},
            "daily_trends_US_only": True, "daily_trends_TX": {}, "daily_trends_NY": None,
        },
        {
            "artist": "B", "id": "2", "genres": [], "daily_trends_NV_2025-08-01": 7,
            "daily_trends_NV.2025-08-02T00:00:00": 9.5, "daily_trends_NV_total": 16,
        },
        {"artist": "C", "id": "3", "genres": "dub; soul", "daily_trends_WA": {"2025-08-01": "12", "soon": 3}},
        {"artist": "D", "id": "4"},
    )
    rows = sorted(tuple(r) for r in unpivot_trends(lines).collect())
    day = lambda d: dt.date(2025, 8, d)
    assert rows == [
        ("A", "1", "x; y", "CA", day(1), 45.0),
        ("A", "1", "x; y", "CA", day(3), 0.0),
        ("B", "2", "", "NV", day(1), 7.0),
        ("B", "2", "", "NV", day(2), 9.5),
        ("C", "3", "dub; soul", "WA", day(1), 12.0),
    ]


def test_empty_input_keeps_the_columns(spark, tmp_path):
    df = unpivot_trends(_lines(spark, tmp_path, ""))
    assert df.count() == 0
    assert df.columns == ["artist", "id", "genres", "location", "date", "trend_score"]


def test_broken_line_is_an_error_unless_told_otherwise(spark, tmp_path):
    lines = _lines(spark, tmp_path, '{"artist": "A"', {"artist": "B", "id": "2", "daily_trends_NV_2025-08-01": 1})
    with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED_RECORD"):
        unpivot_trends(lines).collect()
    assert unpivot_trends(lines, mode="PERMISSIVE").count() == 1


def test_records_as_variant_are_the_same_rows_and_broken_lines_end_nothing(spark, tmp_path):
    from trendengine.operators.reshape import parsed_records, rejected_records, unpivot_records

    good = [
        {"artist": "A", "id": "1", "genres": ["x", "y"], "daily_trends_ca": {"2025-08-01 00:00:00": 45, "2025-08-02 00:00:00": None, "2025-08-03": 0},
         "daily_trends_US_only": True, "daily_trends_TX": {}, "daily_trends_NY": None, "daily_trends_NV": [1, 2]},
        {"artist": "B", "id": "2", "genres": [], "daily_trends_NV_2025-08-01": 7, "daily_trends_NV.2025-08-02T00:00:00": 9.5, "daily_trends_NV_total": 16},
        {"artist": "C", "id": "3", "genres": "dub; soul", "daily_trends_WA": {"2025-08-01": "12", "soon": 3}},
        {"artist": "D", "id": "4"}, {"artist": None, "id": None, "genres": None, "daily_trends_WA": {"2025-08-01": 1}}, {},
    ]
    broken = ['{"artist": "E", "daily_trends_WA": {"2025-0', "[1, 2]", '"text"', "7", '{"a": 1, "a": 2}', '{"a" 1}', "null"]
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    (tmp_path / "a").mkdir()
    wanted = rows(unpivot_trends(_lines(spark, tmp_path / "a", *good)))
    parsed = parsed_records(_lines(spark, tmp_path, *good, *broken))
    assert rows(unpivot_records(parsed)) == wanted and len(wanted) == 6
    rejects = {r["value"]: r["reason"] for r in rejected_records(parsed).collect()}
    assert rejects.keys() == set(broken)
    assert (rejects[broken[0]], rejects["7"], rejects['{"a" 1}']) == ("cut short", "no object", "malformed")


def test_landing_counts_broken_lines_and_sets_them_aside(spark, tmp_path):
    from trendengine.sinks import writers as W

    lines, root = tmp_path / "l.jsonl", str(tmp_path / "raw")
    lines.write_text('{"artist": "A", "id": "1", "daily_trends_WA": {"2025-08-01": 1}}\n{"artist"\n\n')
    path, n = W.land_records(spark, str(lines), root, "2025_08_02")
    assert n == 1 and spark.read.option("header", True).csv(path).count() == 1
    assert [tuple(r) for r in spark.read.json(f"{root}/2025_08_02/quarantine").select("value", "reason").collect()] == [('{"artist"', "cut short")]
    lines.write_text("\n")
    assert W.land_records(spark, str(lines), str(tmp_path / "none"), "2025_08_02")[1] == 0
    assert not (tmp_path / "none" / "2025_08_02" / "quarantine").exists()
