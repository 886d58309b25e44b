import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from trendengine.functions import genres as G
from trendengine.operators import clean as C
from trendengine.operators import explode as X

DAY = dt.date(2025, 3, 4)


def _row(genres):
    return ("Mira Sol", "a1", genres, "TX", DAY, 12.0)


def _explode(df):
    genres = sorted(r["genres"] for r in X.explode_genres(df).collect())
    return genres, X.explode_metrics(df).head().asDict()


@pytest.mark.parametrize(
    "text, genres, respelled, empty, empty_list",
    [
        ("Folk; Dub", ["dub", "folk"], 0, 0, 0),
        ("Folk|Dub,Soul", ["dub", "folk", "soul"], 1, 0, 0),
        ("['Folk', 'Dub']", ["dub", "folk"], 1, 0, 0),
        ('["Folk", "Dub"]', ["dub", "folk"], 1, 0, 0),
        ('["dream pop"]', ["dream pop"], 0, 0, 0),
        ("Folk;;Dub;", ["dub", "folk"], 0, 2, 0),
        (" ; ", [], 0, 2, 0),
        ("", [], 0, 1, 0),
        ("[]", [], 0, 0, 1),
        ("[ ]", [], 0, 0, 1),
        ("[null]", [], 0, 1, 0),
        ('["a\\u0062c"]', ["abc"], 0, 0, 0),
        ("['rock 'n' roll']", ["rock 'n' roll"], 0, 0, 0),
        ("(Folk)", ["folk"], 0, 0, 0),
        ('["one;two"]', ["one;two"], 0, 0, 0),
        ("folk;folk", ["folk", "folk"], 0, 0, 0),
        ("\tFolk \n", ["folk"], 0, 0, 0),
        ("Unknown", ["unknown"], 0, 0, 0),
    ],
)
def test_genre_spellings(clean_frame, text, genres, respelled, empty, empty_list):
    found, metrics = _explode(clean_frame(_row(text)))
    assert found == genres
    assert metrics == {
        "genre_delim_replaced": respelled,
        "rows_after_explode": len(genres),
        "dropped_empty_genre": empty,
        "dropped_empty_list": empty_list,
    }


def test_skipping_hopeless_json_changes_nothing(spark):
    """The test that spares failed parses agrees with parsing every bracketed text."""
    texts = [
        "['a'; 'b']", '["a";"b"]', '["a\\";b"]', '["a;b"]', '["a"; 2]', "[1]", "[true]", '[["a"]]',
        '["a" ]', "[", "]", "[]]", '["a"', "a]", " [\"a\"] ", "['it's']", '[{"k":"v"}]', "[a;b]", "x[y]z",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "g string")
    core = F.btrim("g", F.lit(" \t\n\x0b\f\r"))
    always = F.coalesce(
        F.when(
            core.startswith("[") & core.endswith("]"),
            F.from_json(F.replace("g", F.lit("'"), F.lit('"')), "array<string>"),
        ),
        F.split("g", ";"),
    )
    for row in df.select("g", G.genre_list(F.col("g")).alias("own"), always.alias("always")).collect():
        assert row["own"] == row["always"], row["g"]


def test_summary_from_one_pass_equals_the_steps(raw_frame):
    raw = raw_frame(
        ("A", "1", "pop|rock", "NV", "2025-01-01", "5"),
        ("A", "1", "[]", "NV", "2025-01-02", "500"),
        ("A", None, "pop|rock;x", "NV", "2025-01-03", None),
        ("A", "2", ";;", "NV", "bad", "x"),
        ("A", "3", None, "CA", "2025_01_04", "-1"),
        ("A", "4", "['b']; ", " ", "2025_01_04", "1"),
    )
    clean = C.clean(raw)
    steps = {**C.clean_metrics(raw).head().asDict(), **X.explode_metrics(clean).head().asDict()}
    assert X.run_summary(raw).head().asDict() == steps
    assert steps["rows_in"] == clean.count() + steps["dropped_missing_id_loc_date"]
    assert steps["rows_after_explode"] == X.explode_genres(clean).count()


def test_observed_counts_equal_the_aggregate(clean_frame, tmp_path):
    df = clean_frame(*[_row(g) for g in ("a;b", "a|b", "[]", ";", "['x']")])
    seen = Observation("tokens")
    X.explode_genres(df, seen).write.parquet(str(tmp_path / "out"))
    assert seen.get == X.explode_metrics(df).head().asDict()


def test_position_follows_the_text(clean_frame):
    rows = X.explode_genres(clean_frame(_row("x;;y;z")), position="at").collect()
    assert {(r["genres"], r["at"]) for r in rows} == {("x", 0), ("y", 2), ("z", 3)}
