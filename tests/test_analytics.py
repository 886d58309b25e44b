"""Facts, windows and profiles against plain Python on small data."""

import datetime as dt
import math
import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trendengine.functions import scores as S
from trendengine.operators import analytics as A
from trendengine.operators import profile as P
from trendengine.operators import quality as Q

GENRES, PLACES = ["pop", "rock", "dub"], ["NV", "CA"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    keys = {
        (str(rng.randrange(6)), rng.choice(GENRES), rng.choice(PLACES), dt.date(2025, 1, 1) + dt.timedelta(rng.randrange(40)))
        for _ in range(500)
    }
    return [("A" + k[0], *k[:3], k[3], float(rng.randrange(0, 101))) for k in sorted(keys)]


@pytest.fixture
def trends(clean_frame, rows):
    return clean_frame(*rows)


def test_genre_fact(trends, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2:5]].append(r[5])
    found = {tuple(r)[:3]: tuple(r)[3:] for r in A.fact_genre_trends(trends).collect()}
    assert found == {k: (round(sum(v) / len(v), 6), max(v), len(v)) for k, v in groups.items()}


def test_shares_sum_to_one(trends):
    sums = A.regional_genre_share(trends).groupBy("location").agg(F.sum("share")).collect()
    assert len(sums) == 2 and all(abs(r[1] - 1) < 1e-5 for r in sums)


def test_share_of_nothing_is_null(clean_frame):
    df = clean_frame(("A", "1", "pop", "NV", dt.date(2025, 1, 1), 0.0))
    assert A.regional_genre_share(df).head()["share"] is None


def test_rollups(trends, rows):
    found = {(r["genres"], r["location"], r["level"]): r["n_rows"] for r in A.trend_rollups(trends).collect()}
    wanted = Counter()
    for r in rows:
        for key in ((r[2], r[3], 0), (r[2], None, 1), (None, r[3], 2), (None, None, 3)):
            wanted[key] += 1
    assert found == dict(wanted)


def _weekly(rows):
    weeks = defaultdict(list)
    for _, i, g, loc, day, score in rows:
        weeks[(i, g, loc, day - dt.timedelta(day.weekday()))].append(score)
    return {k: sum(v) / len(v) for k, v in weeks.items()}


def test_velocity_and_rising_artists(trends, rows):
    weekly = _weekly(rows)
    series = defaultdict(list)
    for (i, g, loc, week), mean in sorted(weekly.items()):
        series[(i, g, loc)].append((week, mean))
    wanted = {}
    for key, points in series.items():
        for (last, before), (week, now) in zip([(None, None)] + points, points):
            follows = last is not None and (week - last).days == 7
            wanted[(*key, week)] = round(now - before, 6) if follows else None
    found = {(r["id"], r["genres"], r["location"], r["week"]): r["velocity"] for r in A.velocity(trends).collect()}
    assert found.keys() == wanted.keys()
    assert all(found[k] == pytest.approx(wanted[k]) if wanted[k] is not None else found[k] is None for k in wanted)

    best = defaultdict(list)
    for (i, g, loc, week), v in wanted.items():
        if v is not None:
            best[(g, loc, week)].append((-v, i))
    top = {(r["genres"], r["location"], r["week"], r["rank"]): r["id"] for r in A.rising_artists(trends, k=2).collect()}
    assert top == {(*k, n + 1): i for k, v in best.items() for n, (_, i) in enumerate(sorted(v)[:2])}


def test_top_k_is_cut_before_the_shuffle(trends):
    for df in (A.top_artists(trends), A.rising_artists(trends)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Partial" in plan and "WindowGroupLimit" in plan
    plan = A.trending_in_region(trends, "NV")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def _artist_days(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, location string, date date, trend_score double")


def test_trajectory_counts_calendar_days(spark):
    day = lambda n: dt.date(2025, 1, n)
    fact = _artist_days(spark, ("a", "NV", day(1), 10.0), ("a", "NV", day(7), 20.0), ("a", "NV", day(8), 60.0), ("a", "CA", day(8), 1.0))
    found = {(r["location"], r["date"]): (r["moving_avg"], r["n_days"]) for r in A.trajectory(fact).collect()}
    assert found == {("NV", day(1)): (10.0, 1), ("NV", day(7)): (15.0, 2), ("NV", day(8)): (40.0, 2), ("CA", day(8)): (1.0, 1)}


def test_calendar_has_no_gaps(spark):
    day = lambda n: dt.date(2025, 1, n)
    fact = _artist_days(spark, ("a", "NV", day(2), 5.0), ("a", "NV", day(5), 0.0), ("b", "NV", day(9), 7.0))
    found = sorted(tuple(r) for r in A.fill_calendar(fact).collect())
    assert found == [
        ("a", "NV", day(2), 5.0, False), ("a", "NV", day(3), 0.0, True), ("a", "NV", day(4), 0.0, True),
        ("a", "NV", day(5), 0.0, False), ("b", "NV", day(9), 7.0, False),
    ]


def test_genre_direction(spark):
    day = lambda n: dt.date(2025, 1, n)
    fact = spark.createDataFrame(
        [("pop", "NV", day(1), 5.0), ("pop", "NV", day(3), 2.0), ("pop", "NV", day(4), 2.0), ("pop", "NV", day(5), 8.0)],
        "genres string, location string, date date, avg_score double",
    )
    found = [(r["change"], r["direction"]) for r in A.genre_direction(fact).orderBy("date").collect()]
    assert found == [(None, None), (-3.0, -1), (0.0, 0), (6.0, 1)]


def test_spans():
    assert S.last_complete_month(dt.date(2025, 1, 15)) == (dt.date(2024, 12, 1), dt.date(2024, 12, 31))
    assert S.last_complete_month(dt.date(2024, 3, 31)) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert S.last_days(dt.date(2025, 3, 1)) == (dt.date(2025, 2, 15), dt.date(2025, 2, 28))


def test_span_reaches_the_scan(spark, tmp_path, trends):
    trends.write.parquet(str(tmp_path / "t"))
    df = A.in_span(spark.read.parquet(str(tmp_path / "t")), S.last_days(dt.date(2025, 1, 20)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2025-01-06)" in plan and "LessThanOrEqual(date,2025-01-19)" in plan


def _percentile(values, p):
    values, at = sorted(values), p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at))


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [1.0, 1.0, 1.0],
        [0.0, -5.0, 2.5, 2.5, 1e300],
        [-0.001, 0.001, 0.0, 1e-12, -1e-12, 350.0],
        [float(random.Random(1).gauss(40, 30)) for _ in range(500)],
    ],
)
def test_description_is_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "trend_score double").repartition(4)
    row = P.describe_scores(df).head()
    assert (row["n_rows"], row["n_distinct"]) == (len(values), len(set(values)))
    assert (row["min"], row["max"]) == (min(values), max(values))
    for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        assert row[name] == pytest.approx(_percentile(values, p), abs=1e-6)
    if max(values) < 1e9:
        assert row["mean"] == pytest.approx(statistics.fmean(values), abs=1e-6)
        if len(values) > 1:
            assert row["std"] == pytest.approx(statistics.stdev(values), abs=1e-6)
    top = max(Counter(values).values())
    assert row["mode"] == min(v for v, n in Counter(values).items() if n == top)


def test_histogram(spark):
    values = [0.0, 1.0, 1.0, 9.99, 10.0, 5.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "trend_score double")
    found = P.score_histogram(df, bins=10).orderBy("bin").collect()
    assert [r["n"] for r in found] == [1, 2, 0, 0, 0, 1, 0, 0, 0, 2]
    assert (found[0]["lower"], found[9]["upper"]) == (0.0, 10.0)
    same = spark.createDataFrame([(4.0,), (4.0,)], "trend_score double")
    assert sum(r["n"] for r in P.score_histogram(same).collect()) == 2


def test_text_description(clean_frame):
    day = dt.date(2025, 1, 1)
    df = clean_frame(("B", "1", "x", "NV", day, 1.0), ("A", "1", None, "NV", day, 1.0), ("A", "2", None, "CA", day, 1.0), ("B", "3", None, "CA", day, 1.0))
    found = {r["column_name"]: tuple(r)[1:] for r in P.describe_text(df, ["artist", "id", "genres", "location"]).collect()}
    assert found == {"artist": (4, 2, "A", 2), "id": (4, 3, "1", 2), "genres": (1, 1, "x", 1), "location": (4, 2, "CA", 2)}


def test_profiles(clean_frame):
    day = dt.date(2025, 1, 1)
    df = clean_frame(("A", "12", None, "NV", None, 1.0), (None, "3", "unknown", "CA", day, None), ("C", "3", "pop", "NV", day, 2.0))
    assert {r[0]: r[1] for r in P.null_profile(df).collect()} == {
        "artist": 1, "id": 0, "genres": 1, "location": 0, "date": 1, "trend_score": 1,
    }
    assert {tuple(r) for r in P.location_counts(df).collect()} == {("NV", 2), ("CA", 1)}
    assert {tuple(r) for r in P.id_length_counts(df).collect()} == {(1, 2), (2, 1)}
    assert tuple(P.genre_presence(df).head()) == (2, 1, 33.33)
    assert tuple(P.unknown_share(df).head()) == (1, 3, 33.33)
    one = df.agg(F.count(F.lit(1)).alias("n"))
    assert P.sum_metrics(one.union(one)).head()["n"] == 6


def test_quality(clean_frame):
    day = dt.date(2025, 1, 1)
    df = clean_frame(("A", "1", "a;b", "NV", day, 150.0), ("A", "22", None, "NEV", None, 1.0), ("A", "1", "x", "NV", day, 1.0), ("A", None, "x", "NV", day, 1.0))
    assert tuple(Q.single_genre_check(df).head()) == (4, 1, False)
    assert tuple(Q.key_shape_check(df).head()) == (4, 1, 1, 2, 2)
    report = {r["metric"]: (r["n_bad"], r["bad_percent"], r["passed"]) for r in Q.dq_report(df).collect()}
    assert report == {
        "missing_keys": (2, 50.0, False), "score_out_of_range": (1, 25.0, True), "missing_genres": (1, 25.0, False),
        "location_not_two_letters": (1, 25.0, False), "bad_dates": (1, 25.0, False),
    }
    empty = {r["passed"] for r in Q.dq_report(df.limit(0)).collect()}
    assert empty == {True}


def test_description_scans_once(spark, tmp_path):
    path = str(tmp_path / "scores")
    spark.createDataFrame([(float(i % 7),) for i in range(50)], "trend_score double").write.parquet(path)
    df = P.describe_scores(spark.read.parquet(path))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 3


def test_nan_is_missing_in_profiles(spark):
    scores = [float("nan"), None, 1.0, 3.0, 3.0, 21.0, float("nan")]
    df = spark.createDataFrame([(v,) for v in scores], "trend_score double")
    row = P.describe_scores(df).head()
    assert (row["n_rows"], row["n_distinct"], row["mean"], row["min"], row["max"], row["mode"]) == (4, 3, 7.0, 1.0, 21.0, 3.0)
    bins = P.score_histogram(df).orderBy("bin").collect()
    assert sum(r["n"] for r in bins) == 4 and (bins[0]["lower"], bins[-1]["upper"]) == (1.0, 21.0)
    assert [r["n"] for r in bins if r["n"]] == [1, 2, 1]


def scanned(node) -> int:
    """Rows that the file scans below a plan node put out; what is reused counts once, where it was made."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return scanned(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return scanned(node.plan())
    if kind.startswith("Reused"):
        return 0
    if kind == "FileSourceScanExec":
        return node.metrics().get("numOutputRows").get().value()
    below = [x for nodes in (node.children(), node.subqueries()) for x in (nodes.apply(i) for i in range(nodes.size()))]
    return sum(map(scanned, below))


@pytest.mark.parametrize("profile", [P.describe_scores, P.score_histogram])
def test_profiles_read_the_table_once(spark, tmp_path, profile):
    path = str(tmp_path / "scores")
    spark.range(1000).selectExpr("CAST(id % 37 AS DOUBLE) AS trend_score").write.parquet(path)
    df = profile(spark.read.parquet(path))
    df.collect()
    assert scanned(df._jdf.queryExecution().executedPlan()) == 1000


@pytest.mark.parametrize("name", ["regional_genre_share", "trend_rollups", "velocity", "rising_artists", "top_artists", "genre_direction"])
def test_summaries_scan_the_raw_rows_once(spark, name):
    from trendengine.plans.queries import REGISTRY

    df = REGISTRY[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


def test_queries_read_the_tables_they_are_given_each_time(spark, tmp_path):
    """A table that changes under its path changes the result: nothing is kept for the session."""
    from trendengine.plans.queries import REGISTRY

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    path = str(tmp_path / "events.parquet")
    events.where("event_id % 2 = 0").write.parquet(path)
    names = ("fact_key_counts", "batch_date_from_path")
    before = [REGISTRY[n](spark, str(tmp_path)).toPandas().iloc[:, -1].sum() for n in names]
    events.write.mode("overwrite").parquet(path)
    spark.catalog.refreshByPath(path)
    after = [REGISTRY[n](spark, str(tmp_path)).toPandas().iloc[:, -1].sum() for n in names]
    assert before[1] < after[1]


def test_control_limits_alert_on_jumps_and_drift_only(spark):
    import random

    draw = random.Random(4)
    level = [10 + draw.uniform(-1, 1) for _ in range(40)]
    series = {
        "still": level, "jump": level[:30] + [40.0] + level[31:], "drift": level[:20] + [v + 0.25 * i for i, v in enumerate(level[20:])],
        "constant": [0.0] * 40, "short": level[:3] + [90.0],
    }
    rows = [(f"{i:03}", name, float(v)) for name, values in series.items() for i, v in enumerate(values)]
    found = {(r.metric, int(r.batch)): r for r in Q.control_limits(spark.createDataFrame(rows, "batch string, metric string, value double")).collect()}
    alerts = {m: [i for (x, i), r in sorted(found.items()) if x == m and r.outside] for m in series}
    assert alerts["still"] == alerts["constant"] == alerts["short"] == [] and alerts["jump"] == [30]
    assert not any(r.drifting for (m, _), r in found.items() if m in ("still", "constant"))
    drifting = [i for (m, i), r in sorted(found.items()) if m == "drift" and r.drifting]
    assert drifting and drifting[-1] == 39 and drifting[0] <= min(alerts["drift"] or [39])  # before any single batch is outside
