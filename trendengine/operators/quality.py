"""Checks on the clean trend table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trendengine.constants import DELIMITER, UNKNOWN_GENRE
from trendengine.functions import scores as S
from trendengine.operators.clean import has_keys

# Highest share of rows, in percent, that may show a defect.
THRESHOLDS = {
    "missing_keys": 5.0,
    "score_out_of_range": 25.0,
    "missing_genres": 15.0,
    "location_not_two_letters": 0.0,
    "bad_dates": 1.0,
}


def has_many_genres():
    return F.col("genres").contains(DELIMITER)


def single_genre_check(df: DataFrame) -> DataFrame:
    """Counts of rows that still hold several genres."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(has_many_genres()).alias("violations"),
        (F.count_if(has_many_genres()) == 0).alias("passed"),
    )


def assert_single_genre(df: DataFrame, column: str = "genre") -> DataFrame:
    """The same rows; the job that reads them fails on one with several genres."""
    bad = F.col(column).contains(DELIMITER)
    return df.where(F.when(bad, F.raise_error(F.lit("a row holds several genres"))).otherwise(True))


def key_shape_check(df: DataFrame) -> DataFrame:
    """Locations that are no two-letter code, and the spread of id lengths."""
    length = F.length("id").cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("location").rlike("^[A-Z]{2}$")).alias("bad_locations"),
        F.min(length).alias("min_id_length"),
        F.max(length).alias("max_id_length"),
        F.count_distinct(length).alias("n_id_lengths"),
    )


def defects() -> dict:
    """What makes a typed row defective, by metric."""
    return {
        "missing_keys": ~has_keys(),
        "score_out_of_range": S.is_out_of_range(F.col("trend_score")),
        "missing_genres": F.col("genres").isNull() | (F.col("genres") == UNKNOWN_GENRE),
        "location_not_two_letters": F.length("location") != 2,
        "bad_dates": F.col("date").isNull(),
    }


def dq_report(typed: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """One row per check on typed rows: measured percent, threshold, verdict."""
    thresholds, found = thresholds or THRESHOLDS, defects()
    counts = typed.agg(
        F.count(F.lit(1)).alias("n_rows"), *(F.count_if(found[name]).alias(name) for name in thresholds)
    )
    checks = counts.unpivot(["n_rows"], list(thresholds), "metric", "n_bad")
    limit = F.create_map(*(F.lit(x) for pair in thresholds.items() for x in pair))
    share = F.round(F.coalesce(F.try_divide(100.0 * F.col("n_bad"), "n_rows"), F.lit(0.0)), 4)
    return checks.select(
        "metric",
        "n_bad",
        share.alias("bad_percent"),
        limit[F.col("metric")].alias("threshold"),
        (share <= limit[F.col("metric")]).alias("passed"),
    )


#: Batches before the judged one that make its limits, and how many there must be.
HISTORY, LEAST_HISTORY = 30, 10
#: Width of the limits in robust standard deviations; weight of the newest batch in the moving average, and the width for that.
WIDTH, NEWEST, DRIFT_WIDTH = 4.0, 0.3, 4.0
#: The median deviation of a normal distribution times this is its standard deviation.
MAD_TO_SIGMA = 1.4826
#: Least spread, in percentage points, so that a metric that never moved does not alert on noise.
LEAST_SPREAD = 0.05


def _median(values):
    """Median of an array, null for an empty one."""
    ordered, n = F.array_sort(values), F.size(values)
    at = lambda i: F.get(ordered, F.floor(i).cast("int"))
    return (at((n - 1) / 2) + at(n / 2)) / 2


def control_limits(history: DataFrame) -> DataFrame:
    """Each batch metric (batch, metric, value) against the batches before it: robust limits and drift, no fixed thresholds.

    Limits are the median of the last `HISTORY` batches, `WIDTH` robust deviations (median absolute deviation) up and down, so an
    earlier outlier does not widen them. A slow drift shows in a moving average that weighs the newest batch by `NEWEST`: it is held to
    limits as much narrower as such averages vary less. With fewer than `LEAST_HISTORY` batches before, nothing alerts.
    Batches are ordered by name; a metric's batches meet in one task, one number each.
    """
    before = W.partitionBy("metric").orderBy("batch").rowsBetween(-HISTORY, -1)
    rows = history.withColumn("past", F.collect_list("value").over(before)).withColumn("n_before", F.size("past").cast("long"))
    rows = rows.withColumn("center", _median(F.col("past")))
    rows = rows.withColumn("spread", MAD_TO_SIGMA * _median(F.transform("past", lambda v: F.abs(v - F.col("center")))))
    rows = rows.withColumn("spread", F.greatest("spread", F.lit(LEAST_SPREAD)))
    smooth = F.aggregate(F.concat("past", F.array("value")), F.col("center"), lambda a, v: (1 - NEWEST) * a + NEWEST * v)
    narrower = (NEWEST / (2 - NEWEST)) ** 0.5
    enough = F.col("n_before") >= LEAST_HISTORY
    off = lambda v, width: F.coalesce(enough & (F.abs(v - F.col("center")) > width * F.col("spread")), F.lit(False))
    r = lambda c, name: F.round(F.round(c, 9), 6).alias(name)
    return rows.select(
        "batch",
        "metric",
        r(F.col("value"), "value"),
        "n_before",
        r(F.col("center"), "center"),
        r(F.col("spread"), "spread"),
        off(F.col("value"), WIDTH).alias("outside"),
        off(smooth, DRIFT_WIDTH * narrower).alias("drifting"),
    )


def batch_metrics(typed: DataFrame, batch, thresholds: dict[str, float] | None = None) -> DataFrame:
    """(batch, metric, value): the shares of defects of `dq_report`, in percent, per batch."""
    names = list(thresholds or THRESHOLDS)
    found = defects()
    shares = typed.groupBy(batch.alias("batch")).agg(*((100.0 * F.count_if(found[n]) / F.count(F.lit(1))).alias(n) for n in names))
    return shares.unpivot(["batch"], names, "metric", "value")
