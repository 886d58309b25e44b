"""Profiles of a table: counts, histogram, summary statistics.

Every profile is built on grouped counts, so values that repeat shrink before they move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trendengine.constants import HISTOGRAM_BINS, UNKNOWN_GENRE
from trendengine.functions import scores as S
from trendengine.operators.numbering import BLOCK_BITS, counts_before


def percent(cond: Column) -> Column:
    return F.round(F.try_divide(100.0 * F.count_if(cond), F.count(F.lit(1))), 2)


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, from one aggregate."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return counts.unpivot([], df.columns, "column_name", "n_null")


def value_counts(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def location_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, F.col("location"), "location")


def id_length_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, F.length("id").cast("long"), "id_length")


def genre_presence(df: DataFrame) -> DataFrame:
    """Rows with and without genres."""
    missing = F.col("genres").isNull()
    return df.agg(
        F.count_if(~missing).alias("with_genres"),
        F.count_if(missing).alias("without_genres"),
        percent(missing).alias("missing_percent"),
    )


def unknown_share(exploded: DataFrame) -> DataFrame:
    unknown = F.col("genres") == UNKNOWN_GENRE.lower()
    return exploded.agg(
        F.count_if(unknown).alias("unknown_rows"),
        F.count(F.lit(1)).alias("total_rows"),
        percent(unknown).alias("unknown_percent"),
    )


def score_histogram(df: DataFrame, column: str = "trend_score", bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Bins of equal width between the smallest and the largest value; the last bin holds its end. NaN is missing."""
    values = value_counts(df.where(~S.is_missing(F.col(column))), F.col(column), "v")
    # Reading n here as well keeps both uses of the counts alike, so that Spark computes them once.
    counted = F.when(F.col("n") > 0, F.col("v"))
    bounds = values.agg(F.min(counted).alias("lo"), F.max(counted).alias("hi"))
    lo, width = bounds.select("lo").scalar(), bounds.select(F.col("hi") - F.col("lo")).scalar()
    counts = (
        values.withColumns({"lo": lo, "width": width})
        .select(
            "n",
            F.coalesce(
                F.least(F.floor(F.try_divide(F.col("v") - F.col("lo"), "width") * bins), F.lit(bins - 1)),
                F.lit(bins // 2),
            ).cast("long").alias("bin"),
        )
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    edge = lambda i: F.round(F.col("lo") + i * F.col("width") / bins, 6)
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(counts, "bin", "left")
        .withColumns({"lo": lo, "width": width})
        .select(
            "bin",
            edge(F.col("bin")).alias("lower"),
            edge(F.col("bin") + 1).alias("upper"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def _order_code(v: Column) -> Column:
    """Integer that never falls when ``v`` rises; close values may share it."""
    return F.floor(F.signum(v) * F.log1p(F.abs(v)) * F.lit(float(1 << 29))).cast("long")


def _with_cumulative(counts: DataFrame) -> DataFrame:
    """Distinct values with the number of rows up to and including each of them."""
    coded = counts.withColumn("_code", _order_code(F.col("v")))
    cells = coded.groupBy("_code").agg(F.sum("n").alias("_n"))
    before = counts_before(cells, "_code", "_n", "_before")
    upto = W.partitionBy("_code").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        coded.withColumn("_upto", F.sum("n").over(upto))
        .join(before, "_code")
        .select("v", "n", (F.col("_before") + F.col("_upto")).alias("cumulative"))
    )


def _quantile(p: float) -> Column:
    """Linear interpolation between the two rows next to position p * (rows - 1)."""
    position = F.lit(p) * (F.max("_total") - 1)
    # min over the values that reach a rank; ranks depend on the total, one constant per table.
    at = lambda rank: F.min(F.when(F.col("cumulative") > rank, F.col("v")))
    low_rank = F.floor(F.lit(p) * (F.col("_total") - 1))
    high_rank = F.ceil(F.lit(p) * (F.col("_total") - 1))
    low, high = at(low_rank), at(high_rank)
    return low + (high - low) * (position - F.floor(position))


def describe_scores(df: DataFrame, column: str = "trend_score") -> DataFrame:
    """Count, mean, deviation, quartiles, distinct values and mode of a numeric column, all exact. NaN is missing."""
    v = F.col(column)
    # The joins below want codes that are not null. Said here, it holds for each use of the
    # counts, so Spark sees them alike and scans the table once.
    code = _order_code(v)
    usable = ~S.is_missing(v) & v.isNotNull() & code.isNotNull() & F.shiftright(code, BLOCK_BITS).isNotNull()
    counts = value_counts(df.where(usable), v, "v")
    total = counts.agg(F.sum("n")).scalar()
    mean = counts.agg(F.sum(F.col("n") * F.col("v")) / F.sum("n")).scalar()
    ranked = _with_cumulative(counts).withColumns({"_total": total, "_mean": mean})
    r = lambda c, name: F.round(c, 6).alias(name)
    deviation = F.sum(F.col("n") * F.pow(F.col("v") - F.col("_mean"), 2))
    return ranked.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        r(F.max("_mean"), "mean"),
        r(F.sqrt(F.try_divide(deviation, F.sum("n") - 1)), "std"),
        F.min("v").alias("min"),
        r(_quantile(0.25), "p25"),
        r(_quantile(0.50), "p50"),
        r(_quantile(0.75), "p75"),
        F.max("v").alias("max"),
        # Most frequent value, the smallest one on a tie.
        F.max_by("v", F.struct("n", -F.col("v"))).alias("mode"),
    )


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct values and most frequent value of text columns, from one shuffle."""
    long = df.select(
        F.explode(
            F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in columns))
        ).alias("cell")
    ).select("cell.*")
    counts = long.where(F.col("v").isNotNull()).groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    per_column = counts.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_unique"),
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("v").alias("v"))).alias("_top"),
    )
    return per_column.select(
        "column_name", "n_rows", "n_unique", F.col("_top.v").alias("top"), (-F.col("_top.neg")).alias("freq")
    )


def sum_metrics(frames: DataFrame) -> DataFrame:
    """Metric rows of several batches or chunks as one."""
    return frames.agg(*(F.sum(c).alias(c) for c in frames.columns))
