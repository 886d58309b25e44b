"""Profiles that merge: sketch states of batches in place of values.

Quartiles, distinct counts and frequent values do not add up, their sketches do. A batch leaves one row of states (`profile_states`) beside its
rows; the profile of any set of batches is the merge of their rows (`merged_profile`), without a look at the values.

Bounds, whatever the number of merges: the rank of a quantile is off by `RANK_ERROR` of the rows at most (KLL with `KLL_K`, at 99 %); distinct counts by
`DISTINCT_ERROR` (three standard errors of HyperLogLog with 2^`HLL_BITS` registers); a value with more than 1 in `TRACKED` of all rows is
among the frequent ones. NaN and null scores are missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendengine.functions import scores as S

KLL_K, RANK_ERROR = 800, 0.005
HLL_BITS, DISTINCT_ERROR = 14, 0.025
TRACKED, TOP = 512, 3
QUANTILES = (0.25, 0.5, 0.75)


def profile_states(df: DataFrame, batch: str, score: str = "trend_score", item: str = "genres", key: str = "id") -> DataFrame:
    """One row: the states of a batch."""
    value = F.when(~S.is_missing(F.col(score)), F.col(score))
    return df.agg(
        F.lit(batch).alias("batch"),
        F.count(value).alias("n_rows"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.kll_sketch_agg_double(value, F.lit(KLL_K)).alias("quantiles"),
        F.hll_sketch_agg((value + 0.0).cast("string"), F.lit(HLL_BITS)).alias("values"),
        F.hll_sketch_agg(key, F.lit(HLL_BITS)).alias("keys"),
        F.expr(f"approx_top_k_accumulate({item}, {TRACKED})").alias("items"),
    )


def merged_profile(states: DataFrame) -> DataFrame:
    """One row: the profile of all batches whose states are given."""
    merged = states.agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("n_rows").alias("n_rows"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles", F.lit(KLL_K)).alias("q"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("n_distinct"),
        F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("n_keys"),
        F.expr(f"approx_top_k_combine(items, {TRACKED})").alias("items"),
    )
    # no rows, no quantiles
    quantile = lambda p: F.when(F.col("n_rows") > 0, F.kll_sketch_get_quantile_double("q", F.lit(p))).alias(f"p{round(100 * p)}")
    return merged.select(
        "n_batches", "n_rows", "min", "max", *(quantile(p) for p in QUANTILES), "n_distinct", "n_keys",
        F.expr(f"approx_top_k_estimate(items, {TOP})").alias("frequent"),
    )


def within_bounds(df: DataFrame, merged: DataFrame, score: str = "trend_score", key: str = "id") -> DataFrame:
    """(metric, n_rows, within): each estimate against the values themselves, in two aggregates."""
    value = F.col(score)
    rows = df.where(~S.is_missing(value) & value.isNotNull()).crossJoin(F.broadcast(merged.drop("n_rows", "min", "max", "frequent")))  # one row
    exact = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count_if(value < F.col(f"p{round(100 * p)}")).alias(f"below{round(100 * p)}") for p in QUANTILES),
        *(F.count_if(value <= F.col(f"p{round(100 * p)}")).alias(f"upto{round(100 * p)}") for p in QUANTILES),
        F.count_distinct(value).alias("values"),
        F.max("n_distinct").alias("n_distinct"),
        F.max("n_keys").alias("n_keys"),
    )
    keys = df.agg(F.count_distinct(key).alias("keys"))  # keys of rows without a score count as well
    exact = exact.crossJoin(keys)

    def rank(p):
        name, target = round(100 * p), p * F.col("n_rows")
        near = (F.col(f"below{name}") - RANK_ERROR * F.col("n_rows") <= target) & (target <= F.col(f"upto{name}") + RANK_ERROR * F.col("n_rows"))
        return F.struct(F.lit(f"p{name}").alias("metric"), near.alias("within"))

    def distinct(metric, count):
        near = F.abs(F.col(metric) - F.col(count)) <= F.ceil(DISTINCT_ERROR * F.col(count))
        return F.struct(F.lit(metric).alias("metric"), near.alias("within"))

    found = F.array(*map(rank, QUANTILES), distinct("n_distinct", "values"), distinct("n_keys", "keys"))
    return exact.select("n_rows", F.explode(found).alias("x")).select("x.metric", "n_rows", "x.within")
