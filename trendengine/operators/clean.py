"""Cleaning of raw trend rows and the counts that go with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trendengine.functions import genres as G
from trendengine.functions import scores as S
from trendengine.functions import text as X
from trendengine.schemas import RAW_COLUMNS

REQUIRED = ["id", "location", "date"]


def require_columns(df: DataFrame, columns) -> DataFrame:
    """Fail early when a column is missing; a check of the schema, without a job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def type_columns(df: DataFrame) -> DataFrame:
    """Trimmed text, parsed day, numeric score. Columns beyond the raw six pass through."""
    require_columns(df, RAW_COLUMNS)
    others = [c for c in df.columns if c not in RAW_COLUMNS]
    return df.select(
        X.trimmed("artist").alias("artist"),
        X.trimmed("id").alias("id"),
        X.trimmed("genres").alias("genres"),
        X.state_code("location").alias("location"),
        S.to_day(F.col("date")).alias("date"),
        S.to_score(F.col("trend_score")).alias("trend_score"),
        *others,
    )


def has_keys() -> Column:
    return F.col("id").isNotNull() & F.col("location").isNotNull() & F.col("date").isNotNull()


def has_blank_key() -> Column:
    return (F.col("id") == "") | (F.col("location") == "")


def clean_conditions() -> dict[str, Column]:
    """What is counted over typed rows, before incomplete ones are dropped."""
    return {
        "rows_in": F.lit(True),
        "bad_dates": F.col("date").isNull(),
        "score_out_of_range": S.is_out_of_range(F.col("trend_score")),
        "dropped_missing_id_loc_date": ~has_keys(),
        "blank_keys": has_keys() & has_blank_key(),
    }


def clean_measures() -> list[Column]:
    return [F.count_if(cond).alias(name) for name, cond in clean_conditions().items()]


def finish(typed: DataFrame, complete: Column) -> DataFrame:
    """Complete rows only, genres filled, scores inside the range."""
    return typed.where(complete).withColumns(
        {
            "genres": G.fill_unknown(F.col("genres")),
            "trend_score": S.clip(F.col("trend_score")),
        }
    )


def clean(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Clean trend rows. With an observation the counts are taken in the same pass."""
    require_columns(df, RAW_COLUMNS)
    if observation is not None:
        return finish(type_columns(df).observe(observation, *clean_measures()), has_keys())
    # Trimming makes no nulls, so the keys can be tested as they lie in the source, where the
    # test reaches the scan. Only the day has to be parsed first.
    keyed = df.where(F.col("id").isNotNull() & F.col("location").isNotNull())
    return finish(type_columns(keyed), F.col("date").isNotNull())


def clean_metrics(df: DataFrame) -> DataFrame:
    """The same counts as one row."""
    return type_columns(df).agg(*clean_measures())


def quarantine(df: DataFrame) -> DataFrame:
    """Typed rows that cleaning drops for want of a key."""
    return type_columns(df).where(~has_keys())


def filter_score_range(df: DataFrame) -> DataFrame:
    """Alternative to clipping: rows with a score inside the range only."""
    return df.where(~S.is_out_of_range(F.col("trend_score")))
