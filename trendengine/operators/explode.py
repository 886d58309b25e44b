"""One row per genre, and the counts that go with it. All steps are narrow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trendengine.functions import genres as G
from trendengine.operators.clean import clean_conditions, has_keys, type_columns

_LIST, _RESPELLED, _POS, _TOKEN = "_list", "_respelled", "_pos", "_token"


def with_genre_list(df: DataFrame) -> DataFrame:
    unified = G.unify_delimiters(F.col("genres"))
    return df.withColumns(
        {_LIST: G.genre_list(unified), _RESPELLED: F.col("genres") != unified}
    )


def _tokens(listed: DataFrame) -> DataFrame:
    """Outer explode: a row without any token stays visible to the counts.

    It also keeps Spark from testing the list for emptiness first, which would build it twice.
    """
    rows = listed.select("*", F.posexplode_outer(_LIST).alias(_POS, _TOKEN)).drop(_LIST)
    return rows.withColumn(_TOKEN, G.clean_token(F.col(_TOKEN)))


def is_first_token() -> Column:
    """True on one token of each row, for counts of rows."""
    return F.coalesce(F.col(_POS), F.lit(0)) == 0


def explode_measures(kept: Column | None = None) -> list[Column]:
    kept = F.lit(True) if kept is None else kept
    token, listed = G.is_token(F.col(_TOKEN)), F.col(_POS).isNotNull()
    conditions = {
        "genre_delim_replaced": is_first_token() & F.col(_RESPELLED),
        "rows_after_explode": token,
        "dropped_empty_genre": listed & ~token,
        "dropped_empty_list": ~listed,
    }
    return [F.count_if(kept & cond).alias(name) for name, cond in conditions.items()]


def explode_genres(
    df: DataFrame, observation: Observation | None = None, position: str | None = None
) -> DataFrame:
    """One row per genre token in place of the genre text; empty tokens go.

    A genre named twice in one row gives two rows; removing duplicates is a separate step.
    ``position`` names a column to hold the place of the token in its row.
    """
    rows = _tokens(with_genre_list(df))
    if observation is not None:
        rows = rows.observe(observation, *explode_measures())
    place = {position: F.col(_POS)} if position else {}
    kept = rows.where(G.is_token(F.col(_TOKEN))).withColumns({"genres": F.col(_TOKEN), **place})
    return kept.drop(_TOKEN, _POS, _RESPELLED)


def explode_metrics(clean_df: DataFrame) -> DataFrame:
    return _tokens(with_genre_list(clean_df)).agg(*explode_measures())


def run_summary(raw: DataFrame) -> DataFrame:
    """All counts of cleaning and exploding as one row, from one scan and one aggregate."""
    listed = with_genre_list(
        type_columns(raw).withColumn("genres", G.fill_unknown(F.col("genres")))
    )
    # Dropped rows get no tokens but stay, so that one pass sees every row once.
    rows = _tokens(listed.withColumn(_LIST, F.when(has_keys(), F.col(_LIST))))
    return rows.agg(
        *(
            F.count_if(is_first_token() & cond).alias(name)
            for name, cond in clean_conditions().items()
        ),
        *explode_measures(has_keys()),
    )
