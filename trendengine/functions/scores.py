"""Column expressions for dates and scores. Malformed text becomes null, also in ANSI mode."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendengine.constants import SCORE_MAX, SCORE_MIN


def to_day(c) -> Column:
    """``2026-02-05`` or ``2026_02_05`` as a date; any other spelling is null.

    The cast alone takes looser spellings, so the date must print as the text it came from.
    Both together cost half of parsing with a pattern.
    """
    text = F.trim(F.replace(c, F.lit("_"), F.lit("-")))
    day = text.try_cast("date")
    return F.when(day.cast("string") == text, day)


def to_score(c) -> Column:
    return c.try_cast("double")


def is_missing(score: Column) -> Column:
    return score.isNull() | F.isnan(score)


def is_out_of_range(score: Column) -> Column:
    """Missing scores count as out of range."""
    return is_missing(score) | ~score.between(SCORE_MIN, SCORE_MAX)


def clip(score: Column) -> Column:
    """Score limited to the valid range, 0 where missing."""
    bounded = F.least(F.lit(SCORE_MAX), F.greatest(F.lit(SCORE_MIN), score))
    return F.when(is_missing(score), F.lit(SCORE_MIN)).otherwise(bounded)


def last_complete_month(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of the calendar month before ``as_of``."""
    end = as_of.replace(day=1) - dt.timedelta(days=1)
    return end.replace(day=1), end


def last_days(as_of: dt.date, days: int = 14) -> tuple[dt.date, dt.date]:
    """The ``days`` days that end the day before ``as_of``."""
    return as_of - dt.timedelta(days=days), as_of - dt.timedelta(days=1)


def within(c: Column, span: tuple[dt.date, dt.date]) -> Column:
    """Literal bounds, so that the test reaches the scan."""
    return c.between(F.lit(span[0]), F.lit(span[1]))
