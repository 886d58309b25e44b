"""Column expressions for names, codes and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendengine.constants import LIST_JOINER, NULL_LIKE_TEXT, WHITESPACE, WHITESPACE_CHARS, WORD


def trimmed(c) -> Column:
    return F.trim(c)


def state_code(c) -> Column:
    return F.upper(F.trim(c))


def blank_to_null(c) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def genre_name(c) -> Column:
    """Lower-case genre, null when nothing is left."""
    return F.lower(blank_to_null(c))


def strip_whitespace(c) -> Column:
    """Trim every kind of Unicode white space, where ``F.trim`` removes the space only."""
    return F.btrim(c, F.lit(WHITESPACE_CHARS))


def normalize_text(c) -> Column:
    """Lower-case text without punctuation, symbols and emoji; inner spaces stay.

    The ends are trimmed before symbols go, so a symbol at an end can leave a space.
    """
    return F.regexp_replace(F.lower(strip_whitespace(c)), f"[^{WORD}{WHITESPACE}]+", "")


def norm_key(c) -> Column:
    """Lower-case name with each run of white space as one space.

    Single spaces, the usual case, are no match and stay where they are.
    """
    runs = f"[{WHITESPACE}]{{2,}}|[{WHITESPACE}&&[^ ]]"
    return F.regexp_replace(F.lower(strip_whitespace(c)), runs, " ")


def month_label(day) -> Column:
    return F.date_format(day, "MMM_yyyy")


def trend_cache_key(artist, geo, day) -> Column:
    return F.concat_ws("|", norm_key(artist), geo, month_label(day))


def join_list(c) -> Column:
    """A list as one text; a missing list as empty text."""
    return F.coalesce(F.array_join(c, LIST_JOINER), F.lit(""))


def is_null_like(c) -> Column:
    """Null, blank, or a word that stands for a missing value."""
    return c.isNull() | F.lower(F.trim(c)).isin(NULL_LIKE_TEXT)
