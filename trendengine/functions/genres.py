"""Column expressions for multi-valued genre text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendengine.constants import (
    ALT_DELIMITERS,
    DELIMITER,
    LINE_SPACE,
    TOKEN_WRAPPERS,
    UNKNOWN_GENRE,
)


def fill_unknown(c) -> Column:
    return F.coalesce(c, F.lit(UNKNOWN_GENRE))


def unify_delimiters(c) -> Column:
    """Every delimiter spelled ``;``, by plain replacement, which costs less than a regex."""
    for alternative in ALT_DELIMITERS:
        c = F.replace(c, F.lit(alternative), F.lit(DELIMITER))
    return c


def genre_list(unified: Column) -> Column:
    """Text as an array: a JSON list where it is one, else the parts between delimiters.

    Delimiters are unified before, so a list of several items is no longer JSON and takes
    the second way; brackets and quotes then go with :func:`clean_token`. A quote followed by
    a delimiter gives such lists away, and spares the failed parse.
    """
    core = F.btrim(unified, F.lit(LINE_SPACE))
    quoted = F.replace(unified, F.lit("'"), F.lit('"'))
    several = quoted.contains(f'"{DELIMITER}') & ~quoted.contains("\\")
    may_be_json = unified.contains("[") & core.startswith("[") & core.endswith("]") & ~several
    as_json = F.when(may_be_json, F.from_json(quoted, "array<string>"))
    return F.coalesce(as_json, F.split(unified, DELIMITER))


def clean_token(c) -> Column:
    """Lower-case token without the quotes, brackets and spaces around it."""
    return F.lower(F.btrim(c, F.lit(TOKEN_WRAPPERS)))


def is_token(c: Column) -> Column:
    return c.isNotNull() & (c != "")
