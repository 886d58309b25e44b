import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendengine.functions import text as X


def _apply(spark, fn, values):
    rows = spark.createDataFrame([(v,) for v in values], "v string").select(fn("v").alias("o")).collect()
    return [r["o"] for r in rows]


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("  Two Words\t", "two words"),
        ("Drum & Bass, Live!", "drum  bass live"),
        ("San  Juan Hill", "san  juan hill"),
        ("Café Ñandú", "café ñandú"),
        ("Beat💥 n°2?", "beat n2"),
        ("snake_case", "snake_case"),
        ("💥 boom", " boom"),
        ("", ""),
    ],
)
def test_normalize_text(spark, text, wanted):
    assert _apply(spark, X.normalize_text, [text]) == [wanted]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.text(
            st.characters(min_codepoint=1, max_codepoint=0x24F, exclude_characters="\x00İ"), max_size=20
        ),
        min_size=1,
        max_size=20,
    )
)
def test_text_functions_equal_python(spark, values):
    by_python = [re.sub(r"[^\w\s]", "", v.strip().lower()) for v in values]
    assert _apply(spark, X.normalize_text, values) == by_python
    assert _apply(spark, X.norm_key, values) == [" ".join(v.lower().split()) for v in values]


def test_codes_and_lists(spark):
    row = (
        spark.createDataFrame([(" nv ", "  ", ["a", "b"], None)], "s string, b string, l array<string>, n array<string>")
        .select(
            X.state_code("s"),
            X.blank_to_null("b"),
            X.genre_name(F.lit("  Art Rock ")),
            X.join_list("l"),
            X.join_list("n"),
            X.is_null_like(F.lit(" <NA> ")),
            X.is_null_like(F.lit("naive")),
            X.trend_cache_key(F.lit("  Mira   Sol"), F.lit("US-TX"), F.lit("2025-07-09").cast("date")),
        )
        .head()
    )
    assert tuple(row) == ("NV", None, "art rock", "a; b", "", True, False, "mira sol|US-TX|Jul_2025")


def test_white_space_is_that_of_python():
    from trendengine.constants import WHITESPACE_CHARS

    assert set(WHITESPACE_CHARS) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
