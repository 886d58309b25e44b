"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect
from trendengine.operators import analytics
from trendengine.plans.oracle import ORACLE
from trendengine.plans.queries import REGISTRY

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_each_query_has_a_twin():
    assert REGISTRY.keys() == ORACLE.keys()
    assert REGISTRY.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    assert compare(REGISTRY[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["genres", "location", "date", "avg_score", "max_score", "n_artists"]
    assert df.count() == 668


GOLDEN = {
    "sf0.001": dict(exploded=1450, deduped=1027, groups=668, top=290),
    "sf0.01": dict(exploded=14531, deduped=10260, groups=1358, top=551),
}


@pytest.mark.parametrize("sf", sorted(GOLDEN))
def test_golden_counts(spark, sf):
    q, d = entry.queries(), f"/root/testdata/{sf}"
    stats = q["dedup_stats"](spark, d).head()
    assert (stats["rows_before"], stats["rows_after"]) == (GOLDEN[sf]["exploded"], GOLDEN[sf]["deduped"])
    assert q["fact_genre_trends"](spark, d).count() == GOLDEN[sf]["groups"]
    trends = q["dedup_trends"](spark, d)
    # counted with the previous week on record, however long ago
    assert analytics.rising_artists(trends, across_gaps=True).count() == GOLDEN[sf]["top"] > q["rising_artists"](spark, d).count()
