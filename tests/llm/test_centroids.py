"""Centroid clustering against SQL and plain integer k-means."""

import hashlib
import math

import numpy as np

from tests.oracle_check import compare, connect
from trendengine.llm import centroids as c

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, vec int"


def plain(rows, k, rounds, seed, dimension):
    """rows: (vec_id, vector) to ([(vec_id, cluster, distance)], centroids)."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v]))
    drawn = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in drawn[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((apart(v, w), j) for j, w in enumerate(cents))
    for _ in range(rounds):
        met = [[v for _, v in kept if near(v)[1] == j] for j in range(len(cents))]
        cents = [[sum(x) // len(m) for x in zip(*m)] if m else w for m, w in zip(met, cents)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept] if cents else [], cents


def test_query_is_the_sql(spark):
    assert compare(c.query(spark, SF), connect(SF), c.SQL) is None


def test_tournament_is_the_nearest_with_ties_to_the_smaller():
    rng = np.random.default_rng(1)
    for k, d, spread in ((1, 3, 2), (2, 1, 2), (7, 2, 3), (40, 5, 4), (40, 64, 300)):
        cents, x = rng.integers(-spread, spread, (k, d)), rng.integers(-spread, spread, (500, d))
        far = ((x[:, None] - cents[None]) ** 2).sum(axis=2)
        best, distance = c.Bisectors(cents).nearest(x)
        assert (best == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def test_ties_nulls_lengths_repeats_and_clashing_names(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) / 4 for x in rng.integers(-3, 4, 3)]) for i in range(60)]
    rows += [(60, None), (61, [0.1, 0.2]), (62, [0.1, None, 0.2]), (63, [0.1, math.nan, 0.2]), (64, [0.1, math.inf, 0.2]), (65, []), (66, [1e200, 0.0, 0.0]),
             (None, [0.5, 0.5, 0.5]), (3, rows[3][1]), (3, rows[3][1]), (67, [0.1, 0.2, 0.3, 0.4]), (68, [-0.0, -1e-9, 1e-9])]
    frame = spark.createDataFrame([(i, v, 1, "x", 7) for i, v in rows], SCHEMA)
    found, cents = c.cluster(spark, frame, k=6, rounds=4, dimension=3)
    wanted, plain_cents = plain([r for r in rows if r[0] != 66], 6, 4, c.SEED, 3)
    key = lambda r: (r[0] is None, *r) if r[0] is not None else (True, -1, *r[1:])
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(wanted, key=key)
    assert cents.tolist() == plain_cents


def test_empty_clusters_keep_their_centroid_and_few_rows_give_few(spark):
    same = [(i, [1.0, 2.0], 0, "x", 0) for i in range(5)] + [(9, [3.0, 2.0], 0, "x", 0)]
    found, cents = c.cluster(spark, spark.createDataFrame(same, SCHEMA), k=40, rounds=3, dimension=2)
    wanted, plain_cents = plain([r[:2] for r in same], 40, 3, c.SEED, 2)
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted) and cents.tolist() == plain_cents and len(cents) == 6


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert c.query(spark, str(tmp_path)).count() == 0
