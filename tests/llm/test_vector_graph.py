"""Graph search for near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from trendengine.llm import vector_graph as g

SCHEMA = "vec_id long, embedding array<float>, label int, node string, rep int"


def all_pairs(rows):
    """(links by place, smallest vec_id reachable) of rows (vec_id, embedding, label)."""
    ok = [i for i, (vid, e, lab) in enumerate(rows) if vid is not None and lab is not None and e and None not in e and np.isfinite(e).all() and np.any(e)]
    root, links = {i: i for i in range(len(rows))}, {i: set() for i in range(len(rows))}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for kind in {(rows[i][2], len(rows[i][1])) for i in ok}:
        part = [i for i in ok if (rows[i][2], len(rows[i][1])) == kind]
        v = np.array([np.float32(rows[i][1]) for i in part], dtype=np.float64)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(v @ v.T >= g.LEAST)):
            if a != b:
                links[part[a]].add(part[b])
                x, y = sorted((top(part[a]), top(part[b])), key=lambda i: rows[i][0])
                root[y] = x
    low = {}
    for i in ok:
        low[top(i)] = min(low.get(top(i), rows[i][0]), rows[i][0])
    return links, [low.get(top(i), rows[i][0]) for i in range(len(rows))]


def judged(spark, rows):
    """(what the operator returns, what all pairs say), each by vec_id."""
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in g.near_duplicates(spark, frame).collect() if r.vec_id is not None)
    links, roots = all_pairs(rows)
    want = sorted((vid, len(links[i]), roots[i], vid == roots[i]) for i, (vid, _, _) in enumerate(rows) if vid is not None)
    return got, want


def compare(spark, rows, exact=True):
    got, want = judged(spark, rows)
    if exact:
        assert got == want
    return sum(r[1] for r in got), sum(r[1] for r in want), [r[2] for r in got] == [r[2] for r in want]


def cloud(rng, n, d=32, knots=((40, 0.1),)):
    """Random directions, and knots of (number, spread) around some of them."""
    v = [rng.normal(size=(n, d))]
    for size, spread in knots:
        v.append(v[0][0] * 0 + rng.normal(size=d) + spread * rng.normal(size=(size, d)))
    return np.concatenate(v).astype(np.float32)


def test_search_in_one_shard_finds_all_and_prunes():
    rng = np.random.default_rng(1)
    v = cloud(rng, 500, knots=((150, 0.1), (60, 0.12))).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    edges = g.build(v)
    assert edges.shape[1] <= g.DEGREE and not any(i in row for i, row in enumerate(edges))
    q, x = g.in_range(v, v, edges, g.BEAM)
    truth = v @ v.T >= g.LEAST
    assert all(truth[q, x]) and len(q) >= 0.98 * truth.sum()
    q, x = g.audited(v, v, edges)
    assert len(q) >= 0.99 * truth.sum()


def unit(v):
    return v / np.linalg.norm(v, axis=1, keepdims=True)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_knot_does_not_hide_pairs_from_the_audit(seed):
    rng = np.random.default_rng(seed)
    single = rng.normal(size=(150, 32))
    v = unit(np.concatenate([rng.normal(size=32) + 0.08 * rng.normal(size=(700, 32)), single, single + 0.08 * rng.normal(size=(150, 32))]))
    truth, hit = v @ v.T >= g.LEAST, np.zeros((1000, 1000), dtype=bool)
    hit[g.audited(v, v, g.build(v), np.arange(1000))] = True
    recall = (hit & truth).sum(axis=1) / truth.sum(axis=1)
    assert not (hit & ~truth).any()
    assert recall[:700].mean() >= 0.99 and recall[700:].mean() >= 0.99


def test_queries_that_the_graph_fails_are_compared_with_all():
    rng = np.random.default_rng(4)
    single = rng.normal(size=(20, 32))
    v = unit(np.concatenate([rng.normal(size=32) + 0.08 * rng.normal(size=(200, 32)), single, single]))
    edges = np.full((240, 2), -1)
    edges[:200, 0], edges[:200, 1] = (np.arange(200) + 1) % 200, (np.arange(200) - 1) % 200  # nothing leads out of the knot
    hit = np.zeros((240, 240), dtype=bool)
    hit[g.audited(v, v, edges, np.arange(240))] = True
    assert (hit == (v @ v.T >= g.LEAST)).all()


def test_given_table_with_near_copies_is_all_pairs(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rng = np.random.default_rng(3)
    for k, (_, e, label) in enumerate(rows[:300] + rows[:60]):
        spread = rng.choice([0.0, 0.1, 0.18, 0.22]) * np.linalg.norm(e) / len(e) ** 0.5
        rows.append((10_000 + k, [float(x) for x in np.float32(e + spread * rng.normal(size=len(e)))], label))
    found, wanted, same = compare(spark, rows, exact=False)
    assert 0.99 * wanted <= found <= wanted and found > 0
    assert same


@pytest.mark.parametrize("knots", [((30, 0.05), (30, 0.1)), ((700, 0.08),)])
def test_recall_over_several_shards_and_blocks(spark, monkeypatch, knots):
    for name, value in (("SHARD", 128), ("SAMPLE", 100), ("CHUNK", 200)):
        monkeypatch.setattr(g, name, value)
    rng = np.random.default_rng(2)
    base = cloud(rng, 600, knots=knots)
    near = base[:200] + 0.08 * rng.normal(size=(200, 32)).astype(np.float32)
    rows = [(int(i), [float(x) for x in v], i % 1) for i, v in enumerate(np.concatenate([base, near, base[:5], base[:5]]))]
    got, want = judged(spark, rows)
    recall = [n / m for (_, n, _, _), (_, m, _, _) in zip(got, want) if m]
    assert all(n <= m for (_, n, _, _), (_, m, _, _) in zip(got, want))
    assert np.mean(recall) >= 0.99
    assert [r[2:] for r in got] == [r[2:] for r in want]


def test_invalid_vectors_ties_repeats_and_empty(spark):
    one, two = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, one, 1), (2, one, 1), (2, one, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 0.0], 1),
            (8, [float("nan"), 1.0, 0.0], 1), (9, [float("inf"), 0.0, 0.0], 1), (10, [], 1), (11, [2.0, 0.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, two, 1),
            (14, [0.98, 0.198997487, 0.0], 1), (15, [1e-30, 0.0, -0.0], 1), (16, [1e30, 0.0, 0.0], 1), (None, one, 1)]
    compare(spark, rows)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    lone = [r for r in g.near_duplicates(spark, frame).collect() if r.vec_id is None]
    assert [tuple(r) for r in lone] == [(None, 0, None, False)]
    assert g.near_duplicates(spark, frame.where("false")).count() == 0
    assert g.near_duplicates(spark, frame.where("label IS NULL")).count() == 1
