"""Near-duplicate vectors through a robust-pruned flat graph, built on overlapping cluster shards.

1. Vectors of one label with one direction, digit by digit, become one row with their number. What is compared from here on are distinct vectors.
2. Shards. Labels (and dimensions) are nodes; a node with over `SHARD` rows is split by pivots, level by level. Pivots come from
   a sample of `SAMPLE` rows of the node, thinned so that no two are within `APART`: a dense knot gets one pivot and stays together.
   Each vector is at home with its nearest pivot and a guest with the next `OVERLAP - 1`, so both sides of a border see a link; a
   pivot too far off to be the nearest of any vector that it links with is no host. Guests of a split shard get one place less.
   Shards without a home vector are dropped.
3. Build. Each shard builds a graph in two rounds: greedy searches from the medoid gather candidates, robust pruning
   keeps at most `DEGREE` edges per vector that no kept edge makes superfluous, reverse edges are added and pruned again.
4. Union. The adjacency lists that a vector got in its shards are joined into one list.
5. Search. Home vectors of a shard search its part of the joined graph from the medoid, greedily with a beam, then expand from each
   hit along edges through everything within `SLACK` below the threshold, until no more comes in range. In every shard samples of
   `AUDIT` searches, of its largest knot and of all others, are audited against all its members, query by query; a recall below
   `RECALL` widens the beam of these queries and searches again, up to the whole shard; where that is not enough either, and where a
   vector does not even meet itself, queries are compared with all members.
6. Verify. Only cosines of at least `LEAST` in double precision count.

Shards that pivots can no longer split (one knot) are cut into blocks of `SHARD` members with a graph each, and blocks of queries
meet blocks of members in separate tasks: counting the links of all vectors is work of that order, but no task grows, and
each task returns one row per query and a spanning forest of its links, never pairs.

n_links counts a vector's own finds, copies included. A link whose two ends have no shard in common is missed; tests measure
recall against all pairs. Vectors that are null, zero, or hold null or non-finite components link with nothing, as do rows with a null
label or vec_id; the latter have a null component_id. Rows that repeat are vectors of their own. Float components are
compared as doubles.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendengine.llm.common import stored, table
from trendengine.llm.graph import components

LEAST, SLACK = 0.98, 0.03
SHARD, SAMPLE, PIVOTS, OVERLAP, LEVELS = 1024, 512, 64, 3, 16
APART = 0.9
CHUNK = 8192
DEGREE, BEAM, ALPHA = 24, 24, 1.2
AUDIT, RECALL = 64, 0.99
ROWS = "node string, home boolean, rep long, copies long, vec binary"


# --- numpy, inside of tasks: rows of ``v`` are unit vectors ---------------------------------------


def _rows(cells):
    """A matrix from blobs of doubles."""
    import numpy as np

    return np.frombuffer(b"".join(cells), dtype="<f8").reshape(len(cells), -1)


def medoid(v) -> int:
    import numpy as np

    return int(np.argmax(v @ v.mean(axis=0)))


def greedy(queries, v, edges, beam: int):
    """(ids, cosines) of the best ``beam`` vectors that a greedy search from the medoid meets, for all queries at once.

    ``edges``: a row of neighbours per vector, filled up with -1. Ids are -1 where a search met fewer.
    """
    import numpy as np

    q, start = len(queries), medoid(v)
    ids = np.full((q, beam), -1)
    cos = np.full((q, beam), -np.inf, dtype=v.dtype)
    done = np.ones((q, beam), dtype=bool)
    ids[:, 0], cos[:, 0], done[:, 0] = start, queries @ v[start], False
    met = np.zeros((q, len(v)), dtype=bool)
    met[:, start] = True
    live = np.arange(q)
    while len(live):
        at = np.argmax(np.where(done[live], -np.inf, cos[live]), axis=1)
        done[live, at] = True
        near = edges[ids[live, at]]
        fresh = (near >= 0) & ~met[live[:, None], near]
        row, col = np.nonzero(fresh)
        found = near[row, col]
        met[live[row], found] = True
        near_cos = np.full(near.shape, -np.inf, dtype=v.dtype)
        near_cos[row, col] = np.einsum("ij,ij->i", queries[live[row]], v[found])
        all_ids = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
        all_cos = np.concatenate([cos[live], near_cos], axis=1)
        all_done = np.concatenate([done[live], ~fresh], axis=1)
        best = np.argpartition(-all_cos, beam - 1, axis=1)[:, :beam]
        ids[live] = np.take_along_axis(all_ids, best, axis=1)
        cos[live] = np.take_along_axis(all_cos, best, axis=1)
        done[live] = np.take_along_axis(all_done, best, axis=1)
        live = live[~done[live].all(axis=1)]
    return ids, cos


def prune(v, ids, alpha: float):
    """Robust pruning of candidates ``ids`` (a row per vector, -1 for none): rows of at most DEGREE edges."""
    import numpy as np

    m, width = ids.shape
    out = np.full((m, DEGREE), -1)
    for at in range(0, m, 256):
        some = ids[at : at + 256]
        near = v[some]
        far = 1 - (near @ v[at : at + 256, :, None])[:, :, 0]
        far[(some < 0) | (some == np.arange(at, at + len(some))[:, None])] = np.inf
        order = np.argsort(far, axis=1, kind="stable")
        some, far = np.take_along_axis(some, order, axis=1), np.take_along_axis(far, order, axis=1)
        near = near[np.arange(len(near))[:, None], order]
        far[:, 1:][some[:, 1:] == some[:, :-1]] = np.inf  # met twice
        between = 1 - near @ near.transpose(0, 2, 1)
        rows = np.arange(len(some))
        for k in range(DEGREE):
            first = np.argmin(far, axis=1)
            good = np.isfinite(far[rows, first])
            if not good.any():
                break
            out[at + rows[good], k] = some[rows[good], first[good]]
            covered = alpha * between[rows, first] <= far
            far[covered & good[:, None]] = np.inf
            far[rows, first] = np.inf
    return out


def _with_reverse(edges, width: int):
    """Each row's edges and the vectors that point at it, at most ``width`` of each."""
    import numpy as np

    m = len(edges)
    source, target = np.repeat(np.arange(m), edges.shape[1]), edges.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    rank = np.arange(len(target)) - np.searchsorted(target, target)
    keep = rank < width
    back = np.full((m, width), -1)
    back[target[keep], rank[keep]] = source[keep]
    return np.concatenate([edges, back], axis=1)


def build(v):
    """Edges (rows of at most DEGREE, -1 for none) of the pruned graph over unit vectors ``v``."""
    import numpy as np

    m = len(v)
    v = v.astype(np.float32)
    edges = np.random.default_rng(m).integers(0, m, (m, min(DEGREE, 12))) if m > 1 else np.full((m, 1), -1)
    for alpha in (1.0, ALPHA):
        ids, _ = greedy(v, v, edges, BEAM)
        edges = prune(v, np.concatenate([ids, edges], axis=1), alpha)
        edges = prune(v, _with_reverse(edges, 2 * DEGREE), alpha)
    return edges


def in_range(queries, v, edges, beam: int):
    """(query, vector) index pairs of cosine LEAST or more met by searches: a beam, then everything around its hits."""
    import numpy as np

    ids, cos = greedy(queries.astype(np.float32), v.astype(np.float32), edges, beam)
    met = np.zeros((len(queries), len(v)), dtype=bool)
    hit = np.zeros_like(met)
    q, k = np.nonzero((ids >= 0) & (cos >= LEAST - SLACK))
    x = ids[q, k]
    met[q, x] = True
    while len(q):
        exact = np.concatenate([np.einsum("ij,ij->i", queries[q[i : i + 65536]], v[x[i : i + 65536]]) for i in range(0, len(q), 65536)])
        hit[q, x] = exact >= LEAST
        near = exact >= LEAST - SLACK
        q, x = q[near], x[near]
        fresh = np.zeros_like(met)
        for i in range(0, len(q), 65536):
            step = edges[x[i : i + 65536]]
            row, col = np.nonzero(step >= 0)
            fresh[q[i : i + 65536][row], step[row, col]] = True
        fresh &= ~met
        met |= fresh
        q, x = np.nonzero(fresh)
    return np.nonzero(hit)


def audited(queries, v, edges, own=None):
    """`in_range` with beams that find RECALL of what a sample of queries links with, as the mean over the queries of the sample.

    Queries with over half as many hits as the best one (a knot) and all others are audited and searched again apart, so the links
    of a knot do not hide what others miss. ``own``: where each query lies among ``v``, -1 for nowhere; a query that does not meet
    itself went astray and is compared with all.
    """
    import numpy as np

    hit = np.zeros((len(queries), len(v)), dtype=bool)
    hit[in_range(queries, v, edges, min(BEAM, len(v)))] = True
    found = hit.sum(axis=1)
    many = 2 * found > found.max(initial=0)
    for part in filter(len, (np.flatnonzero(many), np.flatnonzero(~many))):
        beam = min(BEAM, len(v))
        sample = part[np.unique(np.linspace(0, len(part) - 1, min(AUDIT, len(part))).astype(int))]
        truth = _compared(queries[sample], v)
        while np.mean((hit[sample] & truth).sum(axis=1) / np.maximum(1, truth.sum(axis=1)) + ~truth.any(axis=1)) < RECALL:
            if beam == len(v):  # the graph falls apart
                hit[part] = _compared(queries[part], v)
                break
            beam = min(4 * beam, len(v))
            q, x = in_range(queries[part], v, edges, beam)
            hit[part[q], x] = True
    if own is not None:
        astray = np.flatnonzero((own >= 0) & ~hit[np.arange(len(queries)), own])
        hit[astray] = _compared(queries[astray], v)
    return np.nonzero(hit)


def _compared(queries, v):
    """Which pairs link, without a graph; what is near LEAST is computed as in `in_range`."""
    import numpy as np

    hit = queries @ v.T >= LEAST - 1e-9
    q, x = np.nonzero(hit)
    for i in range(0, len(q), 65536):
        some = slice(i, i + 65536)
        hit[q[some], x[some]] = np.einsum("ij,ij->i", queries[q[some]], v[x[some]]) >= LEAST
    return hit


# --- Spark --------------------------------------------------------------------------------------


def cells(vectors: DataFrame) -> DataFrame:
    """(vec_id, node, vec) of each row: node is label and dimension, vec the unit vector as doubles; both null where the
    row can have no links."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            nodes, blobs = [], []
            for vec_id, label, cell in zip(*(c.to_pylist() for c in batch.columns)):
                blob = None
                if vec_id is not None and label is not None and cell and None not in cell:
                    x = np.array(cell, dtype="<f8")
                    if np.isfinite(x).all() and x.any():
                        x /= np.abs(x).max()  # so that no square overflows or vanishes
                        blob = (x / np.linalg.norm(x) + 0.0).tobytes()  # -0 is 0
                blobs.append(blob)
                nodes.append(None if blob is None else f"{len(cell)}:{label}")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.string()), pa.array(blobs, pa.binary())], ["vec_id", "node", "vec"]
            )

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
    return rows.mapInArrow(run, "vec_id long, node string, vec binary")


def _pivots(nodes: DataFrame, large: DataFrame) -> DataFrame:
    """(node, vecs, k): the k pivots of each large node, from its SAMPLE rows with the smallest hashes."""
    first = Window.partitionBy("node").orderBy(F.xxhash64("rep"), "rep")
    sample = nodes.join(large, "node", "left_semi").select("node", "rep", "vec")
    sample = sample.withColumn("k", F.row_number().over(first)).where(F.col("k") <= SAMPLE).drop("k")

    def thin(group):
        import numpy as np
        import pyarrow as pa

        v, kept = _rows(group["vec"].to_pylist()), []
        for i in range(len(v)):
            if len(kept) < PIVOTS and (not kept or (v[kept] @ v[i]).max() < APART):
                kept.append(i)
        node = group["node"][0].as_py()
        return pa.table({"node": [node], "vecs": pa.array([np.ascontiguousarray(v[kept]).tobytes()], pa.binary()), "k": pa.array([len(kept)], pa.int32())})

    return sample.groupBy("node").applyInArrow(thin, "node string, vecs binary, k int")


def _assign(nodes: DataFrame, pivots: DataFrame, large: DataFrame) -> DataFrame:
    """Rows of split nodes below their nearest pivots: chunks of a node, each with a copy of its pivots."""
    salt = large.select("node", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    rows = nodes.join(salt.join(pivots.select("node"), "node", "left_semi"), "node").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")).drop("chunks")
    copies = pivots.join(salt, "node").select("node", "vecs", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))

    def nearest(left, right):
        import numpy as np
        import pyarrow as pa

        if not left.num_rows:
            return left.select(["node", "home", "rep", "copies", "vec"])
        v = _rows(left["vec"].to_pylist())
        p = np.frombuffer(right["vecs"][0].as_py(), dtype="<f8").reshape(-1, v.shape[1])
        angle = np.arccos(np.clip(v @ p.T, -1, 1))
        order = np.argsort(angle, axis=1, kind="stable")[:, :OVERLAP]
        angle = np.take_along_axis(angle, order, axis=1)
        resident = left["home"].to_numpy()
        useful = angle <= angle[:, :1] + 2 * np.arccos(LEAST)
        useful &= np.arange(order.shape[1]) < np.where(resident, OVERLAP, OVERLAP - 1)[:, None]
        row, col = np.nonzero(useful)
        taken, node = left.take(pa.array(row)), left["node"][0].as_py()
        home = resident[row] & (col == 0)
        below = [f"{node}/{x}" for x in order[row, col]]
        return pa.table({"node": below, "home": home, "rep": taken["rep"], "copies": taken["copies"], "vec": taken["vec"]})

    return rows.groupBy("node", "chunk").cogroup(copies.groupBy("node", "chunk")).applyInArrow(nearest, ROWS)


def shards(spark: SparkSession, reps: DataFrame) -> DataFrame:
    """(node, block, blocks, home, rep, copies, vec): rows of the final nodes, dealt to blocks of about SHARD rows."""
    nodes = stored(spark, reps.withColumn("home", F.lit(True)).select("node", "home", "rep", "copies", "vec"), "nodes")
    done = None
    for level in range(LEVELS + 1):
        sizes = nodes.groupBy("node").agg(F.count("*").alias("n"), F.max("home").alias("home")).where("home").drop("home")
        sizes = stored(spark, sizes, "sizes")
        large = sizes.where(F.col("n") > SHARD)
        split = stored(spark, _pivots(nodes, large).where(F.col("k") >= 2 * OVERLAP), "pivots") if level < LEVELS else None
        if split is None or split.isEmpty():
            final = nodes.join(sizes, "node")
        else:
            final = nodes.join(sizes, "node").join(split.select("node"), "node", "left_anti")
        blocks = F.ceil(F.col("n") / (1.25 * SHARD)).cast("int")
        final = final.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).drop("n")
        done = final if done is None else done.unionByName(final)
        if split is None or split.isEmpty():
            return done
        nodes = stored(spark, _assign(nodes, split, large), "nodes")


def find_links(spark: SparkSession, reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((rep, n): linked vectors in other rows of ``reps``, with copies; (a, b): links that connect all that are linked)."""
    dealt = stored(spark, shards(spark, reps), "shards")

    def adjacency(group):
        import pyarrow as pa

        rep = group["rep"].to_numpy()
        edges = build(_rows(group["vec"].to_pylist()))
        lists = [rep[row[row >= 0]].tolist() for row in edges]
        return pa.table({"rep": rep, "near": pa.array(lists, pa.list_(pa.int64()))})

    built = dealt.groupBy("node", "block").applyInArrow(adjacency, "rep long, near array<long>")
    joined = built.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))  # DEGREE per shard at most
    joined = stored(spark, joined, "adjacency")  # read twice below, built once
    rows = dealt.join(joined, "rep")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    members = rows.select("node", "block", others.alias("asking"), F.lit(False).alias("query"), "rep", "copies", "vec", "near")
    queries = rows.where("home").select(
        "node", others.alias("block"), F.col("block").alias("asking"), F.lit(True).alias("query"), "rep", "copies", "vec", F.lit(None).cast("array<long>").alias("near")
    )

    def search(group):
        import numpy as np
        import pyarrow as pa

        asks = group["query"].to_numpy(zero_copy_only=False)
        rep, copies = group["rep"].to_numpy(), group["copies"].to_numpy()
        out = {"rep": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "other": pa.array([], pa.int64())}
        if not asks.any() or asks.all():
            return pa.table(out)
        unit = _rows(group["vec"].to_pylist())
        v, queries, ids, q_ids = unit[~asks], unit[asks], rep[~asks], rep[asks]
        order = np.argsort(ids)
        near = group["near"].filter(pa.array(~asks)).combine_chunks()
        flat, ends = near.flatten().to_numpy(), np.cumsum(near.value_lengths().to_numpy())
        row = np.repeat(np.arange(len(v)), np.diff(ends, prepend=0))
        place = np.searchsorted(ids, flat, sorter=order).clip(0, len(v) - 1)
        here = ids[order[place]] == flat
        row, target = row[here], order[place[here]]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        edges = np.full((len(v), max(1, int(rank.max(initial=0)) + 1)), -1)
        edges[row, rank] = target
        at = order[np.searchsorted(ids, q_ids, sorter=order).clip(0, len(v) - 1)]
        q, x = audited(queries, v, edges, np.where(ids[at] == q_ids, at, -1))
        apart = q_ids[q] != ids[x]
        q, x = q[apart], x[apart]
        n = np.bincount(q, weights=copies[~asks][x], minlength=len(queries)).astype(np.int64)
        # a spanning forest of the links of this task: at most one row per vector
        every, place = np.unique(np.concatenate([q_ids, ids]), return_inverse=True)
        label, a, b = np.arange(len(every)), place[: len(q_ids)][q], place[len(q_ids) :][x]
        while True:
            low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
            if (low == high).all():
                break
            np.minimum.at(label, high, low)
            while (label != label[label]).any():
                label = label[label]
        hung = np.flatnonzero(label != np.arange(len(every)))
        return pa.table(
            {
                "rep": np.concatenate([q_ids[n > 0], every[hung]]),
                "n": np.concatenate([n[n > 0], np.zeros(len(hung), dtype=np.int64)]),
                "other": pa.array([None] * int((n > 0).sum()) + every[label[hung]].tolist(), pa.int64()),
            }
        )

    found = members.unionByName(queries).groupBy("node", "block", "asking").applyInArrow(search, "rep long, n long, other long")
    found = stored(spark, found, "links-found")
    counts = found.where("other IS NULL").groupBy("rep").agg(F.sum("n").alias("n"))
    return counts, found.where("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b"))


def near_duplicates(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label)."""
    rows = stored(spark, cells(vectors), "vectors")
    reps = rows.where("vec IS NOT NULL").groupBy("node", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = stored(spark, reps, "distinct-vectors")
    counts, links = find_links(spark, reps)
    roots = components(spark, links).select(F.col("node").alias("rep"), "root")
    judged = reps.join(counts, "rep", "left").join(roots, "rep", "left")
    judged = judged.select(
        "node", "vec", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id")
    )
    return rows.join(judged, ["node", "vec"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "embeddings"))
