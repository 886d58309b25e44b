"""Centroid clustering in exact integers: assignment by a tournament of bisectors, means by floor division.

Vectors become integers (`integer_vectors`). For each pair i < j of centroids the bisector is an integer normal c_j - c_i and an integer
threshold |c_j|^2 - |c_i|^2: x is nearer to j just when 2 x (c_j - c_i) exceeds the threshold. A vector's champion starts as
centroid 0 and meets 1, 2, ... k - 1 in turn: k - 1 linear sign tests, where zero favours the smaller number, leave the nearest centroid, ties
to the smaller number. Only the distance to the champion is computed, exactly.

A round is one pass over the stored integers. Tasks add up their vectors per cluster, so a cluster with most of all rows
arrives as one row per task and component; the driver sees k centroids and nothing else. What is broadcast is k vectors; a task derives
the k(k - 1) / 2 normals from them, i.e. 8 bytes times half of k squared times the dimension.

Start: the k kept vectors with the smallest SHA-256 of ``<seed>:<vec_id>`` (hex, ascending), equal ones by their components. Fewer kept
vectors give as many centroids; none, an empty result. An empty cluster keeps its centroid. Kept are vectors with exactly ``dimension``
components, none null or non-finite, whose integers have a squared length of 2^59 at most (beyond, a long cannot hold distances); a null
vector is not kept. Rows with a null vec_id are kept and count, but start no cluster. Repeated rows count as often as they come. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendengine.llm.common import stored, table
from trendengine.llm.integer_vectors import SCALE, integer_rows, matrix

CLUSTERS, ROUNDS, SEED, DIMENSION = 40, 5, 2, 64
#: Vectors that meet a bisector at a time.
AT_ONCE = 4096


class Bisectors:
    """Normals and thresholds of all pairs, as a block of the smaller numbers for each larger one."""

    def __init__(self, centroids):
        import numpy as np

        self.centroids = np.asarray(centroids, dtype=np.int64)
        squares = (self.centroids**2).sum(axis=1)
        self.normals = [c - self.centroids[:j] for j, c in enumerate(self.centroids)]
        self.thresholds = [s - squares[:j] for j, s in enumerate(squares)]

    def nearest(self, x):
        """(number of the nearest centroid, squared distance to it) for each row of the integer matrix ``x``."""
        import numpy as np

        champion = np.zeros(len(x), dtype=np.int64)
        for at in range(0, len(x), AT_ONCE):
            some, best = x[at : at + AT_ONCE], champion[at : at + AT_ONCE]
            for j in range(1, len(self.centroids)):
                side = 2 * np.einsum("ij,ij->i", some, self.normals[j][best]) - self.thresholds[j][best]
                best[side > 0] = j
        apart = x - self.centroids[champion]
        return champion, np.einsum("ij,ij->i", apart, apart)


def cells(vectors: DataFrame, dimension: int = DIMENSION) -> DataFrame:
    """(vec_id, vec) of the kept rows, vec as 32-bit integers."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at, x in integer_rows(batch.column(1), dimension):
                blobs = [row.tobytes() for row in x.astype("<i4")]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(blobs, pa.binary())], ["vec_id", "vec"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, vec binary")


def first_centroids(rows: DataFrame, k: int, seed: int):
    """The k starting vectors; the driver sees k rows."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id IS NOT NULL").select(draw.alias("draw"), "vec").orderBy("draw", "vec").limit(k)
    return matrix([bytes(r["vec"]) for r in first.collect()])


def moved(spark: SparkSession, rows: DataFrame, centroids):
    """The centroids after one round."""
    sent = spark.sparkContext.broadcast(centroids)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        bisectors = Bisectors(sent.value)
        k, d = bisectors.centroids.shape
        sums, counts = np.zeros((k, d), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0).to_pylist())
                cluster, _ = bisectors.nearest(x)
                np.add.at(sums, cluster, x)
                counts += np.bincount(cluster, minlength=k)
        met = np.flatnonzero(counts)
        whole = np.concatenate([counts[met, None], sums[met]], axis=1)  # the count, then the sums
        place = np.tile(np.arange(d + 1), len(met))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(met, d + 1)), pa.array(place), pa.array(whole.ravel())], ["cluster", "place", "total"]
        )

    found = rows.select("vec").mapInArrow(run, "cluster long, place long, total long")
    totals = found.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    by_place = {(r["cluster"], r["place"]): int(r["total"]) for r in totals.collect()}  # k times dimension + 1 numbers
    after = centroids.copy()
    for cluster, place in by_place:
        if place:
            after[cluster, place - 1] = by_place[cluster, place] // by_place[cluster, 0]
    return after


def assign(spark: SparkSession, rows: DataFrame, centroids) -> DataFrame:
    """(vec_id, cluster, distance) of each kept row."""
    sent = spark.sparkContext.broadcast(centroids)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        bisectors = Bisectors(sent.value)
        for batch in batches:
            if batch.num_rows:
                cluster, distance = bisectors.nearest(matrix(batch.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"]
                )

    return rows.select("vec_id", "vec").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(spark: SparkSession, vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimension: int = DIMENSION):
    """((vec_id, cluster, distance) of each kept vector, the final centroids as an integer matrix)."""
    rows = stored(spark, cells(vectors, dimension), "integer-vectors")
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return assign(spark, rows.where("false"), centroids), centroids
    for _ in range(rounds):
        centroids = moved(spark, rows, centroids)
    return assign(spark, rows, centroids), centroids


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with their cluster; inertias beyond a long are null."""
    import hashlib

    found, centroids = cluster(spark, table(spark, sf_dir, "embeddings"))
    found = stored(spark, found, "clusters")
    text = [",".join(map(str, c)) for c in centroids.tolist()]
    digests = [(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(text)]
    digests = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")  # k rows
    inner = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))  # k rows
    whole = inner.agg(F.sum("s")).scalar()
    each = inner.join(digests, "cluster").select(
        "cluster", F.col("s").try_cast("long").alias("cluster_inertia"), whole.try_cast("long").alias("inertia"), "centroid_sha256"
    )
    return found.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    apart = "list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSION} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k, v AS c FROM kept WHERE vec_id IS NOT NULL
  QUALIFY row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) <= {CLUSTERS})""",
    ]
    for n in range(ROUNDS + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT row, vec_id, v, min({{'d': {apart}::BIGINT, 'k': k}}) AS best FROM kept, c{n} GROUP BY ALL)""")
        if n < ROUNDS:
            steps.append(f"""m{n} AS (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
  FROM (SELECT best.k AS k, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{n}, range(1, 65) AS r(i) GROUP BY ALL) GROUP BY k),
c{n + 1} AS MATERIALIZED (
  SELECT k, list_transform(coalesce(m{n}.c, c{n}.c), lambda x: x::BIGINT) AS c FROM c{n} LEFT JOIN m{n} USING (k))""")
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance, sum(best.d) OVER (PARTITION BY best.k)::BIGINT AS cluster_inertia,
  sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c{ROUNDS}.c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} ON c{ROUNDS}.k = best.k
"""


SQL = _sql()
