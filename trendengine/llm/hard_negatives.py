"""Hard negatives of anchors: one-bit codes of rotated vectors give certain intervals, integers decide.

Vectors become integers (`integer_vectors`); the score of two is their integer inner product. For each anchor the first `POSITIVES`
other rows of its label are its positives (higher score first, then smaller vec_id). For each anchor and positive the first `NEGATIVES` rows of
other labels whose score is 30 % to 90 % of the positive's are its hard negatives.

Codes. A vector, filled up with zeros to a power of two, is rotated (random signs, a Walsh-Hadamard transform). The signs of the
rotated vector are its first code; its alignment with that code (inner product by the dimension) is stored. What the code leaves over
is rotated and coded again, `LEVELS` times, and the length of what is left after each code is stored as well. Anchors go through the same rotations;
at each level they become `PLANES` bit planes, sign codes whose weights are powers of two. The inner product of two codes is the dimension less twice the
popcount of their exclusive or, so alignments and weights times popcounts estimate the score, and by Cauchy-Schwarz the true score is
within |anchor| * left(row) of the estimate, plus what the planes leave over of the anchor times the length of each aligned code. That interval is certain,
not likely. Pairs whose interval after some level lies outside of the wanted band, or below the rows found so far, are given up;
the others are scored in integers. So results do not depend on rotations or codes.

Scale. Anchors are dealt to blocks of `ANCHORS`, rows to stripes of `STRIPE` (`LEAST_STRIPES` at least); each block meets each stripe in one task,
which keeps the best of each anchor and returns those alone. For positives blocks and stripes are made within a label, so a label with most rows is many
tasks. No pairs are stored, and no candidates are capped: a pair is given up only when its interval proves that it cannot count.

Left out: rows whose label, vec_id or vector is null or whose vector has a null or non-finite component or a squared length, in
integers, over 2^59 (a long could not hold scores). Vectors of different lengths have no score and never meet. Of rows that share a vec_id,
the one with the smallest label, then vector, counts. An anchor without positives has no negatives. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendengine.llm.common import stored, table
from trendengine.llm.integer_vectors import SCALE, integer_rows, matrix

POSITIVES, NEGATIVES = 5, 10
LEVELS, PLANES = 6, 8
ANCHORS, STRIPE, LEAST_STRIPES = 8192, 1 << 17, 8
#: Pairs of which a task holds estimates at a time.
PAIRS = 1 << 20
#: Relative room for rounding of doubles, far above what it can be.
ROOM = 1e-9
NONE = -(2**63)
CELL = "vec_id long, label long, size int, vec binary, codes binary, scales binary"


# --- numpy, inside of tasks ------------------------------------------------------------------------


def spread(x):
    """Integer rows ``x`` as doubles, filled up with zeros to a power of two, 64 at least."""
    import numpy as np

    out = np.zeros((len(x), max(64, 1 << max(0, x.shape[1] - 1).bit_length())))
    out[:, : x.shape[1]] = x
    return out


def rotate(x, level: int):
    """Rows of ``x``, a power of two wide, rotated as before the code of a level. Lengths stay."""
    import numpy as np

    size = x.shape[1]
    out = x * (np.random.default_rng((size, level)).integers(0, 2, size) * 2.0 - 1)
    step = 1
    while step < size:
        pairs = out.reshape(len(x), -1, 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), size)
        step *= 2
    return out / np.sqrt(size)


def _length(x):
    import numpy as np

    return np.sqrt((x * x).sum(axis=1))


def _words(bits):
    import numpy as np

    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def encode(x):
    """(codes, scales) of integer rows: a code of 64-bit words per level; alignments and lengths left over per level, own length."""
    import numpy as np

    rest = spread(x)
    own, codes, along, left = _length(rest), [], [], []
    for level in range(LEVELS):
        rest = rotate(rest, level)
        sign = np.where(rest >= 0, 1.0, -1.0)
        along.append((rest * sign).sum(axis=1) / rest.shape[1])
        rest = rest - along[-1][:, None] * sign
        codes.append(_words(sign > 0))
        left.append(_length(rest))
    return np.stack(codes, axis=1), np.stack([*along, *left, own], axis=1)


def planes(x):
    """(codes, weights, lengths left over) of integer rows at each level: `PLANES` bit planes of the rotated row.

    The planes' weights are 1, 2, 4... times that of the first one.
    """
    import numpy as np

    turned, codes, weights, left = spread(x), [], [], []
    for level in range(LEVELS):
        turned = rotate(turned, level)
        widest = np.abs(turned).max(axis=1)
        weight = np.where(widest > 0, widest, 1.0) / 2**PLANES
        cell = np.clip(np.floor(turned / (2 * weight[:, None])), -(2 ** (PLANES - 1)), 2 ** (PLANES - 1) - 1)
        left.append(_length(turned - weight[:, None] * (2 * cell + 1)))
        cell = (cell + 2 ** (PLANES - 1)).astype(np.int64)
        codes.append(np.stack([_words(cell >> m & 1 == 1) for m in range(PLANES)], axis=1))
        weights.append(weight)
    return np.stack(codes, axis=1), np.stack(weights, axis=1), np.stack(left, axis=1)


class Rows:
    """Rows of a task: ids, labels, integers and codes."""

    def __init__(self, rows):
        import numpy as np

        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.vectors = matrix(rows["vec"].to_pylist())
        self.codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), dtype="<u8").reshape(len(self.ids), LEVELS, -1)
        scales = np.frombuffer(b"".join(rows["scales"].to_pylist()), dtype="<f8").reshape(len(self.ids), -1)
        self.along, self.left, self.own = scales[:, :LEVELS], scales[:, LEVELS:-1], scales[:, -1]


class Anchors:
    """Anchors of a task: ids, labels, integers and bit planes."""

    def __init__(self, rows):
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.vectors = matrix(rows["vec"].to_pylist())
        self.planes, self.weight, self.left = planes(self.vectors)
        self.own = _length(self.vectors.astype(float))


def interval(asked: Anchors, rows: Rows, a, x, level: int, before, unsure):
    """(estimate, doubt of the planes, half width) of the scores of anchors ``a`` and rows ``x`` (index arrays that broadcast).

    ``before`` and ``unsure`` are estimate and doubt with the codes below ``level``.
    """
    import numpy as np

    size = 64 * rows.codes.shape[2]
    apart = np.zeros(np.broadcast(a, x).shape, dtype=np.int64)
    for m in range(PLANES):
        apart += np.bitwise_count(asked.planes[a, level, m] ^ rows.codes[x, level]).sum(axis=-1, dtype=np.int64) << m
    along = rows.along[x, level]
    estimate = before + along * asked.weight[a, level] * (size * (2**PLANES - 1) - 2 * apart)
    unsure = unsure + along * asked.left[a, level] * np.sqrt(size)
    return estimate, unsure, asked.own[a] * (rows.left[x, level] + ROOM * rows.own[x]) + unsure


def best_rows(asked: Anchors, rows: Rows, low, high, k: int, same: bool):
    """(ids, scores), each anchors x bands x k, of the best rows per anchor and band; NONE as score where there are fewer.

    ``low`` and ``high`` (anchors x bands) are the scores that a band allows; ``same`` asks for rows of the anchor's label and another vec_id,
    else rows of other labels.
    """
    import numpy as np

    n, bands = low.shape
    ids = np.full((n, bands, k), np.iinfo(np.int64).max)
    scores = np.full((n, bands, k), NONE)
    width = max(1, min(256, len(rows.ids)))
    tall = max(1, PAIRS // width)
    for first in range(0, len(rows.ids), width):
        x = np.arange(first, min(first + width, len(rows.ids)))
        for top in range(0, n, tall):
            a = np.arange(top, min(top + tall, n))
            need = np.maximum(low[a], scores[a, :, -1]).min(axis=1).astype(float)
            most = high[a].max(axis=1).astype(float)
            apart = asked.labels[a][:, None] != rows.labels[x][None, :]
            wanted = ~apart & (asked.ids[a][:, None] != rows.ids[x][None, :]) if same else apart
            estimate, unsure, half = interval(asked, rows, a[:, None], x[None, :], 0, 0.0, 0.0)
            i, j = np.nonzero(wanted & (estimate + half >= need[:, None]) & (estimate - half <= most[:, None]))
            estimate, unsure = estimate[i, j], unsure[i, j]
            for level in range(1, LEVELS):
                estimate, unsure, half = interval(asked, rows, a[i], x[j], level, estimate, unsure)
                stay = (estimate + half >= need[i]) & (estimate - half <= most[i])
                i, j, estimate, unsure = i[stay], j[stay], estimate[stay], unsure[stay]
            for part in range(0, len(i), PAIRS // 8):
                some = slice(part, part + PAIRS // 8)
                exact = np.einsum("ij,ij->i", asked.vectors[a[i[some]]], rows.vectors[x[j[some]]])
                _enter(ids, scores, a[i[some]], rows.ids[x[j[some]]], exact, low, high)
    return ids, scores


def _enter(ids, scores, a, found, exact, low, high):
    """Puts scored rows ``found`` of anchors ``a`` among the best of each band."""
    import numpy as np

    k = ids.shape[2]
    for band in range(ids.shape[1]):
        fits = (exact >= low[a, band]) & (exact <= high[a, band]) & (exact >= scores[a, band, -1])
        if not fits.any():
            continue
        met = np.unique(a[fits])
        who = np.concatenate([np.repeat(met, k), a[fits]])
        every = np.concatenate([scores[met, band].ravel(), exact[fits]])
        which = np.concatenate([ids[met, band].ravel(), found[fits]])
        order = np.lexsort((which, ~every, who))  # ~s is -s - 1, so higher scores come first
        who, every, which = who[order], every[order], which[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        first = rank < k
        scores[who[first], band, rank[first]] = every[first]
        ids[who[first], band, rank[first]] = which[first]


# --- Spark --------------------------------------------------------------------------------------


def cells(vectors: DataFrame) -> DataFrame:
    """`CELL` of the rows that take part, before rows that share a vec_id are told apart."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at, x in integer_rows(batch.column(2)):
                codes, scales = encode(x)
                blobs = [[row.tobytes() for row in m] for m in (x.astype("<i4"), codes.astype("<u8"), scales.astype("<f8"))]
                own = batch.select([0, 1]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array([x.shape[1]] * len(at), pa.int32()), *(pa.array(b, pa.binary()) for b in blobs)],
                    ["vec_id", "label", "size", "vec", "codes", "scales"],
                )

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    return rows.dropna(subset=["vec_id", "label"]).mapInArrow(run, CELL)


def one_per_id(rows: DataFrame) -> DataFrame:
    """Of rows that share a vec_id, the first by label, then vector. Only such rows are shuffled."""
    shared = rows.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id")
    first = Window.partitionBy("vec_id").orderBy("label", "vec")
    repeated = rows.join(shared, "vec_id", "left_semi").withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")
    return rows.join(shared, "vec_id", "left_anti").unionByName(repeated)


def _met(rows: DataFrame, asked: DataFrame, key: list[str], search, schema: str) -> DataFrame:
    """``search`` over each block of anchors and each stripe of rows with equal ``key``."""
    n = asked.groupBy(*key).agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("blocks"))
    n = n.join(rows.groupBy(*key).agg(F.greatest(F.lit(LEAST_STRIPES), F.ceil(F.count("*") / STRIPE)).cast("int").alias("stripes")), key)
    asked = asked.toDF(*asked.columns)  # columns of their own: anchors are rows as well
    spread = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda c: F.pmod(F.xxhash64("vec_id"), F.col(c)).cast("int")
    left = asked.join(n, key).withColumns({"block": own("blocks"), "stripe": spread("stripes")}).drop("blocks", "stripes")
    right = rows.join(n, key).withColumns({"block": spread("blocks"), "stripe": own("stripes")}).drop("blocks", "stripes")
    place = [*key, "block", "stripe"]
    return left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(search, schema)


def positives(rows: DataFrame, asked: DataFrame, k: int = POSITIVES) -> DataFrame:
    """(anchor_id, positive_id, positive_score, place): the first k other rows of each anchor's label."""

    def search(left, right):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        anchors, others = Anchors(left), Rows(right)
        free = np.full((left.num_rows, 1), NONE)
        ids, scores = best_rows(anchors, others, free, ~free, k, same=True)
        a, _, place = np.nonzero(scores > NONE)
        return pa.table([anchors.ids[a], ids[a, 0, place], scores[a, 0, place]], schema=schema)

    found = _met(rows, asked, ["size", "label"], search, "anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")  # k rows per stripe
    return found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)


def mine(spark: SparkSession, vectors: DataFrame, anchor, k: int = NEGATIVES, n_positives: int = POSITIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (vec_id, label, embedding).

    ``anchor`` is a condition on vec_id.
    """
    rows = stored(spark, one_per_id(stored(spark, cells(vectors), "coded-vectors")), "distinct-ids")
    asked = rows.where(anchor)
    pairs = stored(spark, positives(rows, asked, n_positives), "positives")
    place = F.struct("place", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))
    listed = pairs.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(place)).alias("positives"))

    def search(left, right):
        import numpy as np
        import pyarrow as pa

        names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
        schema = pa.schema([(name, pa.int64()) for name in names])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        anchors, others = Anchors(left), Rows(right)
        listed = left["positives"].combine_chunks()
        at = np.repeat(np.arange(len(listed)), listed.value_lengths().to_numpy())
        flat = listed.flatten()
        band, ids, scores = (flat.field(name).to_numpy() for name in ("place", "id", "score"))
        low, high = np.ones((2, left.num_rows, n_positives), dtype=np.int64)
        high[:] = NONE  # no score is allowed where there is no positive
        positive_id, positive = np.zeros_like(low), np.zeros_like(low)
        positive_id[at, band - 1], positive[at, band - 1] = ids, scores
        low[at, band - 1], high[at, band - 1] = -(-3 * scores // 10), 9 * scores // 10
        ids, scores = best_rows(anchors, others, low, high, k, same=False)
        a, band, place = np.nonzero(scores > NONE)
        return pa.table(
            [anchors.ids[a], positive_id[a, band], positive[a, band], ids[a, band, place], scores[a, band, place]], schema=schema
        )

    found = _met(
        rows, asked.join(listed, "vec_id"), ["size"], search,
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")  # k rows per stripe
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows with a vec_id divisible by 100; every seventh row has a wrong label."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark, rows.withColumn("label", wrong), F.col("vec_id") % 100 == 0)


SQL = f"""
WITH r AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])), 0)::BIGINT AS score
  FROM r AS a JOIN r AS b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= {NEGATIVES}
"""
