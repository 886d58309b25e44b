"""SimHash near-duplicates through a hierarchical index over fingerprints in Gray order.

Fingerprints are 64 bits over 3-word shingles. Two link when they differ in at most ``MOST`` = 2 bits.

The index. Its upper nodes are masked bit patterns: the 64 bits are cut into three parts, and fingerprints with 2
differing bits at most agree on one part, so each fingerprint hangs below three nodes (mask, pattern) and every link
lies below a common node. A node with more than ``NODE_ROWS`` fingerprints is cut the same way along its remaining bits,
again without losing a link; as fingerprints are distinct, nodes get small enough before the bits run out. No
bucket is capped. Below a node, fingerprints are sorted by Gray rank, runs of ``FANOUT`` share a node that holds the bits
common to all of them, and runs of such nodes share a parent, up to the masked pattern. All nodes of a task are one tree that is
descended at once, whatever their size; a pair of nodes is given up with all below it as soon as the differences gathered on the way
down exceed ``MOST``.

Scale. Equal fingerprints are one row before anything is compared. Nodes hand on a spanning forest of their links, at most
one row per fingerprint, instead of pairs; `graph.components` joins the forests.

Nulls: a null or blank text has fingerprint zero. Rows without doc_id keep their fingerprint, link with nothing and
have a null component_id. Rows that share a doc_id count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendengine.llm.common import ASCII_LOWER, any_columns, stored, table, utf8
from trendengine.llm.graph import components

MOST = 2
SHINGLE = 3
SEED = 42
NODE_ROWS = 4096
FANOUT = 16
ONES = (1 << 64) - 1


def fingerprint(text: bytes | None) -> int:
    """Unsigned fingerprint of UTF-8 text: a bit is set if it is set in over half of the shingle hashes."""
    import numpy as np
    import xxhash

    words = text.translate(ASCII_LOWER).split() if text else []
    if not words:
        return 0
    joined, width = b" ".join(words), min(SHINGLE, len(words))
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[: len(words) - width])]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :])], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for each row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fps = np.array([fingerprint(x) for x in utf8(batch.column(1))], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, fp long")


def _parts(mask: int) -> list[int]:
    """The masks below ``mask``: each adds a third of the bits that it leaves free."""
    free = [i for i in range(64) if not mask >> i & 1]
    n, k = len(free), MOST + 1
    return [mask | sum(1 << i for i in free[n * j // k : n * (j + 1) // k]) for j in range(k)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _below(df: DataFrame, masks: list[int]) -> DataFrame:
    """Rows (fp, doc) under mask ``mask`` hung below the masks that refine it."""
    children = F.lit(None).cast("array<long>")
    for m in masks:
        children = F.when(F.col("mask") == _signed(m), F.array(*(F.lit(_signed(c)) for c in _parts(m)))).otherwise(children)
    return (
        df.select("fp", "doc", F.explode(children).alias("mask"))
        .withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))
        .select("mask", "pattern", "fp", "doc")
    )


def gray_rank(x):
    """Position of codewords (numpy, unsigned) in the Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> x.dtype.type(shift))
    return x


def _levels(x, group):
    """The tree, leaves first: per level (bits shared below each node, their values, first child, number of children).

    Leaves are fingerprints, sorted by group and Gray rank. Runs of FANOUT nodes of a group share a parent, until each group is one node.
    """
    import numpy as np

    levels = [(np.full(len(x), ONES, dtype=np.uint64), x, None, None)]
    while True:
        mask, pattern, *_ = levels[-1]
        new = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, dtype=bool)
        if len(levels) > 1 and new.all():
            return levels
        start = np.flatnonzero(new)
        place = np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))
        at = np.flatnonzero(place % FANOUT == 0)
        ones = np.bitwise_and.reduceat(pattern & mask, at)
        zeros = np.bitwise_and.reduceat(~pattern & mask, at)
        levels.append((ones | zeros, ones, at, np.diff(np.append(at, len(group)))))
        group = group[at]


def _close_below(x, group=None):
    """Index pairs (i < j) within a group of ``x`` that differ in MOST bits at most; x is sorted by group, then in Gray order.

    In blocks, by descent from the pair of each group with itself. On the way down the differing bits among those that both nodes share add up,
    each bit once; pairs of nodes beyond MOST are given up with all below them.
    """
    import numpy as np

    if not len(x):
        return
    levels = _levels(x, np.zeros(len(x), dtype=np.int64) if group is None else group)
    top = len(levels) - 1
    i = np.arange(len(levels[top][0]))
    todo = [(top, i, i, np.zeros(len(i), dtype=np.int64), np.zeros(len(i), dtype=np.uint64))]
    while todo:
        level, i, j, gathered, seen = todo.pop()
        mask, pattern, first, children = levels[level]
        shared = mask[i] & mask[j]
        gathered = gathered + np.bitwise_count((pattern[i] ^ pattern[j]) & shared & ~seen)
        keep = gathered <= MOST
        i, j, gathered, seen = i[keep], j[keep], gathered[keep], (shared | seen)[keep]
        if level == 0:
            yield i, j
            continue
        for at in range(0, len(i), 4096):
            part = slice(at, at + 4096)
            wide = children[j[part]]
            pairs = children[i[part]] * wide
            each = np.repeat(np.arange(len(pairs)), pairs)
            place = np.arange(len(each)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            a = first[i[part]][each] + place // wide[each]
            b = first[j[part]][each] + place % wide[each]
            keep = (a < b) if level == 1 else (a <= b)
            todo.append((level - 1, a[keep], b[keep], gathered[part][each][keep], seen[part][each][keep]))


def _hang(label, i, j):
    """Join the trees in ``label`` (a root per index) along the links i-j; roots are the smallest indices."""
    import numpy as np

    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label = label[label]


def _forest(group, fp, doc):
    """(doc, doc of its root) below the nodes numbered by ``group``; rows are sorted by group and Gray rank."""
    import numpy as np

    label = np.arange(len(fp))
    for i, j in _close_below(fp, group):
        label = _hang(label, i, j)
    linked = label != np.arange(len(fp))
    return doc[linked], doc[label[linked]]


def _linked(nodes: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of the links below each node. A task holds a few thousand rows at a time."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def solve(mask, pattern, fp, doc):
            order = np.lexsort((gray_rank(fp.view(np.uint64)), pattern, mask))
            mask, pattern, fp, doc = mask[order], pattern[order], fp[order].view(np.uint64), doc[order]
            new = np.concatenate([[False], (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])])
            a, b = _forest(np.cumsum(new), fp, doc)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        held = [np.empty(0, dtype=np.int64)] * 4
        for batch in batches:
            rows = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)]
            if not len(rows[0]):
                continue
            last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last node may go on in the next batch
            held = [r[cut:] for r in rows]
            if cut:
                yield solve(*(r[:cut] for r in rows))
        if len(held[0]):
            yield solve(*held)

    dealt = nodes.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")
    return dealt.mapInArrow(run, "a long, b long")


def close_links(spark: SparkSession, fps: DataFrame) -> DataFrame:
    """Links (a, b) between the doc of distinct fingerprints (fp, doc) that connect all that differ in MOST bits."""
    nodes = _below(fps.withColumn("mask", F.lit(0).cast("long")), [0])
    masks, found = _parts(0), None
    while True:
        free = 64 - min(m.bit_count() for m in masks)
        if 1 << free <= NODE_ROWS:
            links, hot = _linked(nodes), []
        else:
            large = nodes.groupBy("mask", "pattern").count().where(F.col("count") > NODE_ROWS).drop("count")
            large = stored(spark, large, "large-nodes")
            hot = [r[0] & ONES for r in large.select("mask").distinct().collect()]  # at most 3 to the depth
            links = _linked(nodes.join(large, ["mask", "pattern"], "left_anti") if hot else nodes)
        found = links if found is None else found.union(links)
        if not hot:
            return found
        nodes = _below(nodes.join(large, ["mask", "pattern"], "left_semi"), hot)
        masks = [c for m in hot for c in _parts(m)]


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for each row; component_id is the smallest doc_id reachable by links."""
    signed = stored(spark, fingerprints(docs), "fingerprints")
    fps = stored(spark, signed.dropna(subset=["doc_id"]).groupBy("fp").agg(F.min("doc_id").alias("doc")), "distinct-fps")
    repeated = (  # an id on several rows ties their fingerprints together
        signed.dropna(subset=["doc_id"]).groupBy("doc_id").agg(F.min("fp").alias("f"), F.max("fp").alias("g")).where("f <> g")
    )
    tied = (
        signed.join(repeated.select("doc_id"), "doc_id").join(fps, "fp").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    )
    roots = components(spark, close_links(spark, fps).union(tied))
    whole = fps.join(roots, F.col("doc") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "doc").alias("component_id")
    )
    return signed.join(whole, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


@any_columns("doc_id", "text")
def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The row of the smallest doc_id of each group; rows without doc_id stay. Columns as they come, of any name and type.

    Of several rows with that doc_id, the one first by text hash, then text, then the other columns as JSON, stays.
    """
    groups = near_duplicates(spark, docs.select("doc_id", "text"))
    ids = groups.where("doc_id = component_id").select(F.col("doc_id").alias("kept")).distinct()
    found = docs.where("doc_id IS NOT NULL").join(ids, F.col("doc_id") == F.col("kept"), "left_semi")
    others = [c for c in docs.columns if c.lower() not in ("doc_id", "text")]
    last = F.to_json(F.struct(*others)) if others else F.lit("")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text", last)
    found = found.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place")
    return found.unionByName(docs.where("doc_id IS NULL"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark, table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
