"""Mixes sources to target weights by Pareto order sampling, with Spark expressions only.

A document's size is its number of words. Sources have weights and share `BUDGET` times all words; a source's target stops at `MOST` times its
own words, and the excess is shared again by weight until no target is above. Within a source a document's expected copies are the
target by the source's words, times its preference where one is given (again `MOST` at most, the excess shared again).

Whole expected copies are certain. What is left over of them is a document's inclusion probability p for one more copy. Pareto order sampling:
with u uniform on (0, 1), documents are ranked by u / (1 - u) divided by p / (1 - p), smallest first, and those up to a fixed size are
taken. That size is in words: what the source still wants. Documents are taken in their order as long as they fit; then again from those left
over that fit into the gap, `PASSES` times in all; in the last pass a document also counts as fitting if its middle does, i.e. if it brings the source
nearer to its target. So a source misses its target by a part of a document, and only where whole copies cannot come nearer by more. A
document longer than what is wanted gets no more copies. Documents of equal rank go together.

u is a hash of seed, doc_id and text, so runs agree, however rows are dealt to tasks; rows that repeat exactly are taken together.

Scale: the text is read twice at most, to measure and to take. In between there are narrow rows (source, size, u). No source is
sorted or collected: its order is cut by sums per bucket of ranks, 2^20 buckets a source, which tasks combine before the shuffle, and
only the ranks of one bucket of each source go on to the second step. Sources are numbered by ranges, so their number may grow. The driver sees sums.

Nulls: a null text has no words, a null source is a source of its own, the last one, a null or negative preference is 0. A document without words has 0 taken. An empty table or one
without any word has targets of 0. Documents keep all their columns; names that they have already get underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendengine.llm.common import fresh, stored, table

WEIGHTS = (3, 1, 2)
BUDGET, MOST = 1.5, 2.0
SEED = 13
PASSES = 3
#: Bits of a rank, and of a rank within its bucket.
BITS, INSIDE = 48, 28
#: Bits of the hash that make u.
DRAWN = 52
WORD = r"[^\x20\x09-\x0D]++"


def measured(docs: DataFrame, seed: int = SEED, preference: Column | None = None) -> DataFrame:
    """``docs`` with a struct ``mixed``: size, u and preference."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("text")), 256)
    drawn = F.conv(F.substring(digest, 1, DRAWN // 4), 16, 10).cast("long")
    u = (drawn + F.lit(0.5)) / F.lit(float(1 << DRAWN))
    liked = F.lit(1.0) if preference is None else F.greatest(F.coalesce(F.nanvl(preference.cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
    return docs.withColumn(fresh("mixed", docs), F.struct(size.alias("size"), u.alias("u"), liked.alias("liked")))


def _numbered(spark: SparkSession, sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``place``, from 0 in the order of their sources, a null source last. Each range is numbered in a task of its own."""
    ranged = sizes.repartitionByRange(F.asc_nulls_last("source")).withColumn("part", F.spark_partition_id())
    ranged = stored(spark, ranged, "sources-by-range")
    parts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_last("source")))
    return ranged.withColumn("inside", inside).join(parts, "part").select(
        "source", "source_size", (F.col("before") + F.col("inside") - 1).alias("place")
    )


def targets(spark: SparkSession, rows: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size)."""
    sizes = stored(spark, rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = stored(spark, _numbered(spark, sizes).withColumn("weight", weight), "sources")
    whole = budget * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    full, share = 0, 0.0  # sources at their limit; words per unit of weight for the others
    while True:
        above = F.lit(share) * F.col("weight") > F.lit(most) * F.col("source_size")
        at_limit = F.lit(False) if share == 0 else above
        n, held, left = weighed.agg(
            F.count_if(at_limit), F.sum(F.when(at_limit, F.col("source_size"))), F.sum(F.when(~at_limit, F.col("weight")))
        ).first()
        if share and n == full:
            break
        full, held = n, held or 0
        if not left or whole - most * held <= 0:
            break
        share = (whole - most * held) / left
    above = F.lit(share) * F.col("weight") > F.lit(most) * F.col("source_size")
    target = F.when(above, F.lit(most) * F.col("source_size")).otherwise(F.lit(share) * F.col("weight"))
    return weighed.select("source", "source_size", target.alias("target"))


def _by_source(rows: DataFrame, each: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``each`` for their source, null sources included."""
    each = each.withColumnRenamed("source", "_source")
    return rows.join(each, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def rates(spark: SparkSession, rows: DataFrame, goals: DataFrame, most: float = MOST, even: bool = True) -> DataFrame:
    """``goals`` with ``rate``: expected copies of a document by its preference."""
    start = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    if even:  # all preferences are 1
        return goals.withColumn("rate", start)
    known = stored(spark, goals.withColumn("rate", F.lit(0.0)), "rates")
    while True:
        over = F.col("rate") * F.col("liked") >= most
        words = F.col("size") * F.col("liked")
        held = _by_source(rows, known.select("source", "rate")).groupBy("source").agg(
            F.sum(F.when(over, F.col("size"))).alias("held"), F.sum(F.when(~over, words)).alias("free")
        )
        rate = F.try_divide(F.col("target") - most * F.coalesce("held", F.lit(0)), "free")
        # a rate never falls, so the documents at their limit only get more; without any other the last one holds
        again = _by_source(known, held).withColumn("rate", F.greatest("rate", F.coalesce(rate, F.lit(0.0)))).drop("held", "free")
        again = stored(spark, again, "rates")
        changed = _by_source(again, known.select("source", F.col("rate").alias("was"))).where("rate > was * (1 + 1e-12)")
        known = again
        if changed.isEmpty():
            return known


def expected(rows: DataFrame, goals: DataFrame, most: float = MOST) -> DataFrame:
    """``rows`` (source, size, u, liked) with their source's columns and certain copies, probability ``p`` of one more, and ``rank``."""
    m = F.least(F.lit(most), F.col("rate") * F.col("liked"))
    found = _by_source(rows, goals).withColumn("certain", F.floor(m)).withColumn("p", m - F.col("certain"))
    odds = F.try_divide(F.col("u") / (1 - F.col("u")), F.col("p") / (1 - F.col("p")))
    # odds / (1 + odds) keeps the order and lies between 0 and 1
    rank = F.floor(F.least(odds / (1 + odds), F.lit(1 - 2.0**-53)) * F.lit(float(1 << BITS)))
    return found.withColumn("rank", F.when(F.col("p") > 0, rank))


def cut(spark: SparkSession, rows: DataFrame, goals: DataFrame, middle: bool = False) -> DataFrame:
    """(source, cut): ranks up to ``cut`` fit, from rows (source, rank, size) and goals (source, goal).

    A rank fits if its words and those of all smaller ranks are not beyond the goal; with ``middle``, if half of its own are not.
    """
    known = goals.withColumns({"before": F.lit(0).cast("long"), "head": F.lit(0).cast("long")})
    for shift in (INSIDE, 0):
        cells = rows.withColumn("bucket", F.shiftright("rank", shift)).groupBy("source", "bucket").agg(F.sum("size").alias("within"))
        cells = _by_source(cells, known)
        earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        upto = F.col("before") + F.coalesce(F.sum("within").over(earlier), F.lit(0))
        last = cells.withColumn("upto", upto).where("upto <= goal").groupBy("source", "goal").agg(F.max(F.struct("bucket", "upto", "within")).alias("c"))
        known = last.select("source", "goal", F.col("c.upto").alias("before"), F.col("c.bucket").alias("head"), F.col("c.within").alias("own"))
        known = stored(spark, known, "cut")
        if shift:
            known = known.drop("own")
            here = _by_source(rows, known.select("source", "head")).where(F.shiftright("rank", shift) == F.col("head"))
            rows = stored(spark, here.select("source", "rank", "size"), "to-cut")
    own = F.col("own") / 2 if middle else F.col("own")
    fits = F.col("before") + own <= F.col("goal")
    return known.select("source", (F.col("head") - F.when(fits, 0).otherwise(1)).alias("cut"))


def _taken():
    """Whether a row with size and rank was taken in a pass."""
    return F.exists("passes", lambda p: (F.col("size") <= p["longest"]) & (F.col("rank") <= p["cut"]))


def plan(
    spark: SparkSession, rows: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST, even: bool = True
) -> DataFrame:
    """(source, source_size, target, rate, passes) from stored rows (source, size, u, liked); one row per source."""
    goals = rates(spark, rows, targets(spark, rows, weights, budget, most), most, even)
    drawn = expected(rows, goals, most).where("rank IS NOT NULL AND size > 0").select("source", "size", "p", "rank")
    drawn = stored(spark, drawn, "drawn")
    wanted = drawn.groupBy("source").agg(F.round(F.sum(F.col("size") * F.col("p")), 6).alias("goal"))  # alike in any order of sums
    none = F.array().cast("array<struct<longest:double,cut:bigint>>")
    known = stored(spark, _by_source(goals, wanted).fillna(0.0, ["goal"]).withColumn("passes", none), "goals")
    for step in range(PASSES):
        middle = step == PASSES - 1
        longest = F.col("goal") * (2.0 if middle else 1.0)
        open_rows = _by_source(drawn, known.select("source", "passes", "goal")).where(~_taken() & (F.col("size") <= longest))
        open_rows = open_rows.select("source", "rank", "size")
        ends = stored(spark, cut(spark, open_rows, known.select("source", "goal"), middle), "ends")
        had = _by_source(open_rows, ends).where("rank <= cut").groupBy("source").agg(F.sum("size").alias("had"))
        found = _by_source(_by_source(known, ends), had)
        more = F.array(F.struct(longest.alias("longest"), F.coalesce("cut", F.lit(-1)).alias("cut")))
        found = found.withColumn("passes", F.concat("passes", more)).withColumn("goal", F.round(F.col("goal") - F.coalesce("had", F.lit(0)), 6))
        known = stored(spark, found.drop("cut", "had"), "goals")
    return known.drop("goal")


def copies(rows: DataFrame, plan: DataFrame, most: float = MOST) -> DataFrame:
    """``rows`` (with source, size, u, liked) and ``copies``, ``target`` and ``source_size``."""
    found = expected(rows, plan, most)
    more = F.when(F.coalesce(_taken(), F.lit(False)), 1).otherwise(0)
    return found.select(*rows.columns, "source_size", "target", (F.col("certain") + more).cast("int").alias("copies"))


def mix(
    spark: SparkSession, docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST, seed: int = SEED,
    preference: Column | None = None,
) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) that the mix takes, with a struct ``mix`` (size, source_size, target, copies); each row stands for its copies."""
    mixed, out = fresh("mixed", docs), fresh("mix", docs)
    sized = measured(docs, seed, preference)
    narrow = stored(spark, sized.select("source", f"{mixed}.*"), "measured")
    ends = plan(spark, narrow, weights, budget, most, preference is None)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = copies(sized.select(whole.alias("doc"), "source", f"{mixed}.*"), ends, most).where("copies > 0")
    return rows.select("doc.*", F.struct("size", "source_size", "target", "copies").alias(out))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = measured(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    rows = stored(spark, docs.select("doc_id", "source", "mixed.*"), "measured")
    found = copies(rows, plan(spark, rows))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def _passes() -> str:
    """The passes in SQL: open rows and those of them that are taken, per (source, rank, size) with their number."""
    out = []
    for step in range(PASSES):
        here = f"taken{step - 1}"
        rows = "SELECT source, rank, size, n, goal FROM k"
        if step:
            rows = f"""SELECT o.source, o.rank, o.size, o.n, round(o.goal - coalesce(h.had, 0), 6) AS goal FROM open{step - 1} AS o
  LEFT JOIN (SELECT source, sum(size * n) AS had FROM {here} GROUP BY source) AS h ON h.source IS NOT DISTINCT FROM o.source
  WHERE NOT EXISTS (FROM {here} AS b WHERE b.source IS NOT DISTINCT FROM o.source AND b.rank = o.rank AND b.size = o.size)"""
        middle = step == PASSES - 1
        spare = "sum(size * n) OVER (PARTITION BY source, rank) / 2" if middle else "0"
        out.append(f"""open{step} AS MATERIALIZED ({rows}),
taken{step} AS MATERIALIZED (
  SELECT source, rank, size, n FROM open{step} WHERE size <= {2 if middle else 1} * goal
  QUALIFY sum(size * n) OVER (PARTITION BY source ORDER BY rank) - {spare} <= goal)""")
    return ",\n".join(out)


def _union() -> str:
    return " UNION ALL ".join(f"SELECT source, rank, size FROM taken{step}" for step in range(PASSES))


SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(sha256(concat_ws(':', '{SEED}', doc_id::VARCHAR, text)), 1, {DRAWN // 4}))::BIGINT + 0.5::DOUBLE) / {float(1 << DRAWN)!r}::DOUBLE AS u FROM documents),
s AS MATERIALIZED (
  SELECT source, sum(size)::BIGINT AS n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, coalesce(sum(n) OVER before, 0)::DOUBLE AS full_n, sum(w) OVER (ORDER BY n / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS left_w,
    1.5::DOUBLE * sum(n) OVER ()::DOUBLE AS whole
  FROM s WINDOW before AS (ORDER BY n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT (whole - 2.0::DOUBLE * full_n) / left_w AS share FROM o WHERE (whole - 2.0::DOUBLE * full_n) / left_w * w <= 2.0::DOUBLE * n ORDER BY n / w, source NULLS LAST LIMIT 1),
t AS MATERIALIZED (
  SELECT source, n, least(2.0::DOUBLE * n, (SELECT share FROM l) * w) AS target, coalesce(least(2.0::DOUBLE * n, (SELECT share FROM l) * w) / nullif(n, 0)::DOUBLE, 0) AS rate FROM s),
e AS (
  SELECT d.*, t.n, t.target, floor(rate)::BIGINT AS certain, rate - floor(rate) AS p
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS MATERIALIZED (
  SELECT *, CASE WHEN p > 0 THEN floor(least(q / (1 + q), 1 - 2.0::DOUBLE ** -53) * {float(1 << BITS)!r}::DOUBLE)::BIGINT END AS rank
  FROM (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM e)),
g AS (SELECT source, round(sum(size * p), 6) AS goal FROM r WHERE p > 0 AND size > 0 GROUP BY source),
k AS MATERIALIZED (
  SELECT r.source, rank, size, count(*) AS n, any_value(goal) AS goal FROM r JOIN g ON r.source IS NOT DISTINCT FROM g.source
  WHERE p > 0 AND size > 0 GROUP BY r.source, rank, size),
{_passes()},
x AS MATERIALIZED ({_union()})
SELECT r.doc_id, r.size, r.n AS source_size, r.target, ((r.certain + CASE WHEN x.rank IS NULL THEN 0 ELSE 1 END) * r.size)::BIGINT AS taken
FROM r LEFT JOIN x ON x.source IS NOT DISTINCT FROM r.source AND x.rank = r.rank AND x.size = r.size
"""
