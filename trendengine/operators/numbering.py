"""Dense numbers and ranks over a whole table without sorting it in one task.

A window without partition columns moves every row to one task. Here rows are put
into buckets by the leading bits of an integer code that follows the wanted order,
counted per bucket, and numbered inside of their bucket; the counts of the earlier
buckets are then added. Buckets are computed from the row alone, so a recomputed task
puts every row where it was before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# 2^16 consecutive codes form a bucket and 2^24 buckets a block. The one window over all
# blocks sees at most 2^23 rows of two numbers, whatever the table holds.
BUCKET_BITS, BLOCK_BITS = 16, 24


def _sum_before(n: str, partition, order: str):
    earlier = W.partitionBy(partition).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(earlier), F.lit(0))


def counts_before(cells: DataFrame, code: str, n: str, out: str) -> DataFrame:
    """For each code the sum of ``n`` over all smaller codes. One row per code expected."""
    block = F.shiftright(F.col(code), BLOCK_BITS)
    # Stating the null test of the join here leaves both uses of the cells alike, so that
    # Spark computes them once.
    cells = cells.select(code, n, block.alias("_block")).where(F.col("_block").isNotNull())
    totals = cells.groupBy("_block").agg(F.sum(n).alias("_n"))
    blocks = totals.select("_block", _sum_before("_n", F.lit(0), "_block").alias("_earlier"))
    return (
        cells.withColumn("_inside", _sum_before(n, "_block", code))
        .join(blocks, "_block")
        .select(code, (F.col("_earlier") + F.col("_inside")).alias(out))
    )


def number_rows(df: DataFrame, seq: str, tie: list[str], out: str) -> DataFrame:
    """Dense numbers from 1 in (seq, tie) order.

    ``seq`` is an integer that few rows share, such as the position of a row in its input.
    """
    bucket = F.shiftright(F.col(seq), BUCKET_BITS)
    rows = df.withColumn("_bucket", bucket).where(F.col("_bucket").isNotNull())
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts_before(counts, "_bucket", "_n", "_offset")
    order = W.partitionBy("_bucket").orderBy(seq, *tie)
    return (
        rows.withColumn("_place", F.row_number().over(order))
        .join(offsets, "_bucket")
        .withColumn(out, (F.col("_offset") + F.col("_place")).cast("long"))
        .drop("_bucket", "_place", "_offset")
    )

