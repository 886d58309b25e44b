"""Joins of many rows against a smaller table, safe against one key with very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendengine.session import scratch_path

#: Rows of one key that one task may take.
HOT_ROWS = 1_000_000
#: Cells that keys are counted in first, by their hash. A cell holds the rows of a hot key and a share of the others.
CELLS = 1 << 16


def hot_keys(rows: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of tasks to spread them over.

    Rows are counted in `CELLS` cells first, of which each task sends a number or none. Only keys in cells of more than ``hot_rows`` rows,
    where a hot key must lie, are counted one by one, combined before they are shuffled. There are at most rows / hot_rows hot keys; they
    are written to the shared folder, so that Spark knows their size when it plans the joins with them.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "hot-keys")
    cell = F.pmod(F.xxhash64(*keys), F.lit(CELLS)).cast("int")
    full = rows.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    rows = rows.where(cell.isin([r["_cell"] for r in full.collect()]))  # CELLS numbers at most
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = counts.select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_tasks"))
    hot.write.parquet(path)
    return spark.read.schema(hot.schema).parquet(path)


def spread_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Equi-join in which the rows of keys with very many rows go to several tasks.

    For use with lookups that come out of an aggregate: adaptive execution splits skewed joins of tables, but not those.
    Keys are counted first. Where none is hot, this is a plain join. Else the rows of hot keys get a salt from a
    hash of all their columns, which a repeated task reproduces (equal rows share one), and the lookup rows of these keys, no
    others, are laid down once per salt.
    """
    hot = hot_keys(rows, keys, hot_rows)
    if hot.isEmpty():
        return rows.join(lookup, keys, how)
    tasks = F.coalesce("_tasks", F.lit(1))
    salted = rows.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), tasks).cast("int"))
    copies = lookup.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), tasks - 1)))
    joined = salted.drop("_tasks").join(copies.drop("_tasks"), [*keys, "_salt"], how)
    if how in ("left_semi", "left_anti"):
        return joined.select(*rows.columns)
    return joined.drop("_salt")
