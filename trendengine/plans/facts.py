"""Facts kept up to date batch by batch.

``<root>/partials/batch=<b>/year=…/month=…`` holds the cells (count, sum, maximum) of one batch, ``<root>/cells/year=…/month=…`` those of all.
A batch replaces its own partial cells, then the months that it touches, now or before, are merged anew from the partial cells of
these months and replaced by dynamic partition overwrite. Other months are neither read nor written, and a batch that comes twice counts once.

Rows of a batch must be new keys, as `streaming.dedup_landed` leaves them: cells count each row.
The touched months are noted before anything is replaced, so a run after a crash merges them as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendengine.operators import analytics
from trendengine.session import remove_folder
from trendengine.sinks.writers import add_partition_cols
from trendengine.sources.batches import folder_names
from trendengine.sources.readers import empty_table

CELL = ["genres", "location", "date"]
MONTH = ["year", "month"]
_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
CELL_SCHEMA = T.StructType(
    [T.StructField(*f) for f in (("genres", _S), ("location", _S), ("date", T.DateType()), ("n", _L), ("s", _D), ("m", _D), ("year", _I), ("month", _I))]
)
PARTIAL_SCHEMA = T.StructType([*CELL_SCHEMA.fields, T.StructField("batch", _S)])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if folder_names(spark, path) else empty_table(spark, schema)


def _months(df: DataFrame) -> set[tuple[int, int]]:
    """The months of a table, as many as the calendar has."""
    return {(r["year"], r["month"]) for r in df.select(*MONTH).distinct().collect()}


def _in(months: set[tuple[int, int]]):
    found = F.lit(False)
    for year, month in sorted(months):
        found = found | ((F.col("year") == year) & (F.col("month") == month))
    return found


def update_facts(spark: SparkSession, rows: DataFrame, root: str, batch: str) -> set[tuple[int, int]]:
    """Take the rows of a batch into the stored cells; the months that were merged."""
    partials, part, noted = f"{root}/partials", f"{root}/partials/batch={batch}", f"{root}/touched/batch={batch}"
    staged = f"{root}/_staged-{batch}"
    add_partition_cols(analytics.trend_cells(rows, *CELL)).write.mode("overwrite").parquet(staged)
    new = spark.read.schema(CELL_SCHEMA).parquet(staged)
    earlier = _read(spark, partials, PARTIAL_SCHEMA).where(F.col("batch") == batch)
    crashed = _read(spark, noted, CELL_SCHEMA) if folder_names(spark, noted) else None
    months = _months(new) | _months(earlier) | (_months(crashed) if crashed is not None else set())
    if not months:
        remove_folder(spark, staged)
        return months
    spark.createDataFrame(sorted(months), "year int, month int").write.mode("overwrite").parquet(noted)
    new.write.mode("overwrite").partitionBy(*MONTH).parquet(part)
    merged = analytics.merged_cells(_read(spark, partials, PARTIAL_SCHEMA).where(_in(months)), *CELL, *MONTH)
    merged = merged.select(*CELL_SCHEMA.fieldNames())
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH).parquet(f"{root}/cells")
    for year, month in months - _months(_read(spark, partials, PARTIAL_SCHEMA).where(_in(months))):  # no batch has rows there any more
        remove_folder(spark, f"{root}/cells/year={year}/month={month}")
    remove_folder(spark, noted)
    remove_folder(spark, staged)
    return months


def read_cells(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/cells", CELL_SCHEMA)


def genre_fact(spark: SparkSession, root: str) -> DataFrame:
    """The genre fact over all batches."""
    return analytics.genre_fact_of(read_cells(spark, root))


def rollups(spark: SparkSession, root: str) -> DataFrame:
    """Totals by genre, location, both and overall over all batches."""
    return analytics.rollups_of(read_cells(spark, root))
