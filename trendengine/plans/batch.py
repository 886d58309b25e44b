"""A whole batch: raw file to cleaned table, dimensions and facts.

The cleaned Parquet table is the point where lineage ends: it is written once from the raw
text, and every later step reads the columns it needs from it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession

from trendengine.constants import CLEANED_STEM
from trendengine.operators import analytics, dedup, dims
from trendengine.operators.clean import clean
from trendengine.operators.enrich import staging_rows
from trendengine.operators.explode import explode_genres
from trendengine.session import remove_folder
from trendengine.sinks.bulk_load import bulk_load
from trendengine.sinks.writers import append_rows, init_table, write_partitioned
from trendengine.sources.batches import latest_with_file, resolve_input
from trendengine.sources.readers import read_cleaned, read_dim, read_raw_csv, with_file_order

SEQ, POS = "ingest_seq", "genre_pos"


def clean_trends(raw: DataFrame) -> DataFrame:
    """Raw rows to clean rows, one per genre, with the place of each genre in its row."""
    return explode_genres(clean(raw), position=POS)


def observed_trends(raw: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The same rows, and a function that gives their counts once the rows were written."""
    first, second = Observation(), Observation()
    rows = explode_genres(clean(raw, first), second, position=POS)
    return rows, lambda: {**first.get, **second.get}


def genre_facts(raw: DataFrame) -> DataFrame:
    """Raw rows to the genre fact: clean, explode, remove duplicates, aggregate."""
    return analytics.fact_genre_trends(dedup.first_scores(clean_trends(raw), SEQ))


def transform_batch(
    spark: SparkSession, out_root: str, root: str | None = None, override: str | None = None,
    files_per_month: int | None = None,
) -> tuple[str, dict[str, int]]:
    """Write one cleaned batch; returns its path and the counts.

    The counts are taken while writing, so the text is read once: they sit in the stage that ends
    the job, where a repeated task is counted once. With ``files_per_month`` the rows are written beside the
    table first, then shuffled from there: typed rows are read twice, the text is not.
    """
    path, batch_date = resolve_input(spark, root, override)
    raw = with_file_order(read_raw_csv(spark, path))
    rows, counts = observed_trends(raw)
    if not files_per_month:
        return write_partitioned(rows, out_root, batch_date), counts()
    staged = f"{out_root.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    again = spark.read.schema(rows.schema).parquet(staged)
    written = write_partitioned(again, out_root, batch_date, files_per_month)
    remove_folder(spark, staged)
    return written, counts()


def refresh_dim(
    spark: SparkSession, cleaned: DataFrame, root: str, dim: dims.Dimension, fmt: str = "parquet"
) -> None:
    """Append what is new in a cleaned batch to one dimension under ``root``."""
    path = f"{root.rstrip('/')}/{dim.name}"
    init_table(spark, path, dim.schema, fmt)
    known = read_dim(spark, path, dim.schema, fmt)
    # New keys are few; written down, the clean table is scanned once and not per use of them.
    staged = f"{root.rstrip('/')}/_staged-{dim.name}-{uuid.uuid4().hex}"
    missing = dim.missing_keys(cleaned, known, seq=SEQ, pos=POS)
    missing.write.parquet(staged)
    keys = spark.read.schema(missing.schema).parquet(staged)
    if not keys.isEmpty():
        append_rows(dim.number(keys, known), path, dim.id_col, fmt)
    remove_folder(spark, staged)


def refresh_dims(spark: SparkSession, cleaned: DataFrame, root: str, fmt: str = "parquet") -> None:
    """All three dimensions. They do not depend on each other, so their jobs share the cluster."""
    with ThreadPoolExecutor(len(dims.DIMENSIONS)) as pool:
        jobs = [pool.submit(refresh_dim, spark, cleaned, root, dim, fmt) for dim in dims.DIMENSIONS]
    for job in jobs:
        job.result()


def stage_rows(cleaned: DataFrame) -> DataFrame | None:
    """Warehouse rows of a cleaned batch, or nothing when there are none."""
    rows = staging_rows(cleaned)
    return None if rows.isEmpty() else rows


def latest_cleaned(spark: SparkSession, out_root: str) -> tuple[str, str]:
    """Path and batch date of the newest cleaned batch."""
    found = latest_with_file(spark, out_root, CLEANED_STEM, "")
    if found is None:
        raise FileNotFoundError(f"no cleaned batch under {out_root}")
    return found


def load_batch(spark: SparkSession, out_root: str, sink: Callable[[DataFrame], None]) -> str | None:
    """Hand the warehouse rows of the newest cleaned batch to ``sink``; the batch date, or none if it has no rows."""
    path, batch_date = latest_cleaned(spark, out_root)
    rows = stage_rows(read_cleaned(spark, path))
    if rows is None:
        return None
    sink(rows)
    return batch_date


def load_batch_files(spark: SparkSession, out_root: str, path: str) -> str | None:
    """`load_batch` as files that the warehouse copies in: the batch is published by one manifest, and a second run replaces it."""
    batch_date = latest_cleaned(spark, out_root)[1]
    return load_batch(spark, out_root, lambda rows: bulk_load(rows, path, batch_date))
