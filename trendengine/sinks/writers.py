"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trendengine.constants import CLEANED_STEM, RAW_STEM
from trendengine.operators.reshape import parsed_records, rejected_records, unpivot_records, unpivot_trends
from trendengine.schemas import RAW_COLUMNS
from trendengine.sources.readers import CSV_OPTIONS, empty_table, read_json_lines, read_raw_csv


def add_partition_cols(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year("date"), "month": F.month("date")})


def cleaned_path(root: str, batch_date: str, ext: str = "") -> str:
    return f"{root.rstrip('/')}/{batch_date}/{CLEANED_STEM}_{batch_date}{ext}"


def raw_path(root: str, batch_date: str, stem: str = RAW_STEM, ext: str = "csv") -> str:
    return f"{root.rstrip('/')}/{batch_date}/{stem}_{batch_date}.{ext}"


def write_partitioned(
    df: DataFrame, root: str, batch_date: str, files_per_month: int | None = None
) -> str:
    """Parquet by year and month, in place of an earlier run of the same batch.

    A batch covers few months, so by default each task writes its rows where they are: no
    shuffle, and no single task that gets a whole month. For a load of many months,
    ``files_per_month`` spreads each month over so many tasks.
    """
    path = cleaned_path(root, batch_date)
    rows = add_partition_cols(df)
    if files_per_month:
        salt = F.pmod(F.xxhash64("id", "location", "date"), F.lit(files_per_month))
        rows = rows.repartition("year", "month", salt)
    # Rows of one location side by side let row groups be skipped on read.
    rows = rows.sortWithinPartitions("year", "month", "location", "genres")
    rows.write.mode("overwrite").partitionBy("year", "month").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path


def artists_to_csv(artists: DataFrame, path: str) -> str:
    """Artist list as CSV; an empty list is an error."""
    from trendengine.operators.enrich import artists_table

    if artists.isEmpty():
        raise ValueError("no artists to write")
    return write_csv(artists_table(artists), path)


def init_table(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> None:
    """An empty table where there is none yet; an existing one stays as it is."""
    out = empty_table(spark, schema).write.mode("ignore")
    if fmt == "csv":
        out = out.options(**CSV_OPTIONS)
    out.format(fmt).save(path)


def append_rows(new: DataFrame, path: str, id_col: str, fmt: str = "parquet") -> None:
    """Append dimension rows, each file in number order."""
    out = new.sortWithinPartitions(id_col).write.mode("append")
    if fmt == "csv":
        out = out.options(**CSV_OPTIONS)
    out.format(fmt).save(path)


def land_enriched_batch(spark: SparkSession, lines: str, root: str, batch_date: str) -> str:
    """Enriched JSON lines as a raw batch at its dated path; without any line a batch that has a header only."""
    rows = unpivot_trends(read_json_lines(spark, lines)).select(*RAW_COLUMNS)
    path = raw_path(root, batch_date)
    if rows.isEmpty():
        rows = empty_table(spark, rows.schema)
    return write_csv(rows, path)


def land_records(spark: SparkSession, lines: str, root: str, batch_date: str) -> tuple[str, int]:
    """`land_enriched_batch` that broken lines do not end: they go to ``<root>/<date>/quarantine`` with a reason; path and their number.

    Lines are counted while the rows are written; only if there are broken ones are the lines read again.
    """
    parsed = parsed_records(read_json_lines(spark, lines))
    broken = Observation()
    counted = parsed.observe(broken, F.count_if(F.col("v").isNull()).alias("n"))
    path = write_csv(unpivot_records(counted).select(*RAW_COLUMNS), raw_path(root, batch_date))
    n = broken.get["n"]
    if n:
        rejected_records(parsed).write.mode("overwrite").json(f"{root.rstrip('/')}/{batch_date}/quarantine")
    return path, n


def land_raw_batch(spark: SparkSession, source: str, root: str, batch_date: str) -> str:
    """Copy a raw batch to ``<root>/data/raw/<date>/``, in place of an earlier copy."""
    target = raw_path(f"{root.rstrip('/')}/data/raw", batch_date)
    return write_csv(read_raw_csv(spark, source), target)


# --- fixed values: the warehouse table and its indexes, as other readers of it know them ---
STAGING_DDL = """
CREATE SCHEMA IF NOT EXISTS "{schema}";
CREATE TABLE IF NOT EXISTS "{schema}"."{table}" (
  artist TEXT NOT NULL,
  id TEXT NOT NULL,
  genre TEXT NOT NULL,
  state_code CHAR(2) NOT NULL,
  state_name TEXT,
  date DATE NOT NULL,
  trend_score DOUBLE PRECISION,
  load_timestamp TIMESTAMPTZ NOT NULL DEFAULT NOW()
);
CREATE INDEX IF NOT EXISTS ix_artist_trend_id_date_state ON "{schema}"."{table}" (id, date, state_code);
CREATE INDEX IF NOT EXISTS ix_artist_trend_genre ON "{schema}"."{table}" (genre);
CREATE INDEX IF NOT EXISTS ix_artist_trend_state_date ON "{schema}"."{table}" (state_code, date)
"""


def staging_ddl(table: str, default_schema: str = "public") -> str:
    """Statements that create the staging table (``schema.table`` or ``table``) with its schema and indexes."""
    schema, _, name = table.replace('"', "").rpartition(".")
    return STAGING_DDL.format(schema=schema or default_schema, table=name).strip()


def ensure_staging_table(spark: SparkSession, url: str, table: str, **properties) -> None:
    """Run the statements above through the JDBC source, which executes them on connecting."""
    (
        spark.read.format("jdbc")
        .options(url=url, query="SELECT 1 AS ok", sessionInitStatement=staging_ddl(table), **properties)
        .load()
        .collect()
    )


def write_staging_jdbc(
    staging: DataFrame, url: str, table: str, connections: int = 16, batch_size: int = 10_000, **properties
) -> None:
    """Append staging rows over a limited number of connections. A second run appends again.

    Rows are shuffled to as many tasks as there are connections; left to itself the writer would run the whole
    chain before it, scan and explode, in so few tasks.
    """
    (
        staging.repartition(connections).write.format("jdbc")
        .mode("append")
        .options(url=url, dbtable=table, numPartitions=connections, batchsize=batch_size, **properties)
        .save()
    )
