"""Readers. Schemas are given, never inferred."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendengine.schemas import CLEAN_SCHEMA, RAW_SCHEMA, RISING_SCHEMA

# Quotes are doubled inside of quoted fields; nothing is trimmed by the reader.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

def read_raw_csv(
    spark: SparkSession, path, schema: T.StructType = RAW_SCHEMA, multi_line: bool = False
) -> DataFrame:
    """Raw trend rows. ``multi_line`` is for fields with line breaks; such files cannot be split."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", multi_line).csv(path)


def with_file_order(df: DataFrame, name: str = "ingest_seq") -> DataFrame:
    """Integer that is unique per row and rises with the lines of each file.

    Spark hands out the full blocks of a file in order and its shorter last block after them,
    so numbers by task and row follow the file; a repeated task gives the same ones. Files
    written by several tasks have no order among each other. To be applied right on the
    reader, and to be read together with the batch date where batches are put together.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def read_json_array(
    spark: SparkSession, path, schema: T.StructType = RISING_SCHEMA, multi_line: bool = True
) -> DataFrame:
    """Records of JSON arrays. A file that is one array is read by one task; files with an
    array on each line (``multi_line=False``) are split."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_json_lines(spark: SparkSession, path) -> DataFrame:
    """Lines as text in the column ``value``, for records whose keys are data."""
    return spark.read.text(path).where(F.trim("value") != "")


def read_search_results(spark: SparkSession, root: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """JSON objects under ``genre=<g>/market=<m>/``; both names become columns and prune folders."""
    typed = T.StructType(
        [*schema.fields, T.StructField("genre", T.StringType()), T.StructField("market", T.StringType())]
    )
    return (
        spark.read.schema(typed).option("basePath", root).option("multiLine", multi_line).json(root)
    )


def read_dim(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A stored dimension, or an empty one where nothing is stored yet."""
    reader = spark.read.schema(schema)
    try:
        return reader.options(**CSV_OPTIONS).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, schema)


def read_cleaned(
    spark: SparkSession, path: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Cleaned table, limited to a range of days.

    Folders are keyed by year and month, which a filter on ``date`` alone does not prune;
    the months of the range are therefore added to the filter. A batch without rows has no file and reads as an
    empty table.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return empty_table(spark, T.StructType([*CLEAN_SCHEMA.fields]).add("year", T.IntegerType()).add("month", T.IntegerType()))
    month = F.col("year") * 12 + F.col("month")
    if start:
        df = df.where((F.col("date") >= F.lit(start)) & (month >= start.year * 12 + start.month))
    if end:
        df = df.where((F.col("date") <= F.lit(end)) & (month <= end.year * 12 + end.month))
    return df
