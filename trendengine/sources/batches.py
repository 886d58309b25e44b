"""Which batch to read: dated folders and dated file names.

A batch lies at ``<root>/<YYYY_MM_DD>/<stem>_<YYYY_MM_DD>.<ext>``, as one file or as a
folder of that name written by Spark. Only names of folders and batches are listed, not the part files below.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from trendengine.constants import BATCH_DATE_PATTERN, RAW_STEM


def batch_date_from_path(path: Column, stem: str = RAW_STEM, ext: str = "csv") -> Column:
    """Date in the file name, null where there is none; upper and lower case are equal."""
    found = F.regexp_extract(path, _name_pattern(stem, ext), 1)
    return F.nullif(found, F.lit(""))


def _name_pattern(stem: str, ext: str) -> str:
    ending = rf"\.{ext}" if ext else ""
    return rf"(?i)(?:^|/){stem}_({BATCH_DATE_PATTERN}){ending}(?:/[^/]*)?$"


def _entries(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern; names only, no file below them is looked at."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def folder_names(spark: SparkSession, root: str) -> list[str]:
    """Names right below ``root``; none where there is no such folder."""
    return [path.rpartition("/")[2] for path in _entries(spark, f"{root.rstrip('/')}/*")]


def batch_folders(spark: SparkSession, root: str) -> list[str]:
    """Dates of the dated folders, newest first."""
    return sorted((n for n in folder_names(spark, root) if re.fullmatch(BATCH_DATE_PATTERN, n)), reverse=True)


def _in_folder(spark: SparkSession, root: str, date: str, stem: str, ext: str) -> tuple[str, str] | None:
    """(path, date) of the batch that a dated folder should hold."""
    for path in sorted(_entries(spark, f"{root.rstrip('/')}/{date}/*"), reverse=True):
        found = re.search(_name_pattern(stem, ext), path)
        if found and found[1] == date:
            return path, date
    return None


def latest_by_file(spark: SparkSession, root: str, stem: str = RAW_STEM, ext: str = "csv") -> tuple[str, str] | None:
    """(path, date) of the batch with the latest date in its file name, whatever its folder is called."""
    dated = [(m[1], path) for path in _entries(spark, f"{root.rstrip('/')}/*/*") if (m := re.search(_name_pattern(stem, ext), path))]
    return max(dated)[::-1] if dated else None


def latest_by_folder(spark: SparkSession, root: str, stem: str = RAW_STEM, ext: str = "csv") -> tuple[str, str] | None:
    """(path, date) of the batch in the latest dated folder; none when the expected file is not in that folder."""
    folders = batch_folders(spark, root)
    return _in_folder(spark, root, folders[0], stem, ext) if folders else None


def latest_with_file(spark: SparkSession, root: str, stem: str = RAW_STEM, ext: str = "csv") -> tuple[str, str] | None:
    """(path, date) of the batch in the latest dated folder that does hold the expected file. Folders are opened newest first."""
    found = (_in_folder(spark, root, date, stem, ext) for date in batch_folders(spark, root))
    return next((batch for batch in found if batch), None)


def resolve_input(
    spark: SparkSession, root: str | None = None, override: str | None = None, stem: str = RAW_STEM, ext: str = "csv"
) -> tuple[str, str]:
    """Path and batch date to read. An explicit path wins over the search under ``root``."""
    if override:
        found = re.search(_name_pattern(stem, ext), override)
        if not found:
            raise ValueError(f"no batch date in {override}")
        return override, found[1]
    if not root:
        raise ValueError("give either a root folder or a path")
    batch = latest_by_file(spark, root, stem, ext)
    if batch is None:
        raise FileNotFoundError(f"no dated batch named {stem}_<date> under {root}")
    return batch
