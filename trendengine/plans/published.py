"""Dimensions as published versions, safe for runs at the same time.

``<root>/<dim>/rows/<version>-<run>`` holds the rows that a version adds, ``<root>/<dim>/versions/<version>`` names the folder that belongs to it.
A version exists once that marker does, and a marker is created only if there is none: of two runs that make the same version one wins; the
other reads what was published, numbers its keys anew and tries for the next version. So no number is issued twice, a reader sees whole
versions only, and what a crashed run wrote is never read.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from trendengine.operators.dims import Dimension
from trendengine.plans.batch import POS, SEQ
from trendengine.session import create_if_absent, remove_folder
from trendengine.sources.batches import folder_names
from trendengine.sources.readers import empty_table

#: Attempts to publish before a run gives up, and seconds before the next one, times the number of the attempt.
ATTEMPTS, PAUSE = 20, 0.2


def versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(version, folder) of all published versions, by version. Names and one short text each."""
    marks = sorted(int(n) for n in folder_names(spark, f"{root}/versions") if n.isdigit())
    if not marks:
        return []
    found = spark.read.text([f"{root}/versions/{n}" for n in marks]).select("value", "_metadata.file_name").collect()
    return sorted((int(r["file_name"]), f"{root}/rows/{r['value']}") for r in found)


def read_published(spark: SparkSession, root: str, dim: Dimension) -> DataFrame:
    """The rows of all published versions of a dimension under ``root``."""
    folders = [folder for _, folder in versions(spark, f"{root.rstrip('/')}/{dim.name}")]
    return spark.read.schema(dim.schema).parquet(*folders) if folders else empty_table(spark, dim.schema)


def publish_dim(spark: SparkSession, cleaned: DataFrame, root: str, dim: Dimension, before_publish=lambda: None) -> int | None:
    """Publish the keys of a cleaned batch that the dimension lacks; the new version, or none if it lacks none.

    ``before_publish`` is called when the rows of an attempt are written, before its marker is.
    """
    home = f"{root.rstrip('/')}/{dim.name}"
    keys = None
    for attempt in range(1, ATTEMPTS + 1):
        known = read_published(spark, root, dim)
        version = max((n for n, _ in versions(spark, home)), default=0) + 1
        if keys is None:  # the batch is scanned once; a later attempt only takes off what others published
            staged = f"{home}/staged-{uuid.uuid4().hex}"
            missing = dim.missing_keys(cleaned, known, seq=SEQ, pos=POS)
            missing.write.parquet(staged)
            keys = spark.read.schema(missing.schema).parquet(staged)
        open_keys = keys.join(dim.valid(known).select(dim.key_col), dim.key_col, "left_anti")
        if open_keys.isEmpty():
            remove_folder(spark, staged)
            return None
        folder = f"{version:09}-{uuid.uuid4().hex}"
        dim.number(open_keys, known).sortWithinPartitions(dim.id_col).write.parquet(f"{home}/rows/{folder}")
        before_publish()
        if create_if_absent(spark, f"{home}/versions/{version}", folder):
            remove_folder(spark, staged)
            return version
        remove_folder(spark, f"{home}/rows/{folder}")
        time.sleep(PAUSE * attempt)
    raise RuntimeError(f"{dim.name}: others published {ATTEMPTS} times in a row")
