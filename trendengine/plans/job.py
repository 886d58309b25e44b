"""The batch as a job for ``spark-submit``, set up by the environment.

RAW_ROOT holds the dated raw batches, TRANSFORM_ROOT takes the cleaned ones. A path in
TRANSFORM_ONE_OFF_INPUT is read in place of the latest batch. With DIMS_ROOT set the
dimensions are brought up to date as well. With STAGING_COPY_PATH (files to copy in, with a manifest), STAGING_PATH (Parquet) or
STAGING_JDBC_URL and STAGING_TABLE set, the newest cleaned batch is then loaded; a batch without rows loads nothing.
"""

from __future__ import annotations

import logging
import os

from trendengine.plans.batch import load_batch, load_batch_files, refresh_dims, transform_batch
from trendengine.session import build_session
from trendengine.sinks.writers import ensure_staging_table, write_staging_jdbc
from trendengine.sources.readers import read_cleaned

log = logging.getLogger("trendengine")


def staging_sink(spark):
    """Where the environment wants warehouse rows to go, or nothing."""
    if path := os.getenv("STAGING_PATH"):
        return lambda rows: rows.write.mode("append").parquet(path)
    if url := os.getenv("STAGING_JDBC_URL"):
        table = os.environ["STAGING_TABLE"]
        ensure_staging_table(spark, url, table)
        return lambda rows: write_staging_jdbc(rows, url, table)
    return None


def main() -> dict[str, int]:
    out_root = os.environ.get("TRANSFORM_ROOT")
    if not out_root:
        raise EnvironmentError("TRANSFORM_ROOT is not set")
    spark = build_session("trendengine-transform")
    path, counts = transform_batch(
        spark, out_root, root=os.getenv("RAW_ROOT"), override=os.getenv("TRANSFORM_ONE_OFF_INPUT")
    )
    log.info("wrote %s: %s", path, ", ".join(f"{name}={n:,}" for name, n in counts.items()))
    if dims_root := os.getenv("DIMS_ROOT"):
        refresh_dims(spark, read_cleaned(spark, path), dims_root)
    if copy_path := os.getenv("STAGING_COPY_PATH"):
        log.info("published batch %s", load_batch_files(spark, out_root, copy_path))
    elif sink := staging_sink(spark):
        log.info("loaded batch %s", load_batch(spark, out_root, sink))
    return counts


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    main()
