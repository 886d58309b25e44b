"""Session set-up and scratch space."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Runtime settings the plans are written for. All are session settings, so they can
# also be given by the cluster; none of them changes a result.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "trendengine", master: str | None = None, **conf) -> SparkSession:
    """Session with the recommended settings; object-store access comes from the environment."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    set_object_store_key(spark)
    return spark


def set_object_store_key(spark: SparkSession, required: bool = False) -> bool:
    """Give the session the Azure account key named by the environment, if there is one."""
    account = os.getenv("AZURE_STORAGE_ACCOUNT")
    key = os.getenv("AZURE_STORAGE_KEY")
    if not (account and key):
        if required:
            raise RuntimeError("AZURE_STORAGE_ACCOUNT and AZURE_STORAGE_KEY are not set")
        return False
    for service in ("blob", "dfs"):
        spark.conf.set(f"fs.azure.account.key.{account}.{service}.core.windows.net", key)
    return True


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Where the setting is missing, a session whose executors live in the driver (``local`` masters) gets a
    local folder, remembered on the session; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not folder:
        folder = spark.conf.get("trendengine.scratch.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="trendengine-")
        spark.conf.set("trendengine.scratch.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/trendengine/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this engine made and nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one of that name; whether it was written.

    The name is taken in the call that creates it: of two callers one is refused.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = system.create(target, False)
    except Py4JJavaError as error:
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    out.write(bytearray(text.encode()))
    out.close()
    return True
