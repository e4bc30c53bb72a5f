"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Spark picks a broadcast join only for a side whose measured size is below the threshold, and
# splits an oversized join partition otherwise. Both are left on; nothing here is hinted.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "96MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Where the temporary folder of a local session is kept. The setting of the cluster is static.
LOCAL_FOLDER = "spark.storeloom.scratch"


def _checkpoint_folder(spark: SparkSession, cluster: bool) -> str | None:
    """The folder of ``spark.checkpoint.dir``, or else the one given to ``setCheckpointDir``.

    One without a scheme is the folder that Spark made of it when the context began, named with its
    file system: the place that Spark itself checkpoints to, whatever a later path would mean.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured and ("://" in configured or configured.startswith("file:")):
        return configured
    context = getattr(spark, "sparkContext", None)
    made = context and context.getCheckpointDir()
    return made or (None if cluster else configured)


def _warehouse_folder(spark: SparkSession) -> str | None:
    """A folder in the warehouse, if one is named: tables need one that all executors reach."""
    context = getattr(spark, "sparkContext", None)
    named = context and context.getConf().get("spark.sql.warehouse.dir")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/storeloom_scratch" if named else None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster: that of checkpoints, or else one in the warehouse.
    A temporary one only in local mode; its scheme says so, whatever the default file system is."""
    master = spark.conf.get("spark.master", "")
    cluster = not master.startswith("local")
    found = _checkpoint_folder(spark, cluster)
    if not found and (cluster or master.startswith("local-cluster")):
        found = _warehouse_folder(spark)
    if found:
        return found
    if cluster and spark.conf.get("spark.checkpoint.dir", None):
        raise ValueError("spark.checkpoint.dir needs a scheme, such as hdfs://, off local mode")
    if cluster:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = spark.conf.get(LOCAL_FOLDER, None)
    if not folder:
        made = tempfile.mkdtemp(prefix="storeloom-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        folder = Path(made).as_uri()
        spark.conf.set(LOCAL_FOLDER, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that no earlier job has written."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
