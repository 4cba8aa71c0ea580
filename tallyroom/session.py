"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


# Many small initial partitions, merged by AQE to about 128 MB: a shuffle of
# terabytes stays in memory, a small one does not pay for empty tasks.
CLUSTER = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and a fixed time zone.

    Broadcasts are left to Catalyst and AQE, which compare the estimated and
    then the measured size with ``spark.sql.autoBroadcastJoinThreshold``;
    beyond it joins shuffle, and AQE splits hot partitions, if need be at the
    price of one more shuffle.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    local = master is not None and master.startswith("local")
    builder = SparkSession.builder.appName("tallyroom")
    if master:
        builder = builder.master(master)
    for key, value in {**settings, **({} if local else CLUSTER), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="tallyroom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share.

    The cluster names the folder in ``spark.checkpoint.dir``. Where that is
    unset, a local folder stands in for a local master, removed at exit; with
    any other master it is an error, as executors would not see each other's
    files there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not re.match(r"local(\[[^-]*\])?$", master):
            raise ValueError(f"name a folder that all executors share in spark.checkpoint.dir ({master})")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written folder, wherever Spark keeps it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a written folder when the program ends; a stopped session leaves it to the cluster."""

    def remove() -> None:
        try:
            remove_path(spark, path)
        except Exception:  # noqa: BLE001  the gateway may be gone by then
            return

    atexit.register(remove)
