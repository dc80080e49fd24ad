"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "sensorflow", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def share_package(spark: SparkSession) -> None:
    """Python workers find this package where the driver did."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), root]))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach. Only a local session may fall back to a folder of this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    """Removed when the program ends."""
    folder = tempfile.mkdtemp(prefix="sensorflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing has to be cleared first."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
