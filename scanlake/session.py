"""Session defaults and the shared folder for written intermediate data."""

import os
import tempfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "scanlake", **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def reachable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it.

    That serves a local master and installations on a shared path; elsewhere the package is installed or shipped with
    ``--py-files``, and the path is without effect.
    """
    root = str(Path(__file__).resolve().parent.parent)
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"scanlake-{application}-")
