"""A session for command-line runs and the benchmark.

Library functions take the session of their inputs and never change settings.
"""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Do not record a Python call site for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(name: str = "riskwindow", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that the cluster shares.

    That folder is read from ``spark.checkpoint.dir``. Only a session without executors
    of their own may do without the setting; its folder goes when Python ends. Below a
    shared folder, what is temporary stays until :func:`discard` or the cluster's own clearing.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _local_root(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that was temporary."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


_LOCAL: dict[str, str] = {}


def _local_root(spark: SparkSession) -> str:
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
    if "root" not in _LOCAL:
        _LOCAL["root"] = tempfile.mkdtemp(prefix="riskwindow-")
        atexit.register(shutil.rmtree, _LOCAL["root"], ignore_errors=True)
    return _LOCAL["root"]
