"""Session helpers: a local session for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Class name of the RocksDB state store that the stateful streaming operators need.
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = 8, app: str = "tidewatch", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor reaches, from ``spark.checkpoint.dir``.

    Only a local session may fall back on a temporary folder: on a cluster a folder of one
    machine would lose its files together with that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidewatch-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def ship_package(spark: SparkSession) -> None:
    """Lets the Python workers of executors import this package, wherever the driver was started; once per session."""
    context = spark.sparkContext
    if getattr(context, "_tidewatch_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tidewatch-package-")  # the driver hands the file out to executors as long as it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "tidewatch-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.join("tidewatch", os.path.relpath(full, root)))
    context.addPyFile(path)
    context._tidewatch_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder, for a table this run writes."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
