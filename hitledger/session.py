"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# AQE picks the join strategy from measured sizes, splits skewed partitions and
# merges small ones, so the number of shuffle partitions is only an upper bound.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Spares a look at the Python call stack for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hitledger")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@lru_cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="hitledger-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the one all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, whose
    executors are this machine, may do without: it gets a folder that goes when the process
    ends. Folders in the shared one go when the application does.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    folder = f"{root.rstrip('/')}/hitledger-{uuid.uuid4().hex}"
    jvm = getattr(spark.sparkContext, "_jvm", None)
    if jvm:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{folder}/{label}"
