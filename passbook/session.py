"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession

# Results depend on the first three; the next let Spark re-plan at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parser.escapedStringLiterals": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A task's share of a table is bounded, however large the table: stored columns unfold to
    # some thirty times their size as rows, and a sort of more than fits memory spills them all.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Streaming state on disk: the ids of a window need not fit the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_local_dirs: dict[str, str] = {}
_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the results depend on and the size of tasks; the rest stays with the cluster."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, for staged tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    fall back to a folder of its own machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="passbook-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, unique to this call.

    What is not removed before goes when the application ends.
    """
    app = spark.sparkContext.applicationId
    folder = f"{shared_dir(spark)}/{app}"
    if app not in _scratch:
        _scratch[app] = folder
        atexit.register(remove_scratch, app)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(app: str) -> None:
    """Remove an application's scratch folder, if the application still runs."""
    context, folder = SparkContext._active_spark_context, _scratch.get(app)
    if folder is None or context is None or context._jsc is None or context.applicationId != app:
        return
    place = context._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
