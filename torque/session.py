"""Session construction and the shared work folder.

Jobs never pick a machine-local folder on a cluster: intermediate tables and
snapshots live under ``spark.checkpoint.dir``, which the cluster names.  Only
when the setting is absent (local runs, tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes (this is
# the size check behind every broadcast we do not hint ourselves) and splits
# skewed shuffle partitions; the session time zone pins timestamp arithmetic.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # A selective side (sales of one window) builds a bloom filter that prunes
    # the other side's scan before a shuffle join (cars, customers at scale).
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "torque", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOT: str | None = None
_LOCK = threading.Lock()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written tables: ``spark.checkpoint.dir`` as the cluster
    sets it.  Only when it is unset (tests, local runs) do we make a folder of
    our own and register it as the checkpoint dir, so ``DataFrame.checkpoint()``
    and our written tables land in the same place."""
    global _LOCAL_ROOT
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if _LOCAL_ROOT is None and spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir().rstrip("/")   # set on the context by the caller
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        # A machine-local folder is invisible to other executors and lost with
        # the machine: on a cluster the shared folder must be named.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    with _LOCK:
        if _LOCAL_ROOT is None:
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="torque-work-")
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(os.path.join(_LOCAL_ROOT, "checkpoints"))
        return _LOCAL_ROOT


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the work folder (never reused between runs)."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# DataFrames that staged() returned; weak, so nothing outlives them.
_STAGED: "weakref.WeakSet[DataFrame]" = weakref.WeakSet()


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder under the work folder and read from there: its
    plan runs once, its lineage ends, and counting it reads file footers only."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _STAGED.add(out)
    return out


def once(df: DataFrame, name: str = "batch") -> DataFrame:
    """``df`` as a stored table: written now, unless :func:`staged` has just read it back."""
    return df if df in _STAGED else staged(df, name)


# Target bytes per shuffle partition.  AQE coalesces small partitions, so the
# configured count is an upper bound sized for the input: at 100 TB this gives
# hundreds of thousands of partitions of ~128 MB, each fitting executor memory.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """Shuffle partitions for an input of ``input_bytes`` on ``cores`` cores:
    enough for ~128 MB partitions, at least two waves of tasks."""
    return max(2 * cores, -(-input_bytes // TARGET_PARTITION_BYTES))
