"""Session construction and the shared scratch folder.

On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder
(HDFS / object store).  Every operator that must materialise intermediate
output (quarantine folders, stream sinks, lineage cuts) writes below it.
Only when the setting is absent -- local runs and tests -- do we create a
private temporary folder and register it.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "sluice",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Return a session tuned for analytic batch work.

    AQE stays on so that shuffle partitions coalesce and skewed joins split at
    run time; the static partition count is only the upper bound AQE starts
    from.  The UI is off: no port beyond what Spark's RPC needs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # broadcast only what the optimizer and AQE measure as small
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sized_conf(largest_shuffle_bytes: int, partition_bytes: int = 256 << 20,
               min_partitions: int = 200) -> dict[str, str]:
    """Settings that keep every task's share of the largest shuffle near
    ``partition_bytes``, so partitions fit executor memory without spilling
    at the target scale.

    ``spark.sql.shuffle.partitions`` is the ceiling AQE starts from (it then
    coalesces small partitions to the advisory size); scan splits use the
    same size; a partition beyond twice the size (and 5x the median) is a
    skewed one and gets split in joins.  For example, a 10 TB shuffle gives
    40,960 partitions of 256 MB.
    """
    parts = max(min_partitions, math.ceil(largest_shuffle_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; created privately only when unset."""
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            # executors cannot share a machine-local folder
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a shared folder (HDFS, object store)")
        # local runs / tests only: nothing names a shared folder
        root = tempfile.mkdtemp(prefix="sluice-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, root)
    if spark.sparkContext.getCheckpointDir() is None:
        # so that DataFrame.checkpoint() cuts lineage into the same folder
        spark.sparkContext.setCheckpointDir(root)
    return root


_SCRATCH: list[str] = []


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder below the checkpoint root; remembered
    until :func:`release_scratch`."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    path = f"{root}{sep}{purpose}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession, path: str) -> bool:
    """Delete one scratch folder, through Hadoop's file system; whether it was
    there.  For a table that nothing reads any more, such as a round of an
    iteration whose successor is written."""
    if path in _SCRATCH:
        _SCRATCH.remove(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True))


def scratch_folders() -> list[str]:
    """The folders made so far and not deleted."""
    return list(_SCRATCH)


def release_scratch(spark: SparkSession, keep: Iterable[str] = ()) -> int:
    """Delete the scratch folders of this application but for ``keep``.  Call it
    when the frames that read them are done with (results are lazy).  Returns how
    many were there."""
    kept = set(keep)
    return sum(drop_scratch(spark, path) for path in scratch_folders() if path not in kept)
